"""Activity over a group hierarchy of any depth, cycles included (J-08,
D-09..D-12, H-01, I-16).

A group is *active* when it has an active member itself or -- in the
default ``descendants`` direction -- somewhere below it. The parity
direction ``ancestors`` instead marks a group active when it or a group
above it has an active member.

Each group has at most one parent, so the hierarchy is a functional graph
(a forest whose roots may be cycles or self-loops). Parents that are not
groups themselves are ignored, as are active ids that are not groups.

Two distributed methods, same result (``auto``, the default, runs the
first for up to ``switch_rounds`` rounds and finishes with the second):

* ``frontier`` (default): breadth-first rounds. Each round joins only the
  newly activated groups with the edge table and removes groups already
  seen (anti join), so it terminates on any graph after depth + 1 rounds
  and touches each group once. Best for the usual shallow hierarchies.
* ``doubling``: pointer jumping. Round k joins every group with the group
  2^k levels above it, so any depth needs at most log2(depth) + 1 rounds;
  it stops as soon as a round activates nothing new (the active set is then
  closed under every longer jump). Best for deep chains.

Every round is cut with a reliable checkpoint in the cluster's checkpoint
folder: plans stay flat (a round never embeds earlier rounds) and a lost
executor recomputes at most one round.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from syncforge.session import materialize

DESCENDANTS, ANCESTORS = "descendants", "ancestors"
AUTO_SWITCH_ROUNDS = 16
_NODE, _NEXT, _ACT = "_node", "_ptr", "_act"


def _edges(groups: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """(child, parent) pairs where both ends are groups."""
    ids = groups.select(F.col(id_col).alias("parent")).filter(F.col("parent").isNotNull()).distinct()
    e = groups.select(F.col(id_col).alias("child"), F.col(parent_col).alias("parent")).filter(
        F.col("child").isNotNull() & F.col("parent").isNotNull()
    )
    return e.join(ids, "parent", "left_semi")


def _seeds(groups: DataFrame, active_ids: DataFrame, id_col: str, active_col: str) -> DataFrame:
    ids = groups.select(F.col(id_col).alias(_NODE)).filter(F.col(_NODE).isNotNull())
    act = active_ids.select(F.col(active_col).alias(_NODE)).filter(F.col(_NODE).isNotNull())
    return ids.join(act, _NODE, "left_semi").distinct()


def _materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """The checkpointed frame and its row count, observed on the same job. A
    plan that Spark finds empty while running reports no metric: no rows."""
    obs = Observation()
    out = materialize(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return out, obs.get.get("rows", 0)


def active_groups(
    groups: DataFrame,
    active_ids: DataFrame,
    id_col: str = "group_id",
    parent_col: str = "parent_group_id",
    active_col: str | None = None,
    direction: str = DESCENDANTS,
    method: str = "auto",
    checkpoint_every: int = 8,
    switch_rounds: int = AUTO_SWITCH_ROUNDS,
) -> DataFrame:
    """Distinct ids (column ``id_col``) of the groups that count as active."""
    if direction not in (DESCENDANTS, ANCESTORS):
        raise ValueError(f"unknown direction {direction!r}")
    active_col = active_col or id_col
    seeds = _seeds(groups, active_ids, id_col, active_col)
    if method == "frontier":
        out, _ = _frontier(groups, seeds, id_col, parent_col, direction, checkpoint_every)
    elif method == "auto":
        # Shallow hierarchies finish in a few cheap frontier rounds; a deep
        # one switches to pointer doubling, seeded with everything seen so
        # far (the same closure), so rounds stay <= switch + log2(depth).
        out, done = _frontier(groups, seeds, id_col, parent_col, direction, checkpoint_every, switch_rounds)
        if not done:
            out = _doubling(groups, out, id_col, parent_col, direction, checkpoint_every)
    elif method == "doubling":
        out = _doubling(groups, seeds, id_col, parent_col, direction, checkpoint_every)
    else:
        raise ValueError(f"unknown method {method!r}")
    return out.select(F.col(_NODE).alias(id_col))


def _frontier(groups, seeds, id_col, parent_col, direction, every, max_rounds=None):
    """Breadth-first rounds; returns (active ids, converged)."""
    e = _edges(groups, id_col, parent_col)
    if direction == DESCENDANTS:  # activity climbs: child -> parent
        step = e.select(F.col("child").alias(_NODE), F.col("parent").alias(_NEXT))
    else:  # activity descends: parent -> child
        step = e.select(F.col("parent").alias(_NODE), F.col("child").alias(_NEXT))
    # Edges are read by every round. A child has one parent, so upwards they are
    # laid out once by the join key and a round shuffles only its frontier.
    # Downwards one parent may have any number of children: a fixed layout
    # would keep them in one partition, so there AQE lays out each join and
    # splits it where it is skewed.
    if direction == DESCENDANTS:
        step = step.repartition(_NODE)
    step = step.persist(StorageLevel.MEMORY_AND_DISK)
    frontier = materialize(seeds)
    seen_parts = [frontier]
    rounds = 0
    converged = True
    while True:
        if max_rounds is not None and rounds >= max_rounds:
            converged = False
            break
        rounds += 1
        seen = seen_parts[0]
        for p in seen_parts[1:]:
            seen = seen.unionByName(p)
        nxt = (
            frontier.join(step, _NODE)
            .select(F.col(_NEXT).alias(_NODE))
            .distinct()
            .join(seen, _NODE, "left_anti")
        )
        # Checkpoint every frontier: the next round's plan then starts from
        # files instead of embedding this round twice (frontier and seen).
        # Each group sits in exactly one frontier, so all rounds together
        # write each group once.
        nxt, found = _materialize_counted(nxt)
        if not found:
            break
        seen_parts.append(nxt)
        frontier = nxt
        if len(seen_parts) >= every:
            seen_parts = [materialize(seen.unionByName(nxt))]
    seen = seen_parts[0]
    for p in seen_parts[1:]:
        seen = seen.unionByName(p)
    result = materialize(seen) if len(seen_parts) > 1 else seen
    step.unpersist()
    return result, converged


def _doubling(groups, seeds, id_col, parent_col, direction, every) -> DataFrame:
    e = _edges(groups, id_col, parent_col)
    nodes = groups.select(F.col(id_col).alias(_NODE)).filter(F.col(_NODE).isNotNull()).distinct()
    seed_flag = seeds.withColumn("_seed", F.lit(True))
    t = (
        nodes.join(e.select(F.col("child").alias(_NODE), F.col("parent").alias(_NEXT)), _NODE, "left")
        .join(seed_flag, _NODE, "left")
        .select(_NODE, _NEXT, F.coalesce(F.col("_seed"), F.lit(False)).alias(_ACT))
    )
    t = materialize(t)
    n_active = t.filter(F.col(_ACT)).count()
    rounds = 0
    while True:
        rounds += 1
        target = t.select(F.col(_NODE).alias(_NEXT), F.col(_NEXT).alias("_ptr2"), F.col(_ACT).alias("_act2"))
        # pointers past a root stay NULL: those rows have nothing to join, and
        # would otherwise all meet in one partition
        live = t.filter(F.col(_NEXT).isNotNull()).join(target, _NEXT, "left")
        ended = t.filter(F.col(_NEXT).isNull()).withColumns(
            {"_ptr2": F.col(_NEXT), "_act2": F.lit(None).cast("boolean")}
        )
        jumped = live.unionByName(ended)
        if direction == ANCESTORS:
            # x is active if x is, or the node 2^k levels above x is.
            nt = jumped.select(
                _NODE,
                F.col("_ptr2").alias(_NEXT),
                (F.col(_ACT) | F.coalesce(F.col("_act2"), F.lit(False))).alias(_ACT),
            )
        else:
            # the node 2^k levels above an active node becomes active.
            lifted = (
                t.filter(F.col(_ACT) & F.col(_NEXT).isNotNull())
                .select(F.col(_NEXT).alias(_NODE))
                .distinct()
                .withColumn("_lift", F.lit(True))
            )
            nt = jumped.select(_NODE, F.col("_ptr2").alias(_NEXT), F.col(_ACT)).join(lifted, _NODE, "left").select(
                _NODE, _NEXT, (F.col(_ACT) | F.coalesce(F.col("_lift"), F.lit(False))).alias(_ACT)
            )
        # the next round reads this one twice: start it from files
        nt = materialize(nt)
        stats = nt.agg(
            F.count_if(F.col(_ACT)).alias("active"), F.count_if(F.col(_NEXT).isNotNull()).alias("pointers")
        ).first()  # one aggregated row
        t = nt
        if stats["active"] == n_active or stats["pointers"] == 0:
            break
        n_active = stats["active"]
    return t.filter(F.col(_ACT)).select(_NODE)


def flag_inactive(
    groups: DataFrame,
    active_ids: DataFrame,
    id_col: str = "group_id",
    parent_col: str = "parent_group_id",
    active_col: str | None = None,
    direction: str = DESCENDANTS,
    method: str = "auto",
    flag_col: str = "inactive",
) -> DataFrame:
    """``groups`` with ``flag_col`` recomputed: True unless the group is active."""
    act = active_groups(groups, active_ids, id_col, parent_col, active_col, direction, method).withColumn(
        "_is_act", F.lit(True)
    )
    base = groups.drop(flag_col) if flag_col in groups.columns else groups
    return (
        base.join(act, id_col, "left")
        .withColumn(flag_col, F.col("_is_act").isNull())
        .drop("_is_act")
    )


def _flow(groups: DataFrame, id_col: str, parent_col: str, direction: str) -> DataFrame:
    """Edges (src, dst) along which activity spreads."""
    e = _edges(groups, id_col, parent_col)
    src, dst = ("child", "parent") if direction == DESCENDANTS else ("parent", "child")
    return e.select(F.col(src).alias("src"), F.col(dst).alias("dst"))


def update_inactive(
    groups: DataFrame,
    stored: DataFrame,
    own_before: DataFrame,
    own_now: DataFrame,
    id_col: str = "group_id",
    parent_col: str = "parent_group_id",
    direction: str = DESCENDANTS,
    method: str = "auto",
    flag_col: str = "inactive",
    touched_col: str = "_recomputed",
) -> DataFrame:
    """``groups`` with the flag brought up to date after a change, and whether a group was looked at again.

    ``stored`` holds the groups and their flags as they were with the active
    members ``own_before`` (ids of groups); ``own_now`` are those of today.
    A flag can only change where activity spreads to from a group that is new,
    whose own members changed, or that gained or lost an edge. These groups
    are closed along the edges; inside, activity starts at own members and at
    unchanged active groups on the border; all other flags are taken over.
    Each part is cut with a checkpoint: all of them are laid out by the group,
    and one task would hold the sorts of all at once.
    """
    ids = groups.select(F.col(id_col).alias(_NODE)).where(F.col(_NODE).isNotNull()).distinct()
    old_ids = stored.select(F.col(id_col).alias(_NODE))
    before, now = (x.select(F.col(id_col).alias(_NODE)).distinct() for x in (own_before, own_now))
    old_flow, flow = (materialize(_flow(x, id_col, parent_col, direction)) for x in (stored, groups))
    both = old_flow.withColumn("n", F.lit(-1)).unionByName(flow.withColumn("n", F.lit(1)))
    edges = materialize(both.groupBy("src", "dst").agg(F.sum("n").alias("n")).where("n <> 0").select(F.col("dst").alias(_NODE)))
    members = before.withColumn("n", F.lit(-1)).unionByName(now.withColumn("n", F.lit(1))).groupBy(_NODE).agg(F.sum("n").alias("n")).where("n <> 0").select(_NODE)
    fresh, members = materialize(ids.join(old_ids, _NODE, "left_anti")), materialize(members)
    changed = materialize(fresh.unionByName(edges).unionByName(members).distinct())
    touched = materialize(active_groups(groups, changed.select(F.col(_NODE).alias(id_col)), id_col, parent_col, None, direction, method))
    alive = stored.where(~F.col(flag_col)).select(F.col(id_col).alias("src"))
    border = materialize(flow.join(touched.select(F.col(id_col).alias("src")), "src", "left_anti").join(alive, "src", "left_semi"))
    inside = materialize(groups.join(touched, id_col, "left_semi"))
    seeds = now.unionByName(border.select(F.col("dst").alias(_NODE))).select(F.col(_NODE).alias(id_col))
    act = active_groups(inside, seeds, id_col, parent_col, None, direction, method).withColumn("_is_act", F.lit(True))
    flags = touched.join(act, id_col, "left").select(id_col, F.col("_is_act").isNull().alias("_new"), F.lit(True).alias(touched_col))
    old = stored.select(id_col, F.col(flag_col).alias("_old"))
    base = groups.drop(flag_col)
    out = base.join(flags, id_col, "left").join(old, id_col, "left")
    return out.select(*base.columns, F.coalesce("_new", "_old", F.lit(True)).alias(flag_col), F.coalesce(touched_col, F.lit(False)).alias(touched_col))


def groups_with_active_members(
    membership: DataFrame,
    agents: DataFrame,
    group_col: str = "group_id",
    agent_col: str = "agent_id",
    status_col: str = "status",
) -> DataFrame:
    """D-10 / C-12: groups with at least one member whose status is 'active'."""
    active_agents = agents.filter(F.col(status_col) == F.lit("active")).select(agent_col)
    return membership.join(active_agents, agent_col, "left_semi").select(group_col).distinct()
