"""Stateful queries: assignments with soft delete and history, membership
replace, hierarchy activity, status snapshots, watermarks and a multi-day
backfill (J-03, J-05..J-09, J-13, K-01..K-03, M-02, D-09..D-12, H-01)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncforge.operators.assignments import assignment_history, merge_assignments
from syncforge.operators.hierarchy import ANCESTORS, DESCENDANTS, flag_inactive, groups_with_active_members, update_inactive
from syncforge.operators.membership import replace_members
from syncforge.operators.merge import ACTION, KEEP, current_rows, merge_latest
from syncforge.operators.refer import flag_active, split_known
from syncforge.operators.snapshot import status_snapshot, upsert_snapshot
from syncforge.operators.watermark import advance_watermark, empty_state, since_watermark
from syncforge.plans.registry import register
from syncforge.plans.tables import table
from syncforge.schemas import AGENT_STATUS_HISTORY_DDL
from syncforge.session import checkpoint_dir, materialize
from syncforge.sinks.tables import TableStore

HALF = "2024-01-16"
RUN_TS = "2024-02-01 00:00:00"


def _ts(s: str):
    return F.lit(s).cast("timestamp")


# ---------------------------------------------------------------------------
# J-05..J-07: (user, event type) pairs as assignments seen in two periods
# ---------------------------------------------------------------------------
def _assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    first = ev.filter(F.col("ts") < _ts(HALF))
    current = first.groupBy("user_id", "event_type").agg(
        F.min("ts").alias("assigned_at"), F.max("ts").alias("_last")
    )
    removed = F.col("event_type") == "error"
    current = current.select(
        "user_id",
        "event_type",
        F.when(removed, F.lit("removed")).otherwise(F.lit("assigned")).alias("status"),
        "assigned_at",
        F.when(removed, F.col("_last")).alias("removed_at"),
        F.col("_last").alias("updated_at"),
    )
    staged = ev.filter(F.col("ts") >= _ts(HALF)).select("user_id", "event_type")
    return merge_assignments(current, staged, RUN_TS, keys=("user_id", "event_type"))


_ASSIGN_SQL = f"""
WITH cur AS (
  SELECT user_id, event_type,
         CASE WHEN event_type = 'error' THEN 'removed' ELSE 'assigned' END AS status,
         min(ts) AS assigned_at,
         CASE WHEN event_type = 'error' THEN max(ts) END AS removed_at,
         max(ts) AS updated_at
  FROM events WHERE ts < TIMESTAMP '{HALF}' GROUP BY user_id, event_type),
stg AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '{HALF}'),
j AS (
  SELECT COALESCE(c.user_id, s.user_id) AS user_id, COALESCE(c.event_type, s.event_type) AS event_type,
         c.status, c.assigned_at, c.removed_at, c.updated_at,
         CASE WHEN c.user_id IS NULL THEN 'insert'
              WHEN s.user_id IS NULL AND c.status <> 'removed' THEN 'remove'
              WHEN s.user_id IS NULL THEN 'keep'
              WHEN c.status = 'removed' THEN 'reassign'
              ELSE 'update' END AS _action
  FROM cur c FULL OUTER JOIN stg s ON c.user_id = s.user_id AND c.event_type = s.event_type)"""


@register(
    "soft_delete",
    _ASSIGN_SQL
    + f"""
SELECT user_id, event_type,
       CASE WHEN _action IN ('insert', 'update', 'reassign') THEN 'assigned'
            WHEN _action = 'remove' THEN 'removed' ELSE status END AS status,
       CASE WHEN _action = 'insert' THEN TIMESTAMP '{RUN_TS}'
            WHEN _action IN ('update', 'reassign') THEN COALESCE(assigned_at, TIMESTAMP '{RUN_TS}')
            ELSE assigned_at END AS assigned_at,
       CASE WHEN _action IN ('insert', 'update', 'reassign') THEN NULL
            WHEN _action = 'remove' THEN TIMESTAMP '{RUN_TS}' ELSE removed_at END AS removed_at,
       CASE WHEN _action = 'keep' THEN updated_at ELSE TIMESTAMP '{RUN_TS}' END AS updated_at,
       _action
FROM j""",
)
def soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-05/J-06/C-13: upsert present pairs, soft-delete absent ones."""
    return _assignments(spark, sf_dir)


@register(
    "assignment_history",
    _ASSIGN_SQL
    + f"""
SELECT user_id, event_type,
       CASE WHEN _action = 'remove' THEN 'removed' ELSE 'assigned' END AS action,
       TIMESTAMP '{RUN_TS}' AS action_time
FROM j WHERE _action IN ('insert', 'reassign', 'remove')""",
)
def assignment_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-07: history rows for new, returning and removed pairs."""
    return assignment_history(_assignments(spark, sf_dir), RUN_TS, keys=("user_id", "event_type"))


# ---------------------------------------------------------------------------
# J-09: parts as groups, suppliers as members; lines before the split are the
# stored membership, lines from the split on are the day's snapshot
# ---------------------------------------------------------------------------
MEMBERSHIP_SPLIT = "2000-01-01"
@register(
    "membership_replace",
    """
WITH cur AS (SELECT DISTINCT l_partkey AS group_id, l_suppkey AS agent_id
             FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01'),
snap AS (SELECT l_partkey AS group_id, l_suppkey AS agent_id
         FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01')
SELECT group_id, agent_id, 'keep' AS _action FROM cur
WHERE group_id NOT IN (SELECT group_id FROM snap)
UNION ALL
SELECT DISTINCT group_id, agent_id, 'insert' AS _action FROM snap
WHERE agent_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""",
)
def membership_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-09: every group in the snapshot gets exactly its valid snapshot members."""
    li = table(spark, sf_dir, "lineitem")
    current = (
        li.filter(F.col("l_shipdate") < _ts(MEMBERSHIP_SPLIT))
        .select(F.col("l_partkey").alias("group_id"), F.col("l_suppkey").alias("agent_id"))
        .distinct()
    )
    snap = li.filter(F.col("l_shipdate") >= _ts(MEMBERSHIP_SPLIT)).select(
        F.col("l_partkey").alias("group_id"), F.col("l_suppkey").alias("agent_id")
    )
    agents = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") >= 0).select(
        F.col("s_suppkey").alias("agent_id")
    )
    valid, _ = split_known(snap, agents, ["agent_id"])
    return replace_members(current, valid, snap)


# ---------------------------------------------------------------------------
# J-08: parts as a hierarchy (parent = key div 3, one cycle, some orphans)
# ---------------------------------------------------------------------------
ORPHAN_OFFSET = 1_000_000


def part_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    top = part.agg(F.max("p_partkey")).first()[0]  # one value: the key closing the cycle
    return part.select(
        F.col("p_partkey").alias("group_id"),
        F.when(F.col("p_size") == 50, F.col("p_partkey") + ORPHAN_OFFSET)
        .when(F.col("p_partkey") == 0, F.lit(top).cast("bigint"))
        .otherwise(F.expr("p_partkey div 3"))
        .alias("parent_group_id"),
    )


def part_active_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = (
        table(spark, sf_dir, "lineitem")
        .filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50))
        .select(F.col("l_partkey").alias("group_id"), F.col("l_suppkey").alias("agent_id"))
    )
    agents = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("agent_id"),
        F.when(F.col("s_acctbal") > 5000, F.lit("active")).otherwise(F.lit("inactive")).alias("status"),
    )
    return groups_with_active_members(members, agents)


_TREE_SQL = f"""
WITH RECURSIVE g AS (
  SELECT p_partkey AS group_id,
         CASE WHEN p_size = 50 THEN p_partkey + {ORPHAN_OFFSET}
              WHEN p_partkey = 0 THEN (SELECT max(p_partkey) FROM part)
              ELSE p_partkey // 3 END AS parent_group_id
  FROM part),
act AS (
  SELECT DISTINCT l.l_partkey AS group_id
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE l.l_returnflag = 'R' AND l.l_quantity = 50 AND s.s_acctbal > 5000),
tree(root, node) AS (  -- every (group, itself or a group above it); a set, so cycles end by themselves
  SELECT group_id, group_id FROM g
  UNION
  SELECT below.root, above.group_id
  FROM tree below, g own, g above
  WHERE own.group_id = below.node AND above.group_id = own.parent_group_id)"""

GROUP_INACTIVE_DESC_SQL = (
    _TREE_SQL
    + """
SELECT group_id, parent_group_id,
       group_id NOT IN (SELECT node FROM tree WHERE root IN (SELECT group_id FROM act)) AS inactive
FROM g"""
)


def _group_query(direction: str, method: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flag_inactive(
            part_groups(spark, sf_dir), part_active_groups(spark, sf_dir), direction=direction, method=method
        )

    return run


register("group_inactive_desc", GROUP_INACTIVE_DESC_SQL)(_group_query(DESCENDANTS, "auto"))
register("group_inactive_desc_doubling", GROUP_INACTIVE_DESC_SQL)(_group_query(DESCENDANTS, "doubling"))
def _stored_groups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An earlier state: other parents for a part of the groups, some groups missing, other active members."""
    now = part_groups(spark, sf_dir)
    before = now.where("group_id % 13 <> 5").withColumn("parent_group_id", F.when(F.col("group_id") % 7 == 3, F.expr("group_id div 5")).otherwise(F.col("parent_group_id")))
    own = part_active_groups(spark, sf_dir).where("group_id % 4 <> 1").unionByName(now.where("group_id % 97 = 1").select("group_id"))
    return materialize(flag_inactive(before, own)), materialize(own)


def _incremental(direction: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored, own = _stored_groups(spark, sf_dir)
        if direction == ANCESTORS:
            stored = materialize(flag_inactive(stored, own, direction=ANCESTORS))
        now = update_inactive(part_groups(spark, sf_dir), stored, own, part_active_groups(spark, sf_dir), direction=direction)
        return now.select("group_id", "parent_group_id", "inactive")

    return run


register("group_inactive_incremental", GROUP_INACTIVE_DESC_SQL)(_incremental(DESCENDANTS))
register(
    "group_inactive_anc",
    _TREE_SQL
    + """
SELECT group_id, parent_group_id,
       group_id NOT IN (SELECT root FROM tree WHERE node IN (SELECT group_id FROM act)) AS inactive
FROM g""",
)(_group_query(ANCESTORS, "auto"))


# ---------------------------------------------------------------------------
# J-03: per-day activity snapshot, second day replayed
# ---------------------------------------------------------------------------
DAY1, DAY2 = "2001-04-01", "2001-08-01"
# what makes a customer active on a day, read over all orders
ACTIVE = {DAY1: ("F", "1-URGENT"), DAY2: ("O", "5-LOW")}


def _active_on(spark, sf_dir, day) -> DataFrame:
    status, priority = ACTIVE[day]
    o = table(spark, sf_dir, "orders")
    return o.filter((F.col("o_orderstatus") == status) & (F.col("o_orderpriority") == priority)).select(
        F.col("o_custkey").alias("agent_id")
    )


def _active_sql(day: str) -> str:
    status, priority = ACTIVE[day]
    return f"c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = '{status}' AND o_orderpriority = '{priority}')"


@register(
    "status_snapshot",
    f"""
SELECT c_custkey AS agent_id, DATE '{DAY1}' AS sync_date, {_active_sql(DAY1)} AS is_active, 'keep' AS _action
FROM customer
UNION ALL
SELECT c_custkey, DATE '{DAY2}', {_active_sql(DAY2)}, 'update'
FROM customer""",
)
def status_snapshot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-03: (agent, sync date) -> is_active, upserted per day into the flow's partitions; a day run again overwrites in place."""
    agents = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("agent_id"))
    store = TableStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/status-{uuid.uuid4().hex}")
    wrong = status_snapshot(flag_active(agents, _active_on(spark, sf_dir, DAY1), "agent_id"), DAY2)
    first, second = (status_snapshot(flag_active(agents, _active_on(spark, sf_dir, d), "agent_id"), d) for d in (DAY1, DAY2))
    for snap in (first, wrong, second):  # the second day was first run with the first day's list
        # the plan reads the folder that it replaces a partition of: its rows are cut off first
        merged = materialize(upsert_snapshot(store.read_partitioned("agent_status_history", AGENT_STATUS_HISTORY_DDL), snap))
        store.overwrite_partitions("agent_status_history", current_rows(merged.where(F.col(ACTION) != KEEP)), ["sync_date"])
    return upsert_snapshot(store.read_partitioned("agent_status_history", AGENT_STATUS_HISTORY_DDL), second)


# ---------------------------------------------------------------------------
# J-13 / K-01: watermark that never moves back, delta since the mark
# ---------------------------------------------------------------------------
def _watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    state = empty_state(spark)
    # each batch brings its own latest time: the mark takes the greatest and never moves back
    for rest in range(5):
        state = advance_watermark(state, ev.filter(F.pmod("event_id", F.lit(5)) == rest), "events", "ts")
    return state


@register(
    "watermark_state",
    f"SELECT 'events' AS pipeline_name, max(ts) AS last_processed_time FROM events",
)
def watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _watermark_state(spark, sf_dir)


@register(
    "watermark_delta",
    f"""
SELECT event_id, user_id, ts FROM events
WHERE ts IS NULL OR ts >= (SELECT max(ts) FROM events)""",
)
def watermark_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return since_watermark(ev, _watermark_state(spark, sf_dir), "events", "ts")


# ---------------------------------------------------------------------------
# M-02 / K-02 / K-03: three daily batches folded in order, one replayed
# ---------------------------------------------------------------------------
def _batch(o: DataFrame, lo: str | None, hi: str | None, shift_days: int, factor: int, tag: str, n: int) -> DataFrame:
    d = F.col("o_orderdate")
    cond = F.lit(True)
    if lo:
        cond = cond & (d >= _ts(lo))
    if hi:
        cond = cond & (d < _ts(hi))
    late = F.col("o_orderpriority") == "1-URGENT"
    shift = F.expr(f"INTERVAL {abs(shift_days)} DAYS")
    upd = d if shift_days == 0 else F.when(late & (F.lit(n) == 2), d - shift).otherwise(d + shift)
    return o.filter(cond).select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.col("o_orderstatus"), F.lit(tag)).alias("status"),
        (F.col("o_totalprice") * factor).alias("total"),
        upd.alias("updated_at"),
        F.lit(n).alias("batch_no"),
    )


def backfill_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    o = table(spark, sf_dir, "orders")
    b1 = _batch(o, None, "1997-01-01", 0, 1, "1", 1)
    b2 = _batch(o, "1996-01-01", "1999-01-01", 5, 2, "2", 2)
    b3 = _batch(o, "1998-07-01", None, 20, 3, "3", 3)
    return [b1, b2, b2, b3]  # day 2 is replayed


@register(
    "backfill_three_days",
    """
WITH b AS (
  SELECT o_orderkey AS order_id, o_orderstatus || '1' AS status, o_totalprice AS total,
         o_orderdate AS updated_at, 1 AS batch_no
  FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
  UNION ALL
  SELECT o_orderkey, o_orderstatus || '2', o_totalprice * 2,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate - INTERVAL 5 DAY
              ELSE o_orderdate + INTERVAL 5 DAY END, 2
  FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
  UNION ALL
  SELECT o_orderkey, o_orderstatus || '3', o_totalprice * 3, o_orderdate + INTERVAL 20 DAY, 3
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01')
SELECT order_id, status, total, updated_at, batch_no FROM b
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, batch_no DESC) = 1""",
)
def backfill_three_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-02/K-02/K-03: fold the guarded merge over ordered days; late rows
    never overwrite newer state and replaying a day changes nothing."""
    batches = backfill_batches(spark, sf_dir)
    core = spark.createDataFrame([], batches[0].schema)
    for b in batches:
        # each day starts from the version the previous day wrote
        core = materialize(current_rows(merge_latest(core, b, ["order_id"], guard="updated_at", null_guard="reject")))
    return core
