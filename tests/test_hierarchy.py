"""Hierarchy activity against a brute-force walk on random graphs with cycles."""

from __future__ import annotations

import random

import pytest

from syncforge.operators.hierarchy import ANCESTORS, DESCENDANTS, active_groups, flag_inactive, update_inactive


def brute(parent: dict, active: set, direction: str) -> set:
    """Walk up from every node (cycle-safe) and apply the direction's rule."""
    out = set()
    for start in parent:
        seen, node = [], start
        while node is not None and node in parent and node not in seen:
            seen.append(node)
            node = parent[node]
        if direction == ANCESTORS and any(n in active for n in seen):
            out.add(start)
        if direction == DESCENDANTS and start in active:
            out.update(seen)
    return out


def random_graph(seed: int, n: int):
    rnd = random.Random(seed)
    parent = {}
    for i in range(n):
        r = rnd.random()
        if r < 0.1:
            parent[i] = None
        elif r < 0.15:
            parent[i] = i  # self-loop
        elif r < 0.2:
            parent[i] = n + rnd.randrange(5)  # parent that is not a group
        else:
            parent[i] = rnd.randrange(n)  # may close cycles
    active = {rnd.randrange(n + 3) for _ in range(max(1, n // 8))}  # may name non-groups
    return parent, active


def _frames(spark, parent, active):
    g = spark.createDataFrame(list(parent.items()), "group_id bigint, parent_group_id bigint")
    a = spark.createDataFrame([(x,) for x in active], "group_id bigint")
    return g, a


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("direction", [DESCENDANTS, ANCESTORS])
@pytest.mark.parametrize("method", ["frontier", "doubling", "auto"])
def test_random_graphs(spark, seed, direction, method):
    parent, active = random_graph(seed, 60)
    g, a = _frames(spark, parent, active)
    got = {r.group_id for r in active_groups(g, a, direction=direction, method=method).collect()}
    assert got == brute(parent, active, direction)


@pytest.mark.parametrize("method", ["auto", "doubling"])
def test_deep_chain(spark, method):
    n = 130  # deeper than a default recursive-CTE limit of 100
    parent = {i: (i - 1 if i > 0 else None) for i in range(n)}
    g, a = _frames(spark, parent, {n - 1})
    got = {r.group_id for r in active_groups(g, a, method=method).collect()}
    assert got == set(range(n))


def test_direction_cases(spark):
    # 1 is the parent of 2; only 2 has an active member
    g, a = _frames(spark, {1: None, 2: 1, 3: 3, 4: 5, 5: 4}, {2, 4})
    desc = {r.group_id: r.inactive for r in flag_inactive(g, a, direction=DESCENDANTS).collect()}
    anc = {r.group_id: r.inactive for r in flag_inactive(g, a, direction=ANCESTORS).collect()}
    assert desc == {1: False, 2: False, 3: True, 4: False, 5: False}
    assert anc == {1: True, 2: False, 3: True, 4: False, 5: False}


@pytest.mark.parametrize("method", ["frontier", "doubling"])
@pytest.mark.parametrize("direction", [DESCENDANTS, ANCESTORS])
def test_parent_of_many(spark, direction, method):
    # one root with 100,000 children, one of them active
    g = spark.range(100_001).selectExpr("id as group_id", "if(id = 0, null, 0L) as parent_group_id")
    a = spark.createDataFrame([(0 if direction == ANCESTORS else 5,)], "group_id bigint")
    n = active_groups(g, a, direction=direction, method=method).count()
    assert n == (100_001 if direction == ANCESTORS else 2)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
@pytest.mark.parametrize("direction", [DESCENDANTS, ANCESTORS])
def test_update_equals_full_recompute(spark, seed, direction):
    """Random forests with cycles; groups come, go and move, members change."""
    rnd = random.Random(100 + seed)
    parent, active = random_graph(seed, 60)
    before = flag_inactive(*_frames(spark, parent, active), direction=direction)
    later, own = dict(parent), set(active)
    for x in rnd.sample(sorted(parent), 6):
        later[x] = rnd.choice([None, x, *parent, 999])
    for x in rnd.sample(sorted(parent), 4):
        later.pop(x)
    later.update({1000 + i: rnd.choice([None, *parent, 1000]) for i in range(3)})
    own ^= set(rnd.sample(range(70), 5)) | {1001}
    g, a = _frames(spark, later, own)
    _, was = _frames(spark, parent, active)
    got = {r.group_id: r.inactive for r in update_inactive(g, before, was, a, direction=direction).collect()}
    live = brute(later, own, direction)
    assert got == {x: x not in live for x in later}


def test_update_touches_what_changed(spark):
    """10,000 chains of three: one changed member touches one chain, no change touches nothing."""
    g = spark.range(30_000).selectExpr("id as group_id", "if(id % 3 = 0, null, id - 1) as parent_group_id")
    was = spark.createDataFrame([(2,), (300,)], "group_id bigint")
    stored = flag_inactive(g, was)
    now = spark.createDataFrame([(2,), (301,), (300,)], "group_id bigint")
    rows = update_inactive(g, stored, was, now).where("_recomputed").collect()
    assert {r.group_id: r.inactive for r in rows} == {301: False, 300: False}
    assert update_inactive(g, stored, was, was).where("_recomputed").count() == 0


def test_nothing_active_and_no_groups(spark):
    g, _ = _frames(spark, {1: None, 2: 1}, set())
    none = spark.createDataFrame([], "group_id bigint")
    empty = spark.createDataFrame([], "group_id bigint, parent_group_id bigint")
    for method in ("frontier", "doubling", "auto"):
        assert active_groups(g, none, method=method).count() == 0
        assert active_groups(empty, none, method=method).count() == 0


def test_changes_are_cut_before_they_spread(spark, monkeypatch):
    from syncforge.operators import hierarchy

    plans, real = [], hierarchy.active_groups

    def seen(groups, ids, *args):
        plans.append(ids._jdf.queryExecution().analyzed().toString())
        return real(groups, ids, *args)

    monkeypatch.setattr(hierarchy, "active_groups", seen)
    ddl = "group_id bigint, parent_group_id bigint"
    stored = spark.createDataFrame([(1, None, False), (2, 1, False)], f"{ddl}, inactive boolean")
    groups = spark.createDataFrame([(1, None), (2, 1), (3, 1)], ddl)
    was, now = (spark.createDataFrame([(x,)], "group_id bigint") for x in (2, 3))
    got = {r.group_id: r.inactive for r in update_inactive(groups, stored, was, now).collect()}
    assert got == {1: False, 2: True, 3: False}
    assert len(plans) == 2 and not any("Join" in p for p in plans)
