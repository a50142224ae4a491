"""Merge, assignments, membership, watermark, dedup: small exact cases and properties."""

from __future__ import annotations

import datetime as dt

import pytest

from syncforge.operators.assignments import assignment_history, merge_assignments
from syncforge.operators.dedup import latest_per_key
from syncforge.operators.membership import replace_members
from syncforge.operators.merge import ACTION, current_rows, merge_latest
from syncforge.operators.metrics import merge_counts
from syncforge.operators.snapshot import upsert_snapshot
from syncforge.operators.uniqueness import split_unique
from syncforge.operators.watermark import advance_watermark, empty_state, since_watermark

T = dt.datetime
DDL = "k bigint, v string, created_at timestamp, updated_at timestamp"


def _frames(spark):
    core = spark.createDataFrame(
        [
            (1, "old", T(2024, 1, 1), T(2024, 5, 1)),  # older staged -> stale
            (2, "old", T(2024, 1, 1), T(2024, 5, 1)),  # equal -> update
            (3, "old", T(2024, 1, 1), T(2024, 5, 1)),  # newer -> update
            (4, "old", T(2024, 1, 1), None),  # stored NULL
            (5, "old", T(2024, 1, 1), T(2024, 5, 1)),  # staged NULL
            (6, "old", T(2024, 1, 1), T(2024, 5, 1)),  # not staged -> keep
        ],
        DDL,
    )
    stg = spark.createDataFrame(
        [
            (1, "new", T(2024, 3, 1), T(2024, 4, 1)),
            (2, "new", T(2024, 3, 1), T(2024, 5, 1)),
            (3, "new", T(2024, 3, 1), T(2024, 6, 1)),
            (4, "new", T(2024, 3, 1), T(2024, 6, 1)),
            (5, "new", T(2024, 3, 1), None),
            (7, "new", T(2024, 3, 1), T(2024, 6, 1)),  # insert
        ],
        DDL,
    )
    return core, stg


def test_guard_reject(spark):
    core, stg = _frames(spark)
    m = merge_latest(core, stg, ["k"], guard="updated_at", null_guard="reject", keep=["created_at"])
    got = {r.k: (r.v, r[ACTION], r.created_at) for r in m.collect()}
    assert {k: a for k, (_, a, _) in got.items()} == {
        1: "stale", 2: "update", 3: "update", 4: "stale", 5: "stale", 6: "keep", 7: "insert"
    }
    assert got[3][2] == T(2024, 1, 1)  # created_at kept on update
    assert got[7][2] == T(2024, 3, 1)


def test_guard_accept_if_stored_null(spark):
    core, stg = _frames(spark)
    m = merge_latest(core, stg, ["k"], guard="updated_at", null_guard="accept_if_stored_null")
    acts = {r.k: r[ACTION] for r in m.collect()}
    assert acts[4] == "update" and acts[5] == "stale" and acts[1] == "stale"


def test_unguarded_and_counts(spark):
    core, stg = _frames(spark)
    m = merge_latest(core, stg, ["k"])
    c = merge_counts(m).first()
    assert (c.rows_inserted, c.rows_updated, c.rows_stale, c.rows_kept, c.rows_affected) == (1, 5, 0, 1, 6)


def test_merge_twice_equals_once(spark):
    core, stg = _frames(spark)
    once = current_rows(merge_latest(core, stg, ["k"], guard="updated_at"))
    twice = current_rows(merge_latest(once, stg, ["k"], guard="updated_at"))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_staging_dedup_deterministic(spark):
    df = spark.createDataFrame(
        [(1, "a", T(2024, 1, 1)), (1, "b", T(2024, 1, 2)), (1, "c", None), (2, "x", None), (2, "y", None)],
        "k bigint, v string, ts timestamp",
    )
    last = {r.k: r.v for r in latest_per_key(df, ["k"], ["ts desc_nulls_last"]).collect()}
    first = {r.k: r.v for r in latest_per_key(df, ["k"], ["ts desc_nulls_first"]).collect()}
    assert last[1] == "b" and first[1] == "c"
    again = {r.k: r.v for r in latest_per_key(df.repartition(3), ["k"], ["ts desc_nulls_last"]).collect()}
    assert again == last  # ties on NULL resolve the same way


def test_assignments_soft_delete_and_history(spark):
    run = T(2024, 6, 1)
    cur = spark.createDataFrame(
        [
            (1, 10, "assigned", T(2024, 1, 1), None, T(2024, 1, 1)),  # still staged -> update
            (1, 11, "assigned", T(2024, 1, 1), None, T(2024, 1, 1)),  # missing -> remove
            (1, 12, "removed", T(2024, 1, 1), T(2024, 2, 1), T(2024, 2, 1)),  # back -> reassign
            (1, 13, "removed", T(2024, 1, 1), T(2024, 2, 1), T(2024, 2, 1)),  # still missing -> keep
        ],
        "agent_id bigint, role_id bigint, status string, assigned_at timestamp, removed_at timestamp, updated_at timestamp",
    )
    stg = spark.createDataFrame([(1, 10), (1, 12), (2, 10), (2, 10)], "agent_id bigint, role_id bigint")
    m = merge_assignments(cur, stg, run)
    got = {(r.agent_id, r.role_id): r for r in m.collect()}
    assert {k: r[ACTION] for k, r in got.items()} == {
        (1, 10): "update", (1, 11): "remove", (1, 12): "reassign", (1, 13): "keep", (2, 10): "insert"
    }
    assert got[(1, 11)].status == "removed" and got[(1, 11)].removed_at == run
    assert got[(1, 12)].status == "assigned" and got[(1, 12)].assigned_at == T(2024, 1, 1) and got[(1, 12)].removed_at is None
    assert got[(1, 13)].updated_at == T(2024, 2, 1)
    hist = {(r.agent_id, r.role_id, r.action) for r in assignment_history(m, run).collect()}
    assert hist == {(1, 11, "removed"), (1, 12, "assigned"), (2, 10, "assigned")}
    # re-run with the same snapshot: no history, nothing removed
    m2 = merge_assignments(current_rows(m), stg, run)
    assert assignment_history(m2, run).count() == 0


def test_membership_replace_clears_emptied_groups(spark):
    cur = spark.createDataFrame([(1, 10), (1, 11), (2, 20), (3, 30)], "group_id bigint, agent_id bigint")
    staged = spark.createDataFrame([(1, 12), (1, 12)], "group_id bigint, agent_id bigint")
    groups = spark.createDataFrame([(1,), (2,)], "group_id bigint")  # group 2 listed without members
    got = sorted((r.group_id, r.agent_id) for r in replace_members(cur, staged, groups).collect())
    assert got == [(1, 12), (3, 30)]


def test_membership_replace_sorts_no_members(spark):
    pairs = spark.createDataFrame([(1, 10), (2, 20)], "group_id bigint, agent_id bigint")
    plan = replace_members(pairs, pairs, pairs.select("group_id"))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan


def test_status_upsert_tells_what_it_did(spark):
    ddl = "agent_id bigint, sync_date string, is_active boolean"
    history = spark.createDataFrame([(1, "d1", True), (None, "d1", False), (1, "d2", True), (None, "d2", True)], ddl)
    snap = spark.createDataFrame([(1, "d2", False), (1, "d2", False), (None, "d2", False), (2, "d2", True)], ddl)
    got = sorted(map(str, upsert_snapshot(history, snap).select("agent_id", "sync_date", "is_active", ACTION).rdd.map(tuple).collect()))
    assert got == sorted(map(str, [
        (1, "d1", True, "keep"), (None, "d1", False, "keep"), (1, "d2", False, "update"), (1, "d2", False, "update"),
        (None, "d2", False, "update"), (2, "d2", True, "insert"),
    ]))


def test_watermark_never_moves_back(spark):
    b1 = spark.createDataFrame([(T(2024, 5, 3),), (T(2024, 5, 1),)], "u timestamp")
    b2 = spark.createDataFrame([(T(2024, 4, 1),), (None,)], "u timestamp")
    s = advance_watermark(empty_state(spark), b1, "t", "u")
    s = advance_watermark(s, b2, "t", "u")
    assert s.collect()[0].last_processed_time == T(2024, 5, 3)
    rows = spark.createDataFrame([(1, T(2024, 5, 3)), (2, T(2024, 5, 2)), (3, None)], "id int, u timestamp")
    assert sorted(r.id for r in since_watermark(rows, s, "t", "u").collect()) == [1, 3]
    assert since_watermark(rows, empty_state(spark), "t", "u").count() == 3


def test_split_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "key string, id int")
    uniq, dup = split_unique(df, ["key"])
    assert [r.id for r in uniq.collect()] == [3] and sorted(r.id for r in dup.collect()) == [1, 2]


def test_deactivate_absent(spark):
    from syncforge.operators.refer import deactivate_absent

    core = spark.createDataFrame([(1, "active"), (2, "active")], "agent_id bigint, status string")
    stg = spark.createDataFrame([(1, "active")], "agent_id bigint, status string")
    m = deactivate_absent(merge_latest(core, stg, ["agent_id"]))
    assert {r.agent_id: r.status for r in m.collect()} == {1: "active", 2: "inactive"}
