"""TableStore: versions, vacuum, bucketed tables and their switch, the key index, the ledger."""

from __future__ import annotations

import pytest

from syncforge.operators.merge import merge_latest
from syncforge.sinks.keyindex import KeyIndex
from syncforge.sinks.tables import TableStore

DDL = "k bigint, v string"


def test_versions_and_vacuum(spark, tmp_root):
    st = TableStore(spark, tmp_root)
    assert st.read("t", DDL).count() == 0
    for i in range(4):
        st.write_version("t", spark.createDataFrame([(i, str(i))], DDL))
    assert st.versions("t") == [1, 2, 3, 4]
    assert [r.k for r in st.read("t", DDL).collect()] == [3]
    st.vacuum("t", keep=2)
    assert st.versions("t") == [3, 4]


def merged(st, rows, run):
    """A merge of rows into the touched buckets of table t."""
    staged = st.spark.createDataFrame(rows, DDL)
    old = st.read_buckets("t", DDL, st.touched(staged, "k")).drop("bucket")
    out = merge_latest(old, staged, ["k"]).drop("_action")
    st.stage_buckets("t", run, out.withColumn("bucket", st.bucket("k")))
    return staged


def test_buckets_are_merged_and_switched(spark, tmp_root):
    st = TableStore(spark, tmp_root, buckets=8)
    merged(st, [(i, "a") for i in range(40)], 1)
    assert st.read_buckets("t", DDL).count() == 0  # staged only
    st.switch_buckets("t", 1)
    st.switch_buckets("t", 1)  # may be repeated
    assert {r.k: r.v for r in st.read_buckets("t", DDL).collect()} == {i: "a" for i in range(40)}
    before = {r.bucket: r.k for r in st.read_buckets("t", DDL).collect()}
    merged(st, [(2, "b"), (99, "b")], 2)
    touched = {r.bucket for r in st.touched(spark.createDataFrame([(2,), (99,)], "k bigint"), "k").collect()}
    import os

    assert {n for n in os.listdir(f"{tmp_root}/_switch/run=2/t") if n.startswith("bucket=")} == {f"bucket={b}" for b in touched}
    st.switch_buckets("t", 2)
    assert {r.k: r.v for r in st.read_buckets("t", DDL).collect()} == {**{i: "a" for i in range(40)}, 2: "b", 99: "b"}
    assert len(before) == 8
    with pytest.raises(ValueError):
        TableStore(spark, tmp_root, buckets=9)


def test_switch_is_taken_up_after_a_failure(spark, tmp_root, monkeypatch):
    st = TableStore(spark, tmp_root, buckets=8)
    merged(st, [(i, "a") for i in range(40)], 1)
    st.switch_buckets("t", 1)
    merged(st, [(i, "b") for i in range(40)], 2)
    calls = []
    delete = TableStore._delete

    def dies(self, path):
        calls.append(path)
        if len(calls) == 4:
            raise OSError("lost")
        delete(self, path)

    monkeypatch.setattr(TableStore, "_delete", dies)
    with pytest.raises(OSError):
        st.switch_buckets("t", 2)
    monkeypatch.undo()
    assert {r.v for r in st.read_buckets("t", DDL).collect()} == {"a", "b"}
    st.switch_buckets("t", 2)
    assert {r.k: r.v for r in st.read_buckets("t", DDL).collect()} == {i: "b" for i in range(40)}


def test_only_touched_buckets_are_read(spark, tmp_root):
    st = TableStore(spark, tmp_root, buckets=8)
    merged(st, [(i, "a") for i in range(400)], 1)
    st.switch_buckets("t", 1)
    staged = spark.createDataFrame([(3, "c"), (3, "d")], DDL)
    touched = st.read_buckets("t", DDL, st.touched(staged, "k"))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert {r.bucket for r in touched.collect()} == {r.bucket for r in st.touched(staged, "k").collect()}


def test_key_index_opens_only_possible_buckets(spark, tmp_root):
    st = TableStore(spark, tmp_root, buckets=16)
    index = KeyIndex(st, "t", "key", "id", blocks=1)
    kind = "key string, id string"
    stored = [(f"k{i}", f"o{i}") for i in range(300)]
    index.stage(1, spark.createDataFrame(stored, kind), spark.createDataFrame([], kind))
    index.switch(1)
    staged = spark.createDataFrame([(f"k{i}", "n") for i in (5, 7)] + [(f"new{i}", "n") for i in range(200)] + [(None, "n")], kind)
    assert {tuple(r) for r in index.owners(staged).select("key", "id").collect()} == {("k5", "o5"), ("k7", "o7")}
    maybe = {r.key for r in index.maybe_stored(staged).collect()}
    assert {"k5", "k7"} <= maybe and len(maybe) < 12  # few false alarms
    plan = index.owners(staged)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("dynamicpruning") >= 2
    # a key passes to another owner, one goes, one comes
    index.stage(2, spark.createDataFrame([("k5", "z"), ("k900", "z")], kind), spark.createDataFrame([("k5", "o5"), ("k6", "o6")], kind))
    index.switch(2)
    got = {tuple(r) for r in st.read_buckets("t_keys", kind).select("key", "id").collect()}
    assert got == set(stored) - {("k5", "o5"), ("k6", "o6")} | {("k5", "z"), ("k900", "z")}
    assert {r.key for r in index.owners(spark.createDataFrame([("k900", "n"), ("k6", "n")], kind)).collect()} == {"k900"}


def test_ledger(spark, tmp_root):
    st = TableStore(spark, tmp_root)
    assert (st.run_number("d1"), st.run_number("d1"), st.run_number("d2")) == (1, 1, 2)
    st.commit(1, "a", {"n": 3})
    assert st.committed(1, "a") and st.report(1, "a") == {"n": 3} and not st.committed(2, "a")
    st.commit(1, "_finished", {})
    assert st.finished_run("d1") == 1 and st.finished_run("d2") is None
    assert (st.run_number("d1"), st.run_number("d2")) == (3, 2)


def test_partition_overwrite_is_idempotent(spark, tmp_root):
    st = TableStore(spark, tmp_root)
    df = spark.createDataFrame([(1, "d1"), (2, "d1")], "k bigint, day string")
    st.overwrite_partitions("q", df, ["day"])
    st.overwrite_partitions("q", spark.createDataFrame([(5, "d2")], "k bigint, day string"), ["day"])
    st.overwrite_partitions("q", df, ["day"])  # re-run of d1
    got = sorted((r.k, r.day) for r in st.read_partitioned("q", "k bigint, day string").collect())
    assert got == [(1, "d1"), (2, "d1"), (5, "d2")]


def test_clashes_do_not_shuffle_the_batch(spark, tmp_root):
    from syncforge.plans.flow import key_index, split_clashes

    row = ["cast(id as string) as transaction_id", "cast(if(id < 2, 0, id) as string) as idempotency_key"]
    spark.range(20000).selectExpr(*row).write.parquet(f"{tmp_root}/batch")
    staged = spark.read.parquet(f"{tmp_root}/batch")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")  # far less than the batch
    try:
        good, bad = split_clashes(staged, key_index(TableStore(spark, f"{tmp_root}/s", buckets=4)))
        plan = good._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert good.count() == 19998 and {r.transaction_id for r in bad.collect()} == {"0", "1"}
