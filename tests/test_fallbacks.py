"""Joins give the same result whether AQE may broadcast or not."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from syncforge.operators.fx import convert_to_usd
from syncforge.operators.merge import ACTION, merge_latest
from syncforge.operators.refer import split_known


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _both(spark, make):
    """Rows with broadcasts allowed, then without."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    first = _rows(make())
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return first, _rows(make())
    finally:
        spark.conf.set(key, before)


def test_fx_shuffle_path_equals_broadcast(spark):
    d = dt.date(2024, 5, 1)
    txn = spark.createDataFrame(
        [(1, d, "EUR", 10.0, None), (2, d, "GBP", 5.0, 1.25), (3, d, "JPY", 7.0, None), (4, d, "USD", 2.0, None), (5, None, "USD", 1.0, None)],
        "id int, fx_date date, original_currency string, original_amount double, payload_exchange_rate double",
    )
    rates = spark.createDataFrame([(d, "EUR", 0.8), (d, "eur", 0.8)], "fx_date date, currency string, usd_quote double")
    small, shuffled = _both(spark, lambda: convert_to_usd(txn, rates))
    assert small == shuffled
    got = {r.id: (r.exchange_rate, r.fx_source) for r in convert_to_usd(txn, rates).collect()}
    assert got == {1: (1.25, "API"), 2: (1.25, "PAYLOAD"), 3: (None, "MISSING"), 4: (1.0, "API"), 5: (None, "MISSING")}


def test_split_known_shuffle_path_equals_broadcast(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 0)], "k bigint, v bigint"))
    ref = spark.range(0, 200, 3).select(F.col("id").alias("k"))
    for side in (0, 1):
        small, shuffled = _both(spark, lambda side=side: split_known(df, ref, ["k"])[side])
        assert small == shuffled
    known, unknown = split_known(df, ref, ["k"])
    assert known.count() + unknown.count() == 200  # the NULL key is in neither


def test_merge_paths_equal_on_random_batches(spark):
    core = spark.range(0, 300).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.expr("timestamp'2024-01-01' + make_interval(0,0,0, id % 5)").alias("u")
    )
    stg = spark.range(150, 450).select(
        F.col("id").alias("k"), (F.col("id") % 11).alias("v"), F.expr("timestamp'2024-01-01' + make_interval(0,0,0, id % 9)").alias("u")
    )
    small, shuffled = _both(spark, lambda: merge_latest(core, stg, ["k"], guard="u"))
    assert small == shuffled
    acts = {r[ACTION] for r in merge_latest(core, stg, ["k"], guard="u").collect()}
    assert acts == {"insert", "update", "stale", "keep"}
