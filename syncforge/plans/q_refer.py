"""Reference and dedup queries (D-01..D-05, D-07, D-08, E-01, F-01..F-06,
G-01, J-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncforge.operators.dedup import latest_per_key
from syncforge.operators.merge import merge_latest
from syncforge.operators.refer import deactivate_absent, flag_active, flag_known, split_known
from syncforge.operators.uniqueness import duplicate_keys
from syncforge.plans.registry import register
from syncforge.plans.tables import table


@register(
    "status_from_active_list",
    f"""
SELECT c_custkey AS agent_id, c_name AS name,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
            THEN 'active' ELSE 'inactive' END AS status
FROM customer""",
)
def status_from_active_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-01: status from membership in the day's active list (distinct ids)."""
    agents = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("agent_id"), F.col("c_name").alias("name"))
    active = (
        table(spark, sf_dir, "orders")
        .filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
        .select(F.col("o_custkey").alias("agent_id"))
    )
    return flag_active(agents, active, "agent_id")


def _lines_with_null_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    null_part = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F") & (F.col("l_quantity") > 48)
    return li.select(
        "l_orderkey", "l_linenumber", F.when(null_part, F.lit(None)).otherwise(F.col("l_partkey")).alias("l_partkey")
    )


def _known_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter(F.col("p_size") <= 25).select(F.col("p_partkey").alias("l_partkey"))


_LINES_SQL = """
WITH li AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity > 48 THEN NULL
              ELSE l_partkey END AS l_partkey
  FROM lineitem)"""


@register(
    "semi_split",
    _LINES_SQL
    + """
SELECT * FROM li WHERE EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = li.l_partkey AND p.p_size <= 25)""",
)
def semi_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-02/D-08: rows whose reference exists (semi join; NULL keys excluded)."""
    known, _ = split_known(_lines_with_null_parts(spark, sf_dir), _known_parts(spark, sf_dir), ["l_partkey"])
    return known


@register(
    "anti_split",
    _LINES_SQL
    + """
SELECT * FROM li WHERE l_partkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = li.l_partkey AND p.p_size <= 25)""",
)
def anti_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-03/D-05/D-07: rows whose reference is missing (anti join, NULL keys excluded first)."""
    _, unknown = split_known(_lines_with_null_parts(spark, sf_dir), _known_parts(spark, sf_dir), ["l_partkey"])
    return unknown


@register(
    "known_flag",
    """
SELECT l_orderkey, l_linenumber, l_suppkey,
       l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) AS is_known
FROM lineitem""",
)
def known_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-04: one pass, every row kept with a known/unknown flag."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    sup = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("l_suppkey"))
    return flag_known(li, sup, ["l_suppkey"])


def _events_with_null_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(None).cast("timestamp")).otherwise(F.col("ts")).alias("ts"),
        "event_type",
    )


_EVENTS_SQL = """
WITH e AS (
  SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts, event_type
  FROM events)"""


@register(
    "latest_per_key_nulls_last",
    _EVENTS_SQL
    + """
SELECT * FROM e
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""",
)
def latest_nulls_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-01/F-03: latest row per key, NULL timestamps last, deterministic tie-break."""
    return latest_per_key(
        _events_with_null_ts(spark, sf_dir), ["user_id"], ["ts desc_nulls_last"], tie_break=["event_id desc"]
    )


@register(
    "latest_per_key_nulls_first",
    _EVENTS_SQL
    + """
SELECT * FROM e
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) = 1""",
)
def latest_nulls_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-02: ``DISTINCT ON ... ORDER BY ts DESC`` with Postgres' NULLS FIRST default."""
    return latest_per_key(
        _events_with_null_ts(spark, sf_dir), ["user_id"], ["ts desc_nulls_first"], tie_break=["event_id desc"]
    )


@register(
    "key_uniqueness",
    """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-15: natural keys that occur more than once."""
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


ABSENT_SPLIT = "1998-07-01"


@register(
    "agents_mark_absent",
    f"""
WITH c AS (SELECT DISTINCT o_custkey AS agent_id FROM orders WHERE o_orderdate < TIMESTAMP '{ABSENT_SPLIT}'),
s AS (SELECT DISTINCT o_custkey AS agent_id FROM orders WHERE o_orderdate >= TIMESTAMP '{ABSENT_SPLIT}')
SELECT COALESCE(c.agent_id, s.agent_id) AS agent_id,
       CASE WHEN s.agent_id IS NULL THEN 'inactive' ELSE 'active' END AS status,
       CASE WHEN c.agent_id IS NULL THEN 'insert' WHEN s.agent_id IS NULL THEN 'keep' ELSE 'update' END AS _action
FROM c FULL OUTER JOIN s ON c.agent_id = s.agent_id""",
)
def agents_mark_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-01 option: agents stored before the split but absent from the later
    snapshot become inactive ("present on day N, missing on day N+1")."""
    o = table(spark, sf_dir, "orders")
    split = F.lit(ABSENT_SPLIT).cast("timestamp")
    core = o.filter(F.col("o_orderdate") < split).select(F.col("o_custkey").alias("agent_id")).distinct()
    snap = o.filter(F.col("o_orderdate") >= split).select(F.col("o_custkey").alias("agent_id")).distinct()
    active = F.lit("active").alias("status")
    return deactivate_absent(merge_latest(core.select("agent_id", active), snap.select("agent_id", active), ["agent_id"]))
