"""Merge queries: orders split into a stored core and a later staging batch.

Core = orders dated before 2000, stamped ``updated_at = o_orderdate`` (NULL
for unspecified-priority fulfilled orders). Staging = orders from 1998 on,
with changed values and an ``updated_at`` that is older (URGENT), equal
(HIGH), NULL (LOW) or newer (others) than the stored one. The two years of
overlap exercise every guard branch; all orders take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncforge.operators.merge import merge_latest
from syncforge.operators.metrics import merge_counts
from syncforge.plans.registry import register
from syncforge.plans.tables import table

SPLIT_CORE_BEFORE = "2000-01-01"
SPLIT_STAGING_FROM = "1998-01-01"


def orders_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderdate") < F.lit(SPLIT_CORE_BEFORE).cast("timestamp")).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("created_at"),
        F.when(
            (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "F"),
            F.lit(None).cast("timestamp"),
        )
        .otherwise(F.col("o_orderdate"))
        .alias("updated_at"),
    )


def orders_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    d = F.col("o_orderdate")
    return o.filter(d >= F.lit(SPLIT_STAGING_FROM).cast("timestamp")).select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.col("o_orderstatus"), F.lit("2")).alias("status"),
        (F.col("o_totalprice") * 2).alias("total"),
        p.alias("priority"),
        (d + F.expr("INTERVAL 1 DAY")).alias("created_at"),
        F.when(p == "1-URGENT", d - F.expr("INTERVAL 30 DAYS"))
        .when(p == "2-HIGH", d)
        .when(p == "5-LOW", F.lit(None).cast("timestamp"))
        .otherwise(d + F.expr("INTERVAL 10 DAYS"))
        .alias("updated_at"),
    )


def orders_staging_with_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging plus an older duplicate of every open order (dedup must drop it)."""
    s = orders_staging(spark, sf_dir)
    dup = s.filter(F.col("status") == "O2").select(
        "order_id",
        F.lit("X").alias("status"),
        F.lit(0.0).alias("total"),
        "priority",
        "created_at",
        (F.col("updated_at") - F.expr("INTERVAL 1 DAY")).alias("updated_at"),
    ).filter(F.col("updated_at").isNotNull())
    return s.unionByName(dup)


_CORE_SQL = """
core AS (
  SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total,
         o_orderpriority AS priority, o_orderdate AS created_at,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F'
              THEN NULL ELSE o_orderdate END AS updated_at
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
),
stg AS (
  SELECT o_orderkey AS order_id, o_orderstatus || '2' AS status, o_totalprice * 2 AS total,
         o_orderpriority AS priority, o_orderdate + INTERVAL 1 DAY AS created_at,
         CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate - INTERVAL 30 DAY
                              WHEN '2-HIGH' THEN o_orderdate
                              WHEN '5-LOW' THEN NULL
                              ELSE o_orderdate + INTERVAL 10 DAY END AS updated_at
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
)"""


def _merge_sql(allowed: str, created: str, updated: str, stg_name: str = "stg") -> str:
    return f"""
j AS (
  SELECT COALESCE(c.order_id, s.order_id) AS order_id,
         CASE WHEN c.order_id IS NULL THEN 'insert'
              WHEN s.order_id IS NULL THEN 'keep'
              WHEN {allowed} THEN 'update' ELSE 'stale' END AS _action,
         c.status AS c_status, s.status AS s_status, c.total AS c_total, s.total AS s_total,
         c.priority AS c_priority, s.priority AS s_priority,
         c.created_at AS c_created, s.created_at AS s_created,
         c.updated_at AS c_updated, s.updated_at AS s_updated
  FROM core c FULL OUTER JOIN {stg_name} s ON c.order_id = s.order_id
)
SELECT order_id,
       CASE WHEN _action IN ('insert', 'update') THEN s_status ELSE c_status END AS status,
       CASE WHEN _action IN ('insert', 'update') THEN s_total ELSE c_total END AS total,
       CASE WHEN _action IN ('insert', 'update') THEN s_priority ELSE c_priority END AS priority,
       {created} AS created_at,
       {updated} AS updated_at,
       _action
FROM j"""


_TAKE_CREATED_KEEP = "CASE WHEN _action = 'insert' THEN s_created ELSE c_created END"
_TAKE_CREATED = "CASE WHEN _action IN ('insert', 'update') THEN s_created ELSE c_created END"
_TAKE_UPDATED = "CASE WHEN _action IN ('insert', 'update') THEN s_updated ELSE c_updated END"
_GREATEST_UPDATED = (
    "CASE WHEN _action = 'insert' THEN s_updated "
    "WHEN _action = 'update' THEN GREATEST(c_updated, s_updated) ELSE c_updated END"
)

MERGE_GUARDED_SQL = (
    "WITH" + _CORE_SQL + ","
    + _merge_sql("s.updated_at >= c.updated_at", _TAKE_CREATED_KEEP, _GREATEST_UPDATED)
)
MERGE_UNGUARDED_SQL = "WITH" + _CORE_SQL + "," + _merge_sql("TRUE", _TAKE_CREATED_KEEP, _TAKE_UPDATED)
MERGE_STORED_NULL_SQL = (
    "WITH" + _CORE_SQL + """,
dup AS (
  SELECT order_id, 'X' AS status, 0.0::DOUBLE AS total, priority, created_at,
         updated_at - INTERVAL 1 DAY AS updated_at
  FROM stg WHERE status = 'O2' AND updated_at IS NOT NULL
),
stg_all AS (SELECT * FROM stg UNION ALL SELECT * FROM dup),
stg_dedup AS (
  SELECT * FROM stg_all
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC NULLS LAST) = 1
),"""
    + _merge_sql(
        "(c.updated_at IS NULL OR s.updated_at >= c.updated_at)",
        _TAKE_CREATED,
        _TAKE_UPDATED,
        stg_name="stg_dedup",
    )
)


@register("merge_guarded", MERGE_GUARDED_SQL)
def merge_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-02: overwrite only when staged updated_at >= stored; NULL either side keeps."""
    return merge_latest(
        orders_core(spark, sf_dir),
        orders_staging(spark, sf_dir),
        keys=["order_id"],
        guard="updated_at",
        null_guard="reject",
        keep=["created_at"],
        greatest=["updated_at"],
    )


@register("merge_unguarded", MERGE_UNGUARDED_SQL)
def merge_unguarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-04 / J-10 / J-11: last batch wins; created_at stays as first stored."""
    return merge_latest(
        orders_core(spark, sf_dir),
        orders_staging(spark, sf_dir),
        keys=["order_id"],
        keep=["created_at"],
    )


@register("merge_stored_null", MERGE_STORED_NULL_SQL)
def merge_stored_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-12 with F-03: dedup staging (updated desc, nulls last), then a guard
    that accepts any staged row when the stored timestamp is NULL."""
    return merge_latest(
        orders_core(spark, sf_dir),
        orders_staging_with_dups(spark, sf_dir),
        keys=["order_id"],
        guard="updated_at",
        null_guard="accept_if_stored_null",
        staging_order=["updated_at desc_nulls_last"],
    )


MERGE_METRICS_SQL = (
    """
SELECT count(*) FILTER (WHERE _action = 'insert') AS rows_inserted,
       count(*) FILTER (WHERE _action = 'update') AS rows_updated,
       CAST(0 AS BIGINT) AS rows_deleted,
       count(*) FILTER (WHERE _action = 'stale') AS rows_stale,
       count(*) FILTER (WHERE _action = 'keep') AS rows_kept,
       count(*) FILTER (WHERE _action IN ('insert', 'update')) AS rows_affected
FROM ("""
    + MERGE_GUARDED_SQL
    + ") m"
)


@register("merge_metrics", MERGE_METRICS_SQL)
def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-03 / E-04 / J-14: all action counts of one merge in one aggregate."""
    return merge_counts(merge_guarded(spark, sf_dir))
