"""Shape queries: envelopes, JSON paths, drift casts, nested/flat fields,
drifted unions (B-01..B-09, B-16, I-01..I-08, I-13, H-02)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncforge.functions import parse_json, try_bool, try_date, try_double, try_int, try_long, try_timestamp
from syncforge.operators.envelope import column_or_null, nested_or_flat, unwrap, union_drifted
from syncforge.plans.registry import register
from syncforge.plans.tables import table

LINE_FIELDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]


@register(
    "envelope_unwrap",
    f"SELECT {', '.join(LINE_FIELDS)} FROM lineitem",
)
def envelope_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-01: mixed shapes in one scan -- one-record envelopes, flat rows
    (returned lines), and empty / NULL envelopes (one per order) that yield
    no rows. Every lineitem comes out exactly once."""
    li = table(spark, sf_dir, "lineitem").select(*LINE_FIELDS)
    rec = F.struct(*[F.col(c) for c in LINE_FIELDS])
    wrapped = li.filter(F.col("l_returnflag") != "R").select(F.array(rec).alias("results"))
    flat = li.filter(F.col("l_returnflag") == "R")
    elem = wrapped.schema["results"].dataType
    empties = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.array_compact(F.array(F.lit(None).cast(elem.elementType))))
        .otherwise(F.lit(None).cast(elem))
        .alias("results")
    )
    mixed = union_drifted([wrapped, flat, empties])
    return unwrap(mixed, "results").select("rec.*")


_JSON_DOC = (
    "CASE WHEN event_type IN ('click', 'purchase') "
    "THEN '{\"data\":' || props || ',\"event\":\"' || event_type || '\"}' ELSE props END"
)


@register(
    "json_fields",
    f"""
WITH d AS (SELECT event_id, {_JSON_DOC} AS doc, event_type IN ('click', 'purchase') AS nested FROM events)
SELECT event_id,
       COALESCE(json_extract_string(doc, '$.data.k'), json_extract_string(doc, '$.k')) AS k_text,
       TRY_CAST(COALESCE(json_extract_string(doc, '$.data.k'), json_extract_string(doc, '$.k')) AS BIGINT) AS k,
       json_extract_string(doc, '$.event') AS event_name,
       COALESCE(json_extract_string(doc, '$.data.zz'), json_extract_string(doc, '$.zz')) AS missing,
       nested
FROM d""",
)
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-07/B-08: a field read at ``data.k`` with ``k`` as fallback (parsed once)."""
    ev = table(spark, sf_dir, "events")
    nested = F.col("event_type").isin("click", "purchase")
    doc = F.when(
        nested,
        F.concat(F.lit('{"data":'), F.col("props"), F.lit(',"event":"'), F.col("event_type"), F.lit('"}')),
    ).otherwise(F.col("props"))
    # one parse per row into a declared struct; the nested path wins, the
    # flat one is the fallback
    j = parse_json(doc, "data struct<k: string, zz: string>, k string, zz string, event string")
    d = ev.select("event_id", j.alias("j"), nested.alias("nested"))
    k_text = F.coalesce(F.col("j.data.k"), F.col("j.k"))
    return d.select(
        "event_id",
        k_text.alias("k_text"),
        try_long(k_text).alias("k"),
        F.col("j.event").alias("event_name"),
        F.coalesce(F.col("j.data.zz"), F.col("j.zz")).alias("missing"),
        "nested",
    )


@register(
    "drift_cast",
    """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS agent_id,
       CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
            ELSE CAST(o_custkey AS DOUBLE) + 0.25 END AS amount,
       CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE ELSE NULL END AS flag,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS occurred,
       CAST(o_orderdate AS DATE) AS day,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE 2 END AS exponent
FROM orders""",
)
def drift_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-01..I-06: text values that do not parse become NULL instead of failing the job."""
    o = table(spark, sf_dir, "orders")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    id_text = F.when((st == "P") & (pr == "5-LOW"), F.concat(F.lit("x"), F.col("o_orderkey"))).otherwise(
        F.col("o_orderkey").cast("string")
    )
    amount_text = F.when((st == "O") & (pr == "4-NOT SPECIFIED"), F.lit("n/a")).otherwise(
        F.concat(F.col("o_custkey").cast("string"), F.lit(".25"))
    )
    flag_text = F.when(st == "F", F.lit("true")).when(st == "O", F.lit("false")).otherwise(F.lit("two"))
    ts_text = F.when((st == "F") & (pr == "1-URGENT"), F.lit("not-a-time")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    )
    day_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    exp_text = F.when(pr == "3-MEDIUM", F.lit("two")).otherwise(F.lit("2"))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        try_long(id_text).alias("agent_id"),
        try_double(amount_text).alias("amount"),
        try_bool(flag_text).alias("flag"),
        try_timestamp(ts_text).alias("occurred"),
        try_date(day_text).alias("day"),
        try_int(exp_text).alias("exponent"),
    )


_NESTED_SEGMENTS = ("BUILDING", "AUTOMOBILE")


@register(
    "nested_flat_coalesce",
    """
SELECT c_custkey AS id,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN c_name ELSE upper(c_name) END AS name,
       c_nationkey AS nation,
       CAST(NULL AS VARCHAR) AS job_title
FROM customer""",
)
def nested_flat_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-03..B-06: nested ``contact.*`` wins over the flat field; absent columns are NULL."""
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment").isin(*_NESTED_SEGMENTS)
    nested = c.filter(seg).select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("contact"),
        F.upper("c_name").alias("name"),
    )
    flat = c.filter(~seg).select(
        F.col("c_custkey").alias("id"), F.upper("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    df = union_drifted([nested, flat])
    return df.select(
        "id",
        nested_or_flat(df, "contact.name", "name").alias("name"),
        nested_or_flat(df, "contact.nation", "nation").alias("nation"),
        column_or_null(df, "job_title", "string").alias("job_title"),
    )


@register(
    "drift_union",
    """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
       c_mktsegment AS segment, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""",
)
def drift_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H-02: two record layouts unioned by name, missing columns NULL."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        F.lit("customer").alias("kind"),
    )
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
        F.lit("supplier").alias("kind"),
    )
    return union_drifted([c, s])
