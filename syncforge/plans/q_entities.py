"""Entity transforms on records built from the driver tables.

Each query turns driver rows into raw snapshot records of the declared read
schema (drifting text fields, nested and flat layouts, envelopes and
wrapped rows mixed per row) and runs the library's entity transform on
them, so the oracle checks the same code the day flow runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from syncforge import schemas as S
from syncforge.operators.envelope import explode_ids
from syncforge.plans.entities import agent_roles, agents, budgets, cards, groups
from syncforge.plans.registry import register
from syncforge.plans.tables import table

RUN_TS = "2024-06-01 00:00:00"


def record(schema: StructType, values: dict) -> Column:
    """Struct of ``schema``'s shape; absent fields are NULL."""
    fields = []
    for f in schema.fields:
        v = values.get(f.name)
        if isinstance(f.dataType, StructType) and isinstance(v, dict):
            v = record(f.dataType, v)
        fields.append((v if v is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return F.struct(*fields)


def raw_rows(read_schema: StructType, rec: Column, wrapped: Column, wrapper: str | None = None, wrapper_rows: Column | None = None):
    """Raw rows of ``read_schema``: an envelope where ``wrapped``, the wrapper
    struct where ``wrapper_rows``, flat fields otherwise."""
    cols = []
    record_type = read_schema["results"].dataType.elementType
    flat = ~wrapped if wrapper_rows is None else ~wrapped & ~wrapper_rows
    for f in read_schema.fields:
        if f.name == "results":
            c = F.when(wrapped, F.array(rec)).otherwise(F.lit(None).cast(ArrayType(record_type)))
        elif wrapper is not None and f.name == wrapper:
            c = F.when(wrapper_rows, rec).otherwise(F.lit(None).cast(record_type))
        else:
            c = F.when(flat, rec.getField(f.name)).otherwise(F.lit(None).cast(f.dataType))
        cols.append(c.alias(f.name))
    return cols


# ---------------------------------------------------------------------------
# agents: customers as agent details, recent buyers as the active list
# ---------------------------------------------------------------------------
def agents_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    bad_id = (seg == "MACHINERY") & (F.col("c_acctbal") < 0)
    email = F.when(F.col("c_nationkey") == 7, F.lit(None)).otherwise(
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.org"))
    )
    flat = seg == "AUTOMOBILE"
    contact = F.when(~flat, record(S.CONTACT, {"email": email, "name": F.col("c_name"), "job_title": seg}))
    rec = record(
        S.AGENT_DETAIL_RECORD,
        {
            "id": F.when(bad_id, F.concat(F.lit("x"), F.col("c_custkey"))).otherwise(F.col("c_custkey").cast("string")),
            "contact": contact,
            "email": F.when(flat, email),
            "name": F.when(flat, F.col("c_name")),
            "job_title": F.when(flat, seg),
            "available": F.when(F.col("c_acctbal") > 0, F.lit("true")).otherwise(F.lit("false")),
            "updated_at": F.lit("2024-05-01T00:00:00"),
        },
    )
    details = c.select(rec.alias("r")).select("r.*")
    active = (
        table(spark, sf_dir, "orders")
        .filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
        .select(F.col("o_custkey").cast("string").alias("id"))
    )
    return details, active


@register(
    "agents_sync",
    """
SELECT c_custkey AS agent_id,
       'user' || c_custkey || '@example.org' AS email,
       c_name AS name,
       c_mktsegment AS job_title,
       c_acctbal > 0 AS available,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
            THEN 'active' ELSE 'inactive' END AS status
FROM customer
WHERE NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 0) AND c_nationkey <> 7""",
)
def agents_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-01 / B-05 / B-06 / D-01 through the agents transform: nested contact
    for most rows, flat fields for AUTOMOBILE, text ids and booleans."""
    details, active = agents_input(spark, sf_dir)
    valid, _ = agents.transform(details, active, "sf", F.lit(RUN_TS).cast("timestamp"))
    return valid.select("agent_id", "email", "name", "job_title", "available", "status")


# ---------------------------------------------------------------------------
# cards: parts as card records in one-record envelopes
# ---------------------------------------------------------------------------
def cards_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    rec = record(
        S.CARD_RECORD,
        {
            "id": F.concat(F.lit("c"), F.col("p_partkey").cast("string")),
            "status": F.when(F.col("p_size") < 5, F.lit(None)).otherwise(F.lit("active")),
            "type": F.lit("virtual"),
            "shareBudgetFunds": F.when(F.col("p_size") > 25, F.lit("true")).otherwise(F.lit("false")),
            "recurring": F.lit("true"),
            "currentPeriod": {
                "limit": (F.col("p_retailprice") - F.lit(950.0)).cast("string"),
                "spent": F.col("p_size").cast("string"),
            },
            "createdTime": F.lit("2024-01-01T00:00:00"),
        },
    )
    raw = p.select(*raw_rows(S.envelope(S.CARD_RECORD), rec, F.col("p_type") != "PROMO"))
    return raw


@register(
    "cards_sync",
    """
SELECT 'c' || p_partkey AS card_id,
       p_retailprice - 950.0 AS current_limit,
       CAST(p_size AS DOUBLE) AS current_spent,
       p_size > 25 AS share_budget_funds,
       TRUE AS recurring,
       TIMESTAMP '2024-01-01 00:00:00' AS created_time,
       'sf' AS last_synced_day
FROM part
WHERE p_size >= 5 AND p_retailprice - 950.0 >= 0""",
)
def cards_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-04 / B-01 / B-10 / F-02 through the cards transform."""
    raw = cards_input(spark, sf_dir)
    valid, _ = cards.transform(raw, "sf", F.lit(RUN_TS).cast("timestamp"))
    return valid.select(
        "card_id", F.col("current_limit").cast("double"), F.col("current_spent").cast("double"), "share_budget_funds", "recurring", "created_time",
        "last_synced_day",
    )


# ---------------------------------------------------------------------------
# budgets: suppliers as budgets, envelope / wrapped / flat rows mixed
# ---------------------------------------------------------------------------
def budgets_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    rec = record(
        S.BUDGET_RECORD,
        {
            "id": F.concat(F.lit("b"), F.col("s_suppkey").cast("string")),
            "name": F.col("s_name"),
            "retired": F.lit("false"),
            "startDate": F.lit("2024-05-15"),
            "currentPeriod": {
                "limit": F.when(F.col("s_nationkey") == 3, F.lit(None)).otherwise(F.col("s_acctbal").cast("string")),
            },
        },
    )
    nk = F.col("s_nationkey")
    raw = s.select(
        *raw_rows(S.wrapped(S.BUDGET_RECORD, "budget"), rec, nk >= 15, wrapper="budget", wrapper_rows=(nk < 15) & (nk >= 5))
    )
    return raw


@register(
    "budgets_sync",
    """
SELECT 'b' || s_suppkey AS budget_id, s_name AS name, s_acctbal AS limit_amount,
       DATE '2024-05-15' AS start_date, FALSE AS retired, 'sf' AS sync_day
FROM supplier WHERE s_nationkey <> 3""",
)
def budgets_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-03 / B-01 / B-02 through the budgets transform (negative limits pass)."""
    raw = budgets_input(spark, sf_dir)
    valid, _ = budgets.transform(raw, "sf", F.lit(RUN_TS).cast("timestamp"))
    return valid.select("budget_id", "name", F.col("limit_amount").cast("double"), "start_date", "retired", "sync_day")


# ---------------------------------------------------------------------------
# agent_roles: customers' role lists (JSON text) against nations as roles
# ---------------------------------------------------------------------------
def agent_roles_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer")
    seg, nk = F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    role_ids = (
        F.when(seg == "BUILDING", F.concat(F.lit("["), nk, F.lit(","), (F.col("c_nationkey") + 1000).cast("string"), F.lit("]")))
        .when(seg == "AUTOMOBILE", F.concat(F.lit("["), nk, F.lit("]")))
        .when(seg == "MACHINERY", F.concat(nk, F.lit(",1")))
        .when(seg == "HOUSEHOLD", F.lit("[]"))
    )
    details = c.select(record(S.AGENT_DETAIL_RECORD, {"id": F.col("c_custkey").cast("string"), "role_ids": role_ids}).alias("r")).select("r.*")
    roles = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("role_id"))
    return details, roles


@register(
    "agent_roles_sync",
    """
SELECT c_custkey AS agent_id, CAST(c_nationkey AS BIGINT) AS role_id
FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')""",
)
def agent_roles_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-16 / D-04 through the agent_roles transform: a list with an unknown
    role, a value that is not a list, an empty list and a NULL list."""
    details, roles = agent_roles_input(spark, sf_dir)
    pairs, _, _ = agent_roles.transform(details, roles, "sf", F.lit(RUN_TS).cast("timestamp"))
    return pairs


# ---------------------------------------------------------------------------
# groups: parts as groups with member lists, suppliers as the agents
# ---------------------------------------------------------------------------
def groups_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "part")
    ty, size = F.col("p_type"), F.col("p_size").cast("string")
    agent_ids = (
        F.when(ty == "STANDARD", F.concat(size, F.lit(",2")))
        .when(ty == "LARGE", F.lit("[]"))
        .when(ty != "PROMO", F.concat(F.lit("["), size, F.lit(","), (F.col("p_size") + 100000).cast("string"), F.lit("]")))
    )
    raw = p.select(
        record(
            S.GROUP_RECORD,
            {
                "id": F.col("p_partkey").cast("string"),
                "name": F.col("p_name"),
                "parent_group_id": F.expr("p_partkey div 3").cast("string"),
                "agent_ids": agent_ids,
            },
        ).alias("r")
    ).select("r.*")
    agents_df = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("agent_id"))
    return raw, agents_df


@register(
    "groups_sync",
    """
SELECT p_partkey AS group_id, CAST(p_size AS BIGINT) AS agent_id
FROM part
WHERE p_type NOT IN ('PROMO', 'LARGE', 'STANDARD') AND p_size IN (SELECT s_suppkey FROM supplier)""",
)
def groups_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-17 / D-02 / D-03 through the groups transform: known and unknown
    members, a list that is not a list, empty and NULL lists."""
    raw, agents_df = groups_input(spark, sf_dir)
    _, members, _, _ = groups.transform(raw, agents_df, "sf", F.lit(RUN_TS).cast("timestamp"))
    return members


@register(
    "group_members_outer",
    """
SELECT p_partkey AS group_id, unnest(CASE WHEN p_type IN ('PROMO', 'LARGE', 'STANDARD') THEN [NULL]
         ELSE [CAST(p_size AS BIGINT), CAST(p_size + 100000 AS BIGINT)] END) AS agent_id
FROM part""",
)
def group_members_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-17: a group without members (NULL, empty or unreadable list) keeps one row, with a NULL member."""
    raw, _ = groups_input(spark, sf_dir)
    rows = raw.select(F.col("id").cast("bigint").alias("group_id"), "agent_ids")
    return explode_ids(rows, ["group_id"], "agent_ids", "agent_id", outer=True)
