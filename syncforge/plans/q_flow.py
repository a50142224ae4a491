"""The day flow under the oracle: two days of snapshots through ``backfill`` (M-01..M-03, K-02, K-03).

Each query writes two days of JSON-lines exports, made from whole driver
tables, below the shared checkpoint folder, runs the flow's steps that its
table needs, and returns that table at full width. Day 2 drops some records,
adds some, sends some older and changes the rest. What the SQL repeats is the
outcome by the rules of the merges, from the same driver tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from syncforge import schemas as S
from syncforge.plans import q_entities as Q
from syncforge.plans.entities import transactions as txn
from syncforge.plans.flow import METRICS, backfill, key_index, read_core, split_clashes
from syncforge.plans.q_validate import NATION_CURRENCY, NO_API_RATE, _sql_list, orders_as_transactions, orders_fx_rates
from syncforge.plans.registry import register
from syncforge.plans.tables import table
from syncforge.session import checkpoint_dir, materialize
from syncforge.sinks.tables import TableStore

DAYS = ("2024-05-01", "2024-05-02")
RUN_TS = {d: f"{d} 23:00:00" for d in DAYS}  # in the session's zone
T1, T2 = (f"TIMESTAMP '{d} 23:00:00'" for d in DAYS)


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _on(day: int, first, second):
    return first if day == 1 else second


def _lit(day: int, first: str, second: str) -> Column:
    return F.lit(_on(day, first, second))


# ---------------------------------------------------------------------------
# the exports of a day
# ---------------------------------------------------------------------------
def agent_details(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Customers as agent details: flat contact fields for AUTOMOBILE, bad ids, missing emails."""
    c = table(spark, sf_dir, "customer").where(_on(day, "c_custkey % 5 <> 4", "c_custkey % 7 <> 6"))
    seg, nk, key = F.col("c_mktsegment"), _text("c_nationkey"), _text("c_custkey")
    bad_id = (seg == "MACHINERY") & (F.col("c_acctbal") < 0)
    title = seg if day == 1 else F.concat(seg, F.lit(" 2"))
    contact = {
        "email": F.when(F.col("c_nationkey") != 7, F.concat(F.lit("user"), key, F.lit("@example.org"))),
        "name": F.col("c_name"),
        "job_title": title,
        "language": F.concat(F.lit("l"), nk),
        "mobile": F.concat(F.lit("+1"), key),
        "phone": F.concat(F.lit("+2"), key),
        "time_zone": F.lit("UTC"),
        "last_login_at": _lit(day, "2024-04-30T08:00:00", "2024-05-01T08:00:00"),
    }
    flat = seg == "AUTOMOBILE"
    lists = {
        1: F.when(seg == "BUILDING", F.concat(F.lit("["), nk, F.lit(","), _text(F.col("c_nationkey") + 1000), F.lit("]")))
        .when(seg.isin("AUTOMOBILE", "FURNITURE"), F.concat(F.lit("["), nk, F.lit("]")))
        .when(seg == "MACHINERY", F.concat(nk, F.lit(",1")))
        .when(seg == "HOUSEHOLD", F.lit("[]")),
        2: F.when(seg == "BUILDING", F.concat(F.lit("["), nk, F.lit("]")))
        .when(seg == "AUTOMOBILE", F.concat(F.lit("["), _text((F.col("c_nationkey") + 1) % 25), F.lit("]")))
        .when(seg == "FURNITURE", F.concat(nk, F.lit(",1")))
        .otherwise(F.concat(F.lit("["), nk, F.lit("]"))),
    }
    up = F.col("c_acctbal") > 0 if day == 1 else F.col("c_acctbal") <= 0
    rec = {
        "id": F.when(bad_id, F.concat(F.lit("x"), key)).otherwise(key),
        "contact": F.when(~flat, Q.record(S.CONTACT, contact)),
        **{k: F.when(flat, v) for k, v in contact.items()},
        "available": F.when(up, F.lit("true")).otherwise(F.lit("false")),
        "available_since": _lit(day, "2024-04-01T00:00:00", "2024-04-02T00:00:00"),
        "deactivated": F.lit("false"),
        "focus_mode": F.lit("on"),
        "agent_operational_status": _lit(day, "idle", "busy"),
        "last_active_at": F.lit("not a time"),
        "created_at": _lit(day, "2024-01-01T00:00:00", "2024-02-01T00:00:00"),
        "updated_at": F.lit("2024-05-01T00:00:00") if day == 1 else F.when(F.col("c_custkey") % 3 == 0, F.lit("2024-04-30T00:00:00")).otherwise(F.lit("2024-05-02T00:00:00")),
        "ticket_scope": F.lit("all"),
        "org_agent_id": F.concat(F.lit("o"), key),
        "signature": F.lit(None),
        "freshchat_agent": F.lit("false"),
        "role_ids": lists[day],
    }
    return c.select(Q.record(S.AGENT_DETAIL_RECORD, rec).alias("r")).select("r.*")


#: What makes a customer active on a day, read over all orders.
ACTIVE = {1: ("F", "1-URGENT"), 2: ("O", "5-LOW")}


def active_agents(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    status, priority = ACTIVE[day]
    o = table(spark, sf_dir, "orders").where((F.col("o_orderstatus") == status) & (F.col("o_orderpriority") == priority))
    return o.select(_text("o_custkey").alias("id")).distinct()


def roles_export(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    n = table(spark, sf_dir, "nation").where(_on(day, "n_nationkey <> 24", "n_regionkey < 3"))
    nested = F.col("n_nationkey") % 2 == 1
    fields = {
        "name": F.when(F.col("n_nationkey") != 5, F.col("n_name") if day == 1 else F.concat("n_name", F.lit(" 2"))),
        "description": F.concat(F.lit("region "), _text("n_regionkey")),
        "default": F.when(F.col("n_nationkey") < 10, F.lit("true")).otherwise(F.lit("maybe")),
        "agent_type": _text("n_regionkey"),
        "created_at": _lit(day, "2024-01-01T00:00:00", "2024-02-01T00:00:00"),
        "updated_at": _lit(day, "2024-05-01T00:00:00", "2024-05-02T00:00:00"),
    }
    shape = S.ROLE_RECORD["role"].dataType
    rec = {"id": _text("n_nationkey"), "role": F.when(nested, Q.record(shape, fields)), **{k: F.when(~nested, v) for k, v in fields.items()}}
    return n.select(Q.record(S.ROLE_RECORD, rec).alias("r")).select("r.*")


def groups_export(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    p = table(spark, sf_dir, "part").where(_on(day, "true", "p_partkey % 11 <> 10"))
    first = F.concat(F.lit("["), _text("p_size"), F.lit(","), _text(F.col("p_size") + 1), F.lit("]"))
    second = F.when(F.col("p_partkey") % 2 == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), _text(F.col("p_size") + 2), F.lit("]")))
    rec = {
        "id": _text("p_partkey"),
        "name": F.col("p_name") if day == 1 else F.concat("p_name", F.lit(" 2")),
        "parent_group_id": _text(F.expr("p_partkey div 3")),
        "created_at": _lit(day, "2024-01-01T00:00:00", "2024-02-01T00:00:00"),
        "updated_at": _lit(day, "2024-05-01T00:00:00", "2024-05-02T00:00:00"),
        "agent_ids": _on(day, first, second),
    }
    return p.select(Q.record(S.GROUP_RECORD, rec).alias("r")).select("r.*")


def budgets_export(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Suppliers as budgets, in all three shapes; on day 2 each record is sent twice."""
    s = table(spark, sf_dir, "supplier").where(_on(day, "s_suppkey % 5 <> 4", "s_nationkey >= 10"))
    nk = F.col("s_nationkey")
    amount = _text(F.col("s_acctbal").cast("decimal(38,2)"))
    rec = Q.record(
        S.BUDGET_RECORD,
        {
            "id": F.concat(F.lit("b"), _text("s_suppkey")),
            "uuid": F.concat(F.lit("u-"), _text("s_suppkey")),
            "name": F.col("s_name"),
            "description": _lit(day, "first", "second"),
            "retired": F.when(nk % 2 == 0, F.lit("true")).otherwise(F.lit("false")),
            "startDate": F.lit("2024-05-15"),
            "recurringInterval": F.lit("monthly"),
            "timezone": F.lit("UTC"),
            "currentPeriod": {
                "limit": F.when(nk != 3, amount if day == 1 else F.lit("7.25")),
                "overspendBuffer": F.lit("0.5"),
                "assigned": amount,
                "spent": {"cleared": F.lit("1.1"), "pending": F.lit("n/a"), "total": F.lit("2.2")},
            },
        },
    )
    rows = s if day == 1 else s.unionByName(s)
    return rows.select(*Q.raw_rows(S.wrapped(S.BUDGET_RECORD, "budget"), rec, nk >= 15, wrapper="budget", wrapper_rows=(nk < 15) & (nk >= 5)))


def cards_export(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    p = table(spark, sf_dir, "part").where(_on(day, "p_partkey % 9 <> 8", "p_partkey % 2 = 0"))
    key = _text("p_partkey")
    rec = Q.record(
        S.CARD_RECORD,
        {
            "id": F.concat(F.lit("c"), key),
            "uuid": F.concat(F.lit("u-"), key),
            "name": F.col("p_name"),
            "userId": _text("p_size"),
            "userUuid": F.lit(None),
            "budgetId": F.concat(F.lit("b"), _text("p_size")),
            "budgetUuid": F.lit("-"),
            "lastFour": F.lpad(key, 4, "0"),
            "validThru": F.lit("12/29"),
            "status": F.when(F.col("p_size") >= 5, _lit(day, "active", "frozen")),
            "type": F.lit("virtual"),
            "shareBudgetFunds": F.when(F.col("p_size") > 25, F.lit("true")).otherwise(F.lit("false")),
            "recurring": F.lit("true"),
            "recurringLimit": F.lit("10"),
            "currentPeriod": {"limit": _text(F.col("p_retailprice").cast("decimal(38,2)")), "spent": _lit(day, "1.25", "3.5")},
            "createdTime": F.lit("2024-01-01T00:00:00"),
            "updatedTime": _lit(day, "2024-05-01T10:00:00", "2024-05-02T10:00:00"),
        },
    )
    return p.select(*Q.raw_rows(S.envelope(S.CARD_RECORD), rec, F.col("p_type") != "PROMO"))


def transactions_export(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Orders as transactions; day 2 sends open orders again: some later, some older, all with another merchant."""
    rows = orders_as_transactions(spark, sf_dir)
    if day == 1:
        return rows
    again = rows.where("results IS NULL AND (originalCurrencyAmount IS NOT NULL OR currencyData.exchangeRate IS NOT NULL)")
    later = F.when(F.pmod(F.col("id").try_cast("bigint"), F.lit(2)) == 0, F.lit("2030-01-02T00:00:00")).otherwise(F.lit("1980-01-01T00:00:00"))
    return again.withColumns({"merchantName": F.lit("merchant 2"), "updatedTime": later})


EXPORTS = {
    "agent_details": agent_details, "agents": active_agents, "admin_groups": groups_export, "roles": roles_export,
    "budgets": budgets_export, "cards": cards_export, "transactions": transactions_export,
}
NEEDS = {
    "agents": ("agent_details", "agents"), "groups": ("admin_groups",), "roles": ("roles",), "agent_roles": ("agent_details",),
    "budgets": ("budgets",), "cards": ("cards",), "transactions": ("transactions",),
}


def two_days(spark: SparkSession, sf_dir: str, steps: Sequence[str]) -> TableStore:
    """Both days through the flow's ``steps``; the tables stay below the checkpoint folder."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/flow-{uuid.uuid4().hex}"
    for day, label in enumerate(DAYS, 1):
        for folder in sorted({f for s in steps for f in NEEDS[s]}):
            EXPORTS[folder](spark, sf_dir, day).write.json(f"{root}/export/sync-{label}/{folder}")
    fx = orders_fx_rates(spark, sf_dir) if "transactions" in steps else None
    store = TableStore(spark, f"{root}/tables", buckets=16)
    backfill(spark, f"{root}/export", DAYS, store, run_ts=RUN_TS.__getitem__, fx_rates=fx, multiline=False, only=steps)
    return store


def _money(df: DataFrame) -> DataFrame:
    """Money as doubles, for the comparison."""
    return df.select(*[F.col(c).cast("double") if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


# ---------------------------------------------------------------------------
# the tables after both days
# ---------------------------------------------------------------------------
def _active_sql(day: int) -> str:
    status, priority = ACTIVE[day]
    return f"c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = '{status}' AND o_orderpriority = '{priority}')"


_AGENTS_SQL = f"""
c AS (SELECT * FROM customer WHERE NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 0) AND c_nationkey <> 7),
a AS (
  SELECT *, c_custkey % 5 <> 4 AS in1, c_custkey % 7 <> 6 AS in2,
         CASE WHEN c_custkey % 7 <> 6 AND (c_custkey % 5 = 4 OR c_custkey % 3 <> 0) THEN 2 ELSE 1 END AS of_day
  FROM c WHERE c_custkey % 5 <> 4 OR c_custkey % 7 <> 6),
agents AS (
  SELECT c_custkey AS agent_id, 'user' || c_custkey || '@example.org' AS email, c_name AS name,
         c_mktsegment || CASE WHEN of_day = 2 THEN ' 2' ELSE '' END AS job_title, 'l' || c_nationkey AS language,
         '+1' || c_custkey AS mobile, '+2' || c_custkey AS phone, 'UTC' AS time_zone,
         CASE WHEN of_day = 1 THEN c_acctbal > 0 ELSE c_acctbal <= 0 END AS available,
         CASE WHEN of_day = 1 THEN TIMESTAMP '2024-04-01' ELSE TIMESTAMP '2024-04-02' END AS available_since,
         FALSE AS deactivated,
         CASE WHEN of_day = 1 THEN CASE WHEN {_active_sql(1)} THEN 'active' ELSE 'inactive' END
              ELSE CASE WHEN {_active_sql(2)} THEN 'active' ELSE 'inactive' END END AS status,
         'on' AS focus_mode, CASE WHEN of_day = 1 THEN 'idle' ELSE 'busy' END AS agent_operational_status,
         CAST(NULL AS TIMESTAMP) AS last_active_at,
         CASE WHEN of_day = 1 THEN TIMESTAMP '2024-04-30 08:00:00' ELSE TIMESTAMP '2024-05-01 08:00:00' END AS last_login_at,
         'o' || c_custkey AS org_agent_id, 'all' AS ticket_scope, CAST(NULL AS VARCHAR) AS signature, 'false' AS freshchat_agent,
         CASE WHEN in1 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END AS created_at,
         CASE WHEN of_day = 1 THEN TIMESTAMP '2024-05-01' WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2024-04-30'
              ELSE TIMESTAMP '2024-05-02' END AS updated_at, in1
  FROM a)"""


@register("flow_two_days_agents", f"WITH {_AGENTS_SQL} SELECT * EXCLUDE (in1) FROM agents")
def flow_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-01, J-02: guarded by ``updated_at``; older records and absent agents keep what is stored."""
    return read_core(two_days(spark, sf_dir, ["agents"]), "agents", S.AGENTS_DDL)


_ROLES_SQL = """
SELECT CAST(n_nationkey AS BIGINT) AS role_id, n_name || CASE WHEN n_regionkey < 3 THEN ' 2' ELSE '' END AS name,
       'region ' || n_regionkey AS description, CASE WHEN n_nationkey < 10 THEN TRUE END AS is_default,
       CAST(n_regionkey AS VARCHAR) AS agent_type,
       CASE WHEN n_nationkey <> 24 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END AS created_at,
       CASE WHEN n_regionkey < 3 THEN TIMESTAMP '2024-05-02' ELSE TIMESTAMP '2024-05-01' END AS updated_at
FROM nation WHERE n_nationkey <> 5 AND (n_nationkey <> 24 OR n_regionkey < 3)"""


@register("flow_two_days_roles", _ROLES_SQL)
def flow_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-04: unguarded, ``created_at`` kept; flat and nested records."""
    return read_core(two_days(spark, sf_dir, ["roles"]), "roles", S.ROLES_DDL)


_PAIRS_SQL = f"""
WITH {_AGENTS_SQL},
r1 AS (SELECT n_nationkey AS role_id FROM nation WHERE n_nationkey NOT IN (5, 24)),
r2 AS (SELECT role_id FROM ({_ROLES_SQL})),
p1 AS (
  SELECT c_custkey AS agent_id, CAST(c_nationkey AS BIGINT) AS role_id FROM a
  WHERE in1 AND c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'FURNITURE') AND c_nationkey IN (SELECT role_id FROM r1)),
p2 AS (
  SELECT * FROM (
    SELECT c_custkey AS agent_id, CAST(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS BIGINT) AS role_id
    FROM a WHERE in2 AND c_mktsegment <> 'FURNITURE')
  WHERE role_id IN (SELECT role_id FROM r2)),
unread AS (SELECT c_custkey AS agent_id FROM a WHERE in2 AND c_mktsegment = 'FURNITURE'),
both_days AS (
  SELECT agent_id, role_id, p1.agent_id IS NOT NULL AS one, p2.agent_id IS NOT NULL AS two
  FROM p1 FULL OUTER JOIN p2 USING (agent_id, role_id)),
m AS (SELECT *, NOT two AND agent_id NOT IN (SELECT agent_id FROM unread) AS gone FROM both_days)"""


@register(
    "flow_two_days_agent_roles",
    _PAIRS_SQL
    + f"""
SELECT agent_id, role_id, CASE WHEN gone THEN 'removed' ELSE 'assigned' END AS status,
       CASE WHEN one THEN {T1} ELSE {T2} END AS assigned_at, CASE WHEN gone THEN {T2} END AS removed_at,
       CASE WHEN two OR gone THEN {T2} ELSE {T1} END AS updated_at
FROM m""",
)
def flow_agent_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-05, J-06: pairs of unread lists stay, others that are missing are removed softly."""
    return read_core(two_days(spark, sf_dir, ["agents", "roles", "agent_roles"]), "agent_role_mapping", S.AGENT_ROLE_MAPPING_DDL)


@register(
    "flow_two_days_groups",
    f"""
WITH RECURSIVE {_AGENTS_SQL},
lists AS (
  SELECT p_partkey AS g, unnest([p_size, p_size + 1]) AS agent_id, 1 AS d FROM part WHERE p_partkey % 11 = 10
  UNION ALL SELECT p_partkey, p_size + 2, 2 FROM part WHERE p_partkey % 11 <> 10 AND p_partkey % 2 = 1),
live AS (
  SELECT DISTINCT g FROM lists JOIN agents USING (agent_id) WHERE status = 'active' AND (d = 2 OR in1)),
up(g) AS (
  SELECT g FROM live
  UNION SELECT up.g // 3 FROM up)
SELECT p_partkey AS group_id, p_name || CASE WHEN p_partkey % 11 <> 10 THEN ' 2' ELSE '' END AS name,
       p_partkey // 3 AS parent_group_id, TIMESTAMP '2024-01-01' AS created_at,
       CASE WHEN p_partkey % 11 <> 10 THEN TIMESTAMP '2024-05-02' ELSE TIMESTAMP '2024-05-01' END AS updated_at,
       p_partkey NOT IN (SELECT g FROM up) AS inactive
FROM part""",
)
def flow_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-04, J-08, J-09: members of sent groups are replaced, flags follow the members and agents of day 2."""
    return read_core(two_days(spark, sf_dir, ["agents", "groups"]), "groups", S.GROUPS_DDL)


@register(
    "flow_two_days_budgets",
    f"""
SELECT 'b' || s_suppkey AS budget_id, 'u-' || s_suppkey AS budget_uuid, s_name AS name,
       CASE WHEN s_nationkey >= 10 THEN 'second' ELSE 'first' END AS description, s_nationkey % 2 = 0 AS retired,
       DATE '2024-05-15' AS start_date, 'monthly' AS recurring_interval, 'UTC' AS timezone,
       CASE WHEN s_nationkey >= 10 THEN 7.25::DOUBLE ELSE s_acctbal END AS limit_amount, 0.5::DOUBLE AS overspend_buffer,
       s_acctbal AS assigned_amount, 1.1::DOUBLE AS spent_cleared, CAST(NULL AS DOUBLE) AS spent_pending, 2.2::DOUBLE AS spent_total,
       CASE WHEN s_nationkey >= 10 THEN '{DAYS[1]}' ELSE '{DAYS[0]}' END AS sync_day,
       CASE WHEN s_suppkey % 5 <> 4 THEN {T1} ELSE {T2} END AS created_at,
       CASE WHEN s_nationkey >= 10 THEN {T2} ELSE {T1} END AS updated_at, 'api' AS source
FROM supplier WHERE s_nationkey >= 10 OR (s_suppkey % 5 <> 4 AND s_nationkey <> 3)""",
)
def flow_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-10, F-04: repeated records count once, ``created_at`` is kept, the day comes from the file."""
    return _money(read_core(two_days(spark, sf_dir, ["budgets"]), "budgets"))


@register(
    "flow_two_days_cards",
    f"""
SELECT 'c' || p_partkey AS card_id, 'u-' || p_partkey AS card_uuid, p_name AS name, CAST(p_size AS VARCHAR) AS user_id,
       CAST(NULL AS VARCHAR) AS user_uuid, 'b' || p_size AS budget_id, '-' AS budget_uuid,
       CASE WHEN p_partkey < 10000 THEN lpad(CAST(p_partkey AS VARCHAR), 4, '0') ELSE substr(CAST(p_partkey AS VARCHAR), 1, 4) END AS last_four,
       '12/29' AS valid_thru, CASE WHEN p_partkey % 2 = 0 THEN 'frozen' ELSE 'active' END AS status, 'virtual' AS type,
       p_size > 25 AS share_budget_funds, TRUE AS recurring, 10::DOUBLE AS recurring_limit, p_retailprice AS current_limit,
       CASE WHEN p_partkey % 2 = 0 THEN 3.5::DOUBLE ELSE 1.25::DOUBLE END AS current_spent, TIMESTAMP '2024-01-01' AS created_time,
       CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2024-05-02 10:00:00' ELSE TIMESTAMP '2024-05-01 10:00:00' END AS updated_time,
       CASE WHEN p_partkey % 2 = 0 THEN '{DAYS[1]}' ELSE '{DAYS[0]}' END AS last_synced_day, 'api' AS source,
       CASE WHEN p_partkey % 2 = 0 THEN {T2} ELSE {T1} END AS ingested_at
FROM part WHERE p_size >= 5 AND (p_partkey % 9 <> 8 OR p_partkey % 2 = 0)""",
)
def flow_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-11: a day overwrites the cards it sends and leaves the others."""
    return _money(read_core(two_days(spark, sf_dir, ["cards"]), "cards"))


_TRANSACTIONS_SQL = f"""
WITH x AS (
  SELECT o.*, c_name, n_name, n_nationkey, {_sql_list(NATION_CURRENCY)}[n_nationkey + 1] AS cur
  FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey),
y AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CASE WHEN cur = 'USD' THEN 1.0::DOUBLE
              WHEN cur <> '{NO_API_RATE}' THEN 1.0::DOUBLE / ((n_nationkey + 1) / 4.0::DOUBLE) END AS api,
         CASE WHEN o_orderstatus = 'O' THEN 0.5::DOUBLE END AS paid,
         o_orderstatus = 'O' AND o_orderkey % 2 = 0 AS again
  FROM x WHERE cur IS NOT NULL AND cur <> 'XYZ' AND o_orderstatus <> 'P'
    AND NOT (o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F')
  UNION ALL
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT), CASE WHEN cur = 'USD' THEN 1.0::DOUBLE
              WHEN cur <> '{NO_API_RATE}' THEN 1.0::DOUBLE / ((n_nationkey + 1) / 4.0::DOUBLE) END, NULL, FALSE
  FROM x WHERE cur IS NOT NULL AND cur <> 'XYZ' AND o_orderstatus = 'P'
    AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')),
z AS (
  SELECT *, cents / 100.0::DOUBLE AS amount, coalesce(api, paid) AS rate,
         CAST(cents // 100 AS VARCHAR) || CASE WHEN cents % 100 = 0 THEN '' WHEN cents % 10 = 0 THEN '.' || (cents % 100) // 10
              ELSE '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS amount_text
  FROM y WHERE cents <> 0 AND coalesce(api, paid) IS NOT NULL)"""


@register(
    "flow_two_days_transactions",
    _TRANSACTIONS_SQL
    + f"""
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, 't-' || o_orderkey AS transaction_uuid, o_orderdate AS occurred_time,
       CASE WHEN again THEN TIMESTAMP '2030-01-02' ELSE o_orderdate + INTERVAL 1 DAY END AS updated_time,
       CAST(o_custkey AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS user_uuid, c_name AS user_name,
       CASE WHEN again THEN 'merchant 2' ELSE n_name END AS merchant_name, lower(n_name) AS raw_merchant_name,
       CAST(NULL AS VARCHAR) AS card_id, CAST(NULL AS VARCHAR) AS card_uuid, CAST(NULL AS VARCHAR) AS budget_id, CAST(NULL AS VARCHAR) AS budget_uuid,
       amount AS original_amount, cur AS original_currency, amount * rate AS amount_usd, rate AS exchange_rate,
       CASE WHEN api IS NOT NULL THEN 'API' ELSE 'PAYLOAD' END AS fx_source,
       sha256(concat_ws('||', o_orderkey, 't-' || o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), amount_text, cur)) AS idempotency_key,
       CASE WHEN again THEN {T2} ELSE {T1} END AS ingested_at, CAST(o_orderkey AS VARCHAR) AS raw_id
FROM z""",
)
def flow_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-12, J-15, D-06, B-15: later records of day 2 win, older ones are stale; the key of exact money."""
    rows = read_core(two_days(spark, sf_dir, ["transactions"]), "transactions")
    return _money(rows.withColumn("raw_id", F.get_json_object("raw_payload", "$.id")).drop("raw_payload"))


@register(
    "flow_metrics",
    _PAIRS_SQL
    + f""",
r AS (
  SELECT 1 AS d, count(*) FILTER (WHERE n_nationkey NOT IN (5, 24)) AS i, 0 AS u, 0 AS del, 0 AS k FROM nation
  UNION ALL
  SELECT 2, count(*) FILTER (WHERE n_regionkey < 3 AND n_nationkey = 24), count(*) FILTER (WHERE n_regionkey < 3 AND n_nationkey NOT IN (5, 24)), 0,
         count(*) FILTER (WHERE n_regionkey >= 3 AND n_nationkey NOT IN (5, 24)) FROM nation),
g AS (
  SELECT 1 AS d, count(*) FILTER (WHERE in1) AS i, 0 AS u, 0 AS s, 0 AS k FROM a
  UNION ALL
  SELECT 2, count(*) FILTER (WHERE NOT in1), count(*) FILTER (WHERE in1 AND of_day = 2), count(*) FILTER (WHERE in1 AND in2 AND of_day = 1),
         count(*) FILTER (WHERE in1 AND NOT in2) FROM a),
ar AS (
  SELECT 1 AS d, count(*) FILTER (WHERE one) AS i, 0 AS u, 0 AS del, 0 AS k FROM m
  UNION ALL
  SELECT 2, count(*) FILTER (WHERE NOT one), count(*) FILTER (WHERE one AND two), count(*) FILTER (WHERE gone), count(*) FILTER (WHERE one AND NOT two AND NOT gone) FROM m),
t AS (
  SELECT 'agents' AS pipeline_name, d, i, u, 0 AS del, s, k FROM g
  UNION ALL SELECT 'roles', d, i, u, del, 0, k FROM r
  UNION ALL SELECT 'agent_roles', d, i, u, del, 0, k FROM ar)
SELECT pipeline_name, CASE WHEN d = 1 THEN '{DAYS[0]}' ELSE '{DAYS[1]}' END AS day, CAST(i AS BIGINT) AS rows_inserted, CAST(u AS BIGINT) AS rows_updated,
       CAST(del AS BIGINT) AS rows_deleted, CAST(s AS BIGINT) AS rows_stale, CAST(k AS BIGINT) AS rows_kept, CAST(0 AS BIGINT) AS rows_reassigned,
       CAST(i + u + del AS BIGINT) AS rows_affected, 'success' AS status, TRUE AS duration_ok
FROM t""",
)
def flow_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-14, E-06, I-17: counts that rode on the writes; the duration lies between nothing and a day."""
    store = two_days(spark, sf_dir, ["agents", "roles", "agent_roles"])
    m = store.read_log(METRICS, S.PIPELINE_METRICS_DDL)
    span = F.col("finished_at").cast("double") - F.col("started_at").cast("double")
    ok = F.col("duration_seconds").between(0, 86400) & (F.abs(span - F.col("duration_seconds")) < 0.01)
    return m.select(
        "pipeline_name", "day", "rows_inserted", "rows_updated", "rows_deleted", "rows_stale", "rows_kept", "rows_reassigned", "rows_affected", "status",
        ok.alias("duration_ok"),
    )


# ---------------------------------------------------------------------------
# J-07: the change log of three versions
# ---------------------------------------------------------------------------
def _pairs(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """(order, customer) pairs of a version: an order leaves, comes back, or comes new by its status."""
    keep = {1: "o_orderstatus IN ('F', 'P')", 2: "o_orderstatus IN ('F', 'O')", 3: "o_orderstatus IN ('P', 'O')"}[version]
    return table(spark, sf_dir, "orders").where(keep).select(F.col("o_custkey").alias("agent_id"), F.col("o_orderkey").alias("role_id"))


@register(
    "assignment_history_versions",
    """
SELECT o_custkey AS agent_id, o_orderkey AS role_id, unnest(CASE o_orderstatus
         WHEN 'F' THEN ['assigned 1', 'removed 3'] WHEN 'P' THEN ['assigned 1', 'removed 2', 'assigned 3'] ELSE ['assigned 2'] END) AS change
FROM orders WHERE o_orderstatus IN ('F', 'P', 'O')""",
)
def assignment_history_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-05..J-07: three versions of a mapping; the log is what each two of them differ in."""
    from syncforge.operators.assignments import empty_mapping, merge_assignments
    from syncforge.operators.changes import assignment_changes

    before, log = empty_mapping(spark), None
    for version in (1, 2, 3):
        after = materialize(merge_assignments(before, _pairs(spark, sf_dir, version), f"2024-05-0{version} 12:00:00").drop("_action"))
        changes = assignment_changes(before, after)
        rows = changes.select("agent_id", "role_id", F.concat_ws(" ", "action", F.dayofmonth("action_time").cast("string")).alias("change"))
        log = rows if log is None else log.unionByName(rows)
        before = after
    return log


# ---------------------------------------------------------------------------
# J-15: keys that clash inside a batch and with stored rows
# ---------------------------------------------------------------------------
def _keyed(o: DataFrame) -> DataFrame:
    key = F.concat_ws("-", _text("o_custkey"), F.date_format("o_orderdate", "yyyy-MM"))
    return o.select(_text("o_orderkey").alias("transaction_id"), key.alias("idempotency_key"))


@register(
    "key_index_clashes",
    """
WITH k AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey || '-' || strftime(o_orderdate, '%Y-%m') AS key, o_orderstatus AS st, o_orderkey FROM orders),
stored AS (SELECT key, CAST(min(o_orderkey) AS VARCHAR) AS owner FROM k WHERE st = 'F' GROUP BY key),
staged AS (SELECT id, key, count(*) OVER (PARTITION BY key) AS n FROM k WHERE st <> 'F')
SELECT id AS transaction_id, key AS idempotency_key, n > 1 OR key IN (SELECT key FROM stored) AS clashes FROM staged""",
)
def key_index_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-15: the first finished order of a customer and month owns its key; all others are staged against the index."""
    o = table(spark, sf_dir, "orders")
    store = TableStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/keys-{uuid.uuid4().hex}", buckets=16)
    index = key_index(store)
    stored = _keyed(o.where("o_orderstatus = 'F'")).groupBy("idempotency_key").agg(F.min(F.col("transaction_id").cast("long")).cast("string").alias("transaction_id"))
    index.stage(1, stored, stored.where("false"))
    index.switch(1)
    good, bad = split_clashes(_keyed(o.where("o_orderstatus <> 'F'")), index)
    return good.withColumn("clashes", F.lit(False)).unionByName(bad.withColumn("clashes", F.lit(True)))


# ---------------------------------------------------------------------------
# I-18, B-12, B-15: money is exact, and so is its text in the key
# ---------------------------------------------------------------------------
@register(
    "exact_money",
    """
WITH m AS (
  SELECT o_orderkey AS k, o_orderdate AS d, CAST(123456789012345 + 7919 * o_orderkey AS VARCHAR) AS minor, CAST(o_orderkey % 10 AS BIGINT) AS e FROM orders),
p AS (SELECT *, substr(minor, 1, length(minor) - e) || '.' || rpad(substr(minor, length(minor) - e + 1, e), 9, '0') AS full_text FROM m),
t AS (SELECT *, rtrim(rtrim(full_text, '0'), '.') AS canonical FROM p)
SELECT CAST(k AS VARCHAR) AS transaction_id, full_text AS original_amount, CAST(round(CAST(full_text AS DECIMAL(28, 9)) * CAST('0.5' AS DECIMAL(2, 1)), 9) AS DECIMAL(38, 9))::VARCHAR AS amount_usd,
       sha256(concat_ws('||', k, 't-' || k, strftime(d, '%Y-%m-%d %H:%M:%S'), canonical, 'EUR')) AS idempotency_key
FROM t""",
)
def exact_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen digits and up to nine decimals, from the text of the export to the text of the key."""
    o = table(spark, sf_dir, "orders")
    key = _text("o_orderkey")
    rec = Q.record(
        S.TRANSACTION_RECORD,
        {
            "id": key,
            "uuid": F.concat(F.lit("t-"), key),
            "occurredTime": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
            "originalCurrencyAmount": _text(F.lit(123456789012345) + F.lit(7919) * F.col("o_orderkey")),
            "exponent": _text(F.col("o_orderkey") % 10),
            "originalCurrencyCode": F.lit("EUR"),
            "exchangeRate": F.lit("0.5"),
        },
    )
    valid, _ = txn.transform(o.select(rec.alias("r")).select("r.*"), spark.createDataFrame([], S.FX_RATES_DDL))
    plain = lambda c: F.format_string("%s", F.col(c).cast("string")).alias(c)
    return valid.select("transaction_id", plain("original_amount"), plain("amount_usd"), "idempotency_key")
