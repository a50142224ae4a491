"""What the entity transforms reject, and how they deduplicate.

The quarantine queries run the same driver-table records as the ``*_sync``
queries and return the rejected side: key, error type, message and the raw
record (whole for member and role pairs and for budgets; its id and some
fields for the others). The ``*_latest`` queries feed records whose keys
really repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncforge import schemas as S
from syncforge.plans import q_entities as Q
from syncforge.plans.entities import agent_roles, agents, budgets, cards, groups, roles, transactions
from syncforge.plans.q_validate import _TXN_BASE_SQL, orders_as_transactions, orders_fx_rates
from syncforge.plans.registry import register
from syncforge.plans.tables import table

DAY = "sf"


def _run_ts():
    return F.lit(Q.RUN_TS).cast("timestamp")


def _entity_rows(errors: DataFrame, *more: str) -> DataFrame:
    return errors.select(
        "entity", "record_key", "error_type", "error_message", "sync_day", "created_at",
        F.get_json_object("raw_record", "$.id").alias("raw_id"), *more,
    )


def _pair_rows(errors: DataFrame) -> DataFrame:
    return errors.select("entity", "record_key", "error_type", "error_message", "raw_record")


_STAMP = "'sf' AS sync_day, TIMESTAMP '2024-06-01 00:00:00' AS created_at"


@register(
    "agents_quarantine",
    f"""
SELECT 'agents' AS entity,
       CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS record_key,
       'MISSING_REQUIRED_FIELD' AS error_type, 'agent_id, email, and name are required' AS error_message,
       CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN 'x' ELSE '' END || c_custkey AS raw_id,
       {_STAMP}
FROM customer
WHERE (c_mktsegment = 'MACHINERY' AND c_acctbal < 0) OR c_nationkey = 7""",
)
def agents_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-01 / C-10: agents without a readable id or an email."""
    _, errors = agents.transform(*Q.agents_input(spark, sf_dir), DAY, _run_ts())
    return _entity_rows(errors)


@register(
    "cards_quarantine",
    f"""
SELECT 'cards' AS entity, 'c' || p_partkey AS record_key, 'VALIDATION_ERROR' AS error_type,
       'One or more mandatory fields are invalid' AS error_message, 'c' || p_partkey AS raw_id, {_STAMP}
FROM part WHERE p_size < 5 OR p_retailprice - 950.0 < 0""",
)
def cards_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-04 / C-10: cards without a status or with a negative limit."""
    _, errors = cards.transform(Q.cards_input(spark, sf_dir), DAY, _run_ts())
    return _entity_rows(errors)


@register(
    "budgets_quarantine",
    f"""
SELECT 'budgets' AS entity, 'b' || s_suppkey AS record_key, 'VALIDATION_ERROR' AS error_type,
       'budget_id or limit_amount is null' AS error_message, 'b' || s_suppkey AS raw_id, {_STAMP},
       '{{"id":"b' || s_suppkey || '","name":"' || s_name || '","retired":"false","startDate":"2024-05-15","currentPeriod":{{}}}}' AS raw_record
FROM supplier WHERE s_nationkey = 3""",
)
def budgets_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-03 / C-10: budgets without a limit."""
    _, errors = budgets.transform(Q.budgets_input(spark, sf_dir), DAY, _run_ts())
    return _entity_rows(errors, "raw_record")


@register(
    "agent_roles_quarantine",
    """
SELECT 'agent_roles' AS entity, CAST(c_nationkey + 1000 AS VARCHAR) AS record_key, 'INVALID_ROLE_ID' AS error_type,
       'Role ID not found in roles master' AS error_message,
       '{"agent_id":' || c_custkey || ',"role_id":' || (c_nationkey + 1000) || '}' AS raw_record
FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT 'agent_roles', CAST(c_custkey AS VARCHAR), 'INVALID_ROLE_IDS', 'role_ids is not a list of ids',
       '{"agent_id":' || c_custkey || ',"role_ids":"' || c_nationkey || ',1"}'
FROM customer WHERE c_mktsegment = 'MACHINERY'""",
)
def agent_roles_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-04 / C-10: pairs with an unknown role, role lists that are no lists."""
    _, errors, _ = agent_roles.transform(*Q.agent_roles_input(spark, sf_dir), DAY, _run_ts())
    return _pair_rows(errors)


@register(
    "groups_quarantine",
    """
WITH listed AS (
  SELECT p_partkey AS g, UNNEST([p_size, p_size + 100000]) AS a FROM part WHERE p_type NOT IN ('PROMO', 'LARGE', 'STANDARD'))
SELECT 'group_membership' AS entity, CAST(g AS VARCHAR) AS record_key, 'INVALID_AGENT_ID' AS error_type,
       'agent_id does not exist in agents table' AS error_message,
       '{"group_id":' || g || ',"agent_id":' || a || '}' AS raw_record
FROM listed WHERE a NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL
SELECT 'group_membership', CAST(p_partkey AS VARCHAR), 'INVALID_AGENT_IDS', 'agent_ids is not a list of ids',
       '{"group_id":' || p_partkey || ',"agent_ids":"' || p_size || ',2"}'
FROM part WHERE p_type = 'STANDARD'""",
)
def groups_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D-03 / C-10: unknown members, member lists that are no lists."""
    *_, errors = groups.transform(*Q.groups_input(spark, sf_dir), DAY, _run_ts())
    return _pair_rows(errors)


# ---------------------------------------------------------------------------
# roles: orders as role records, one role per customer, many records each
# ---------------------------------------------------------------------------
def roles_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested ``role.*`` for finished orders, flat fields for the others; no
    name for customers below 10. What a record says depends on its customer
    and date alone, so records of one date agree."""
    o = table(spark, sf_dir, "orders")
    when = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    name = F.when(F.col("o_custkey") >= 10, F.concat(F.lit("role "), when))
    values = {
        "name": name,
        "default": F.when(F.month("o_orderdate") <= 6, F.lit("true")).otherwise(F.lit("false")),
        "updated_at": when,
    }
    nested = F.col("o_orderstatus") == "F"
    rec = Q.record(
        S.ROLE_RECORD,
        {
            "id": F.col("o_custkey").cast("string"),
            "role": F.when(nested, Q.record(S.ROLE_RECORD["role"].dataType, values)),
            **{f: F.when(~nested, v) for f, v in values.items()},
        },
    )
    return o.select(*Q.raw_rows(S.envelope(S.ROLE_RECORD), rec, F.col("o_orderpriority") == "1-URGENT"))


@register(
    "roles_sync",
    """
SELECT o_custkey AS role_id, 'role ' || strftime(MAX(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS name,
       CAST(NULL AS VARCHAR) AS description, MONTH(MAX(o_orderdate)) <= 6 AS is_default,
       CAST(NULL AS VARCHAR) AS agent_type, CAST(NULL AS TIMESTAMP) AS created_at, MAX(o_orderdate) AS updated_at
FROM orders WHERE o_custkey >= 10 GROUP BY o_custkey""",
)
def roles_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-02 / B-05 / B-06 / F-*: every column of the roles, latest record per id."""
    valid, _ = roles.transform(roles_input(spark, sf_dir), DAY, _run_ts())
    return valid


@register(
    "roles_quarantine",
    f"""
SELECT 'roles' AS entity, CAST(o_custkey AS VARCHAR) AS record_key, 'MISSING_REQUIRED_FIELD' AS error_type,
       'Role id or name is null' AS error_message, CAST(o_custkey AS VARCHAR) AS raw_id, {_STAMP}
FROM orders WHERE o_custkey < 10""",
)
def roles_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-02 / C-10: roles without a name, one row per record."""
    _, errors = roles.transform(roles_input(spark, sf_dir), DAY, _run_ts())
    return _entity_rows(errors)


# ---------------------------------------------------------------------------
# repeated keys
# ---------------------------------------------------------------------------
@register(
    "cards_latest",
    """
SELECT 'c' || o_custkey AS card_id, CAST(MONTH(MAX(o_orderdate)) AS DOUBLE) AS current_limit,
       MAX(o_orderdate) AS updated_time
FROM orders GROUP BY o_custkey""",
)
def cards_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-05: a card sent many times counts with its latest update."""
    o = table(spark, sf_dir, "orders")
    rec = Q.record(
        S.CARD_RECORD,
        {
            "id": F.concat(F.lit("c"), F.col("o_custkey").cast("string")),
            "status": F.lit("active"),
            "type": F.lit("virtual"),
            "currentPeriod": {"limit": F.month("o_orderdate").cast("string")},
            "createdTime": F.lit("1990-01-01T00:00:00"),
            "updatedTime": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        },
    )
    raw = o.select(*Q.raw_rows(S.envelope(S.CARD_RECORD), rec, F.col("o_orderstatus") == "F"))
    valid, _ = cards.transform(raw, DAY, _run_ts())
    return valid.select("card_id", F.col("current_limit").cast("double"), "updated_time")


@register(
    "transactions_latest",
    """
SELECT 't' || l_orderkey AS transaction_id, 12.5 AS original_amount, 12.5 AS amount_usd, 'API' AS fx_source,
       'm ' || strftime(MAX(l_shipdate), '%Y-%m-%dT%H:%M:%S') AS merchant_name, MAX(l_shipdate) AS updated_time
FROM lineitem GROUP BY l_orderkey""",
)
def transactions_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-06: line items as repeated records of their order's transaction."""
    li = table(spark, sf_dir, "lineitem")
    when = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")
    rec = Q.record(
        S.TRANSACTION_RECORD,
        {
            "id": F.concat(F.lit("t"), F.col("l_orderkey").cast("string")),
            "uuid": F.concat(F.lit("u"), F.col("l_orderkey").cast("string")),
            "occurredTime": F.lit("1990-01-01T00:00:00"),
            "updatedTime": when,
            "merchantName": F.concat(F.lit("m "), when),
            "currencyData": {
                "originalCurrencyAmount": F.lit("1250"), "exponent": F.lit("2"), "originalCurrencyCode": F.lit("USD"),
            },
        },
    )
    raw = li.select(*Q.raw_rows(S.envelope(S.TRANSACTION_RECORD), rec, F.col("l_linenumber") % 2 == 1))
    no_rates = spark.createDataFrame([], S.FX_RATES_DDL)
    valid, _ = transactions.transform(raw, no_rates, DAY, _run_ts())
    return valid.select("transaction_id", F.col("original_amount").cast("double"), F.col("amount_usd").cast("double"), "fx_source", "merchant_name", "updated_time")


@register(
    "transactions_quarantine",
    _TXN_BASE_SQL
    + f"""
SELECT 'transactions' AS entity, transaction_id AS record_key, 'VALIDATION_ERROR' AS error_type, error_message, {_STAMP},
       transaction_id AS raw_id, CASE WHEN NOT no_uuid THEN 't-' || o_orderkey END AS raw_uuid, original_currency AS raw_currency
FROM z WHERE error_message IS NOT NULL""",
)
def transactions_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-05..C-07, C-10: each bad record once, with its first failure and its raw payload."""
    _, errors = transactions.transform(orders_as_transactions(spark, sf_dir), orders_fx_rates(spark, sf_dir), DAY, _run_ts())
    raw = lambda path: F.get_json_object("raw_record", path)
    errors = errors.withColumns(
        {"raw_uuid": raw("$.uuid"), "raw_currency": F.coalesce(raw("$.currencyData.originalCurrencyCode"), raw("$.originalCurrencyCode"))}
    )
    return _entity_rows(errors, "raw_uuid", "raw_currency")
