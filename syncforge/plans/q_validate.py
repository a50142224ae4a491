"""Validation queries: rule tables, quarantine split, the ordered
transaction rules with FX conversion, and the idempotency key
(C-01..C-10, B-12..B-15, D-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from syncforge.functions import idempotency_key
from syncforge.operators.validate import null_or_non_negative, required, split_valid
from syncforge.plans.entities import transactions as txn
from syncforge.plans.registry import register
from syncforge.plans.tables import table
from syncforge.schemas import CURRENCY_DATA, TRANSACTION_RECORD

# Test parameter: currency of each nation (index = n_nationkey); 16 is not
# an ISO code and 17 has none, to drive the currency rule.
NATION_CURRENCY = [
    "USD", "EUR", "GBP", "INR", "JPY", "CAD", "AUD", "CHF", "CNY", "BRL", "MXN", "ZAR", "SEK",
    "NOK", "DKK", "PLN", "XYZ", None, "SGD", "NZD", "KRW", "TRY", "AED", "THB", "EGP",
]
NO_API_RATE = "CHF"  # rates table has no CHF quotes: payload or missing


def _sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _agents_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("src_key"),
        F.when((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0), F.lit(None))
        .otherwise(F.col("c_custkey"))
        .alias("agent_id"),
        F.when(F.col("c_nationkey") == 7, F.lit(None))
        .otherwise(F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.org")))
        .alias("email"),
        F.when((F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_acctbal") > 5000), F.lit(None))
        .otherwise(F.col("c_name"))
        .alias("name"),
    )


AGENT_REQUIRED_MSG = "agent_id, email, and name are required"


@register(
    "required_split",
    f"""
WITH a AS (
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 0 THEN NULL ELSE c_custkey END AS agent_id,
         CASE WHEN c_nationkey = 7 THEN NULL ELSE 'user' || c_custkey || '@example.org' END AS email,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 5000 THEN NULL ELSE c_name END AS name
  FROM customer)
SELECT 'agents' AS entity, CAST(agent_id AS VARCHAR) AS record_key,
       agent_id IS NOT NULL AND email IS NOT NULL AND name IS NOT NULL AS is_valid,
       CASE WHEN agent_id IS NULL OR email IS NULL OR name IS NULL THEN 'MISSING_REQUIRED_FIELD' END AS error_type,
       CASE WHEN agent_id IS NULL OR email IS NULL OR name IS NULL THEN '{AGENT_REQUIRED_MSG}' END AS error_message
FROM a""",
)
def required_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-01/C-02/C-03/C-10: required fields; failures go to the quarantine shape."""
    df = _agents_like(spark, sf_dir)
    rule = required("MISSING_REQUIRED_FIELD", AGENT_REQUIRED_MSG, "agent_id", "email", "name")
    valid, errors = split_valid(df, [rule], "agents", F.col("agent_id"), F.to_json(F.struct("*")))
    ok = valid.select(
        F.lit("agents").alias("entity"),
        F.col("agent_id").cast("string").alias("record_key"),
        F.lit(True).alias("is_valid"),
        F.lit(None).cast("string").alias("error_type"),
        F.lit(None).cast("string").alias("error_message"),
    )
    bad = errors.select("entity", "record_key", F.lit(False).alias("is_valid"), "error_type", "error_message")
    return ok.unionByName(bad)


CARD_MSG = "One or more mandatory fields are invalid"


@register(
    "range_split",
    f"""
WITH c AS (
  SELECT CAST(c_custkey AS VARCHAR) AS card_id, c_mktsegment AS status,
         CASE WHEN c_nationkey < 3 THEN NULL ELSE 'virtual' END AS type,
         c_acctbal AS current_limit,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_acctbal - 100.0 END AS current_spent,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN -1.0 ELSE NULL END AS recurring_limit
  FROM customer),
t AS (
  SELECT card_id,
         card_id IS NULL OR status IS NULL OR type IS NULL
         OR COALESCE(current_limit < 0, FALSE) OR COALESCE(current_spent < 0, FALSE)
         OR COALESCE(recurring_limit < 0, FALSE) AS bad
  FROM c)
SELECT 'cards' AS entity, card_id AS record_key, NOT bad AS is_valid,
       CASE WHEN bad THEN 'VALIDATION_ERROR' END AS error_type,
       CASE WHEN bad THEN '{CARD_MSG}' END AS error_message
FROM t""",
)
def range_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-04: required fields plus amounts that must be NULL or >= 0."""
    c = table(spark, sf_dir, "customer")
    df = c.select(
        F.col("c_custkey").cast("string").alias("card_id"),
        F.col("c_mktsegment").alias("status"),
        F.when(F.col("c_nationkey") < 3, F.lit(None)).otherwise(F.lit("virtual")).alias("type"),
        F.col("c_acctbal").alias("current_limit"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit(None))
        .otherwise(F.col("c_acctbal") - F.lit(100.0))
        .alias("current_spent"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(-1.0)).otherwise(F.lit(None)).alias("recurring_limit"),
    )
    rules = [
        required("VALIDATION_ERROR", CARD_MSG, "card_id", "status", "type"),
        null_or_non_negative("VALIDATION_ERROR", CARD_MSG, "current_limit", "current_spent", "recurring_limit"),
    ]
    valid, errors = split_valid(df, rules, "cards", F.col("card_id"), F.to_json(F.struct("*")))
    ok = valid.select(
        F.lit("cards").alias("entity"),
        F.col("card_id").alias("record_key"),
        F.lit(True).alias("is_valid"),
        F.lit(None).cast("string").alias("error_type"),
        F.lit(None).cast("string").alias("error_message"),
    )
    bad = errors.select("entity", "record_key", F.lit(False).alias("is_valid"), "error_type", "error_message")
    return ok.unionByName(bad)


# ---------------------------------------------------------------------------
# Orders as raw transaction records
# ---------------------------------------------------------------------------
def _orders_ctx(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cur = F.element_at(F.array(*[F.lit(v).cast("string") for v in NATION_CURRENCY]), F.col("n_nationkey") + 1)
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("currency", cur)
    )


def orders_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transaction snapshot rows in the declared read schema.

    Fulfilled orders arrive as one-record ``results`` envelopes, the rest as
    flat rows; MEDIUM-priority orders carry the currency fields flat
    instead of under ``currencyData``. Bad values are planted by status and
    priority so every rule fires on a predictable subset.
    """
    x = _orders_ctx(spark, sf_dir)
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    iso = "yyyy-MM-dd'T'HH:mm:ss"  # zone-less: wall-clock in any session zone
    amount_text = (
        F.when((pr == "4-NOT SPECIFIED") & (st == "P"), F.lit(""))
        .when((pr == "5-LOW") & (st == "P"), F.lit("0"))
        .when((pr == "1-URGENT") & (st == "F"), F.lit("abc"))
        .otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"))
    )
    exponent = F.when((pr == "2-HIGH") & (st == "F"), F.lit("two")).otherwise(F.lit("2"))
    payload_rate = F.when(st == "O", F.lit("0.5")).otherwise(F.lit(None).cast("string"))
    flat_cd = pr == "3-MEDIUM"
    none = F.lit(None).cast("string")
    cd = F.when(
        ~flat_cd,
        F.struct(
            amount_text.alias("originalCurrencyAmount"),
            exponent.alias("exponent"),
            F.col("currency").alias("originalCurrencyCode"),
            payload_rate.alias("exchangeRate"),
        ),
    ).otherwise(F.lit(None).cast(CURRENCY_DATA))
    fields = {
        "id": F.when((pr == "1-URGENT") & (st == "P"), none).otherwise(F.col("o_orderkey").cast("string")),
        "uuid": F.when((pr == "2-HIGH") & (st == "P"), none).otherwise(
            F.concat(F.lit("t-"), F.col("o_orderkey").cast("string"))
        ),
        "occurredTime": F.when((pr == "3-MEDIUM") & (st == "P"), F.lit("not-a-time")).otherwise(
            F.date_format("o_orderdate", iso)
        ),
        "updatedTime": F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), iso),
        "userId": F.col("o_custkey").cast("string"),
        "userUuid": none,
        "userName": F.col("c_name"),
        "merchantName": F.col("n_name"),
        "rawMerchantName": F.lower("n_name"),
        "cardId": none,
        "cardUuid": none,
        "budgetId": none,
        "budgetUuid": none,
        "currencyData": cd,
        "originalCurrencyAmount": F.when(flat_cd, amount_text).otherwise(none),
        "exponent": F.when(flat_cd, exponent).otherwise(none),
        "originalCurrencyCode": F.when(flat_cd, F.col("currency")).otherwise(none),
        "exchangeRate": F.when(flat_cd, payload_rate).otherwise(none),
    }
    rec = F.struct(*[fields[f.name].cast(f.dataType).alias(f.name) for f in TRANSACTION_RECORD.fields])
    wrapped = st == "F"
    cols = [
        F.when(wrapped, F.array(rec)).otherwise(F.lit(None).cast(ArrayType(TRANSACTION_RECORD))).alias("results")
    ]
    for f in TRANSACTION_RECORD.fields:
        cols.append(F.when(wrapped, F.lit(None).cast(f.dataType)).otherwise(fields[f.name].cast(f.dataType)).alias(f.name))
    return x.select(*cols)


def orders_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates table derived from the orders: one quote per (order day, currency)."""
    x = _orders_ctx(spark, sf_dir)
    return (
        x.filter(F.col("currency").isNotNull() & (F.col("currency") != NO_API_RATE))
        .select(
            F.to_date("o_orderdate").alias("fx_date"),
            F.col("currency"),
            ((F.col("n_nationkey") + 1) / F.lit(4.0)).alias("usd_quote"),
        )
        .distinct()
    )


def _txn_frames(spark: SparkSession, sf_dir: str):
    return txn.transform(orders_as_transactions(spark, sf_dir), orders_fx_rates(spark, sf_dir), day="d1")


_TXN_BASE_SQL = f"""
WITH x AS (
  SELECT o.*, n.n_nationkey,
         {_sql_list(NATION_CURRENCY)}[n.n_nationkey + 1] AS cur
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
y AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL
              ELSE CAST(o_orderkey AS VARCHAR) END AS transaction_id,
         o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' AS no_uuid,
         o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' AS no_time,
         o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' AS empty_amount,
         cur AS original_currency,
         cur IS NOT NULL AND cur <> 'XYZ' AS currency_ok,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 0.0::DOUBLE
              WHEN (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
                OR (o_orderpriority = '2-HIGH' AND o_orderstatus = 'F')
                OR (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P') THEN NULL
              ELSE CAST(round(o_totalprice * 100) AS DOUBLE) / 100.0::DOUBLE END AS original_amount,
         CASE WHEN cur = 'USD' THEN 1.0::DOUBLE
              WHEN cur IS NOT NULL AND cur <> '{NO_API_RATE}'
              THEN 1.0::DOUBLE / ((n_nationkey + 1) / 4.0::DOUBLE) END AS api_rate,
         CASE WHEN o_orderstatus = 'O' THEN 0.5::DOUBLE END AS payload_rate
  FROM x),
z AS (
  SELECT *,
         COALESCE(api_rate, payload_rate) AS exchange_rate,
         CASE WHEN api_rate IS NOT NULL THEN 'API' WHEN payload_rate IS NOT NULL THEN 'PAYLOAD'
              ELSE 'MISSING' END AS fx_source,
         CASE WHEN transaction_id IS NULL THEN '{txn.MSG_ID}'
              WHEN no_uuid THEN '{txn.MSG_UUID}'
              WHEN no_time THEN '{txn.MSG_OCCURRED}'
              WHEN empty_amount THEN '{txn.MSG_EMPTY_AMOUNT}'
              WHEN NOT currency_ok THEN '{txn.MSG_CURRENCY}'
              WHEN original_amount IS NULL OR original_amount = 0 THEN '{txn.MSG_AMOUNT}'
              WHEN COALESCE(api_rate, payload_rate) IS NULL THEN '{txn.MSG_RATE}'
         END AS error_message
  FROM y)"""


@register(
    "rule_cascade",
    _TXN_BASE_SQL
    + """
SELECT transaction_id AS record_key,
       CASE WHEN error_message IS NOT NULL THEN 'VALIDATION_ERROR' END AS error_type,
       error_message
FROM z""",
)
def rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-05..C-07: the ordered transaction rules; the first failure names the
    error (NULL for a valid record). One pass over the tagged records."""
    t = txn.tagged(orders_as_transactions(spark, sf_dir), orders_fx_rates(spark, sf_dir))
    return t.select(
        F.col("transaction_id").alias("record_key"),
        F.col("_error.error_type").alias("error_type"),
        F.col("_error.error_message").alias("error_message"),
    )


@register(
    "minor_unit_usd",
    _TXN_BASE_SQL
    + """
SELECT transaction_id, original_amount, original_currency, exchange_rate, fx_source,
       original_amount * exchange_rate AS amount_usd
FROM z WHERE error_message IS NULL""",
)
def minor_unit_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-12..B-14 / D-06: minor units scaled, rate by (day, currency) with
    API -> PAYLOAD -> MISSING precedence, USD amount."""
    valid, _ = _txn_frames(spark, sf_dir)
    return valid.select(
        "transaction_id", F.col("original_amount").cast("double"), "original_currency", "exchange_rate", "fx_source", F.col("amount_usd").cast("double")
    )


@register(
    "idempotency_key",
    """
SELECT o_orderkey,
       sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR),
                        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END,
                        CAST(o_orderdate AS VARCHAR), o_orderstatus, o_orderpriority)) AS idempotency_key
FROM orders""",
)
def idempotency_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-15: SHA-256 over the '||'-joined text of the key parts (NULL parts skipped)."""
    o = table(spark, sf_dir, "orders")
    cust = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey"))
    return o.select(
        "o_orderkey",
        idempotency_key("o_orderkey", cust, "o_orderdate", "o_orderstatus", "o_orderpriority").alias(
            "idempotency_key"
        ),
    )
