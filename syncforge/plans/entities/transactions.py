"""Transactions: unwrap -> fields -> FX -> ordered rules -> key -> dedup.

Fields are read from the declared record struct (parsed once by the JSON
reader), with the flat layout as fallback for the ``currencyData`` fields.
The FX rate is a join with the rates table (no driver collect, no UDF).
Rules run in a fixed order and the first failure names the error. The
idempotency key is derived for valid rows, which are then deduplicated on
it, latest ``updated_time`` first. The transaction id is part of that
dedup key: two transactions that share an idempotency key both stay, for the
uniqueness check (J-15) to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.functions import empty_to_null, idempotency_key, money_text, try_double, try_int, try_timestamp
from syncforge.operators.dedup import latest_per_key
from syncforge.operators.envelope import RECORD, unwrap
from syncforge.operators.fx import convert_to_usd, minor_to_major
from syncforge.operators.validate import Rule, split_valid, tag_errors
from syncforge.schemas import CURRENCY_CODES

ENTITY = "transactions"
ERROR_TYPE = "VALIDATION_ERROR"

# Rule messages, in evaluation order.
MSG_ID = "transaction_id is null"
MSG_UUID = "transaction_uuid is null"
MSG_OCCURRED = "occurred_time is null"
MSG_EMPTY_AMOUNT = "Currency amount cannot be empty"
MSG_CURRENCY = "Invalid currency code"
MSG_CURRENCY_NULL = "original_currency is null"
MSG_AMOUNT = "original_amount is null or zero"
MSG_RATE = "exchange_rate not found (api + payload)"

VALID_COLUMNS = (
    "transaction_id", "transaction_uuid", "occurred_time", "updated_time", "user_id", "user_uuid",
    "user_name", "merchant_name", "raw_merchant_name", "card_id", "card_uuid", "budget_id",
    "budget_uuid", "original_amount", "original_currency", "amount_usd", "exchange_rate",
    "fx_source", "idempotency_key", "raw_payload",
)


def _cd(field: str):
    """``currencyData.<field>`` with the flat ``<field>`` as fallback."""
    return F.coalesce(F.col(f"{RECORD}.currencyData.{field}"), F.col(f"{RECORD}.{field}"))


def normalize(raw: DataFrame) -> DataFrame:
    r = unwrap(raw, "results")
    amount_text = _cd("originalCurrencyAmount")
    currency = _cd("originalCurrencyCode")
    amount = minor_to_major(empty_to_null(amount_text), try_int(_cd("exponent")))
    return r.select(
        F.col(f"{RECORD}.id").alias("transaction_id"),
        F.col(f"{RECORD}.uuid").alias("transaction_uuid"),
        try_timestamp(F.col(f"{RECORD}.occurredTime")).alias("occurred_time"),
        try_timestamp(F.col(f"{RECORD}.updatedTime")).alias("updated_time"),
        F.col(f"{RECORD}.userId").alias("user_id"),
        F.col(f"{RECORD}.userUuid").alias("user_uuid"),
        F.col(f"{RECORD}.userName").alias("user_name"),
        F.col(f"{RECORD}.merchantName").alias("merchant_name"),
        F.col(f"{RECORD}.rawMerchantName").alias("raw_merchant_name"),
        F.col(f"{RECORD}.cardId").alias("card_id"),
        F.col(f"{RECORD}.cardUuid").alias("card_uuid"),
        F.col(f"{RECORD}.budgetId").alias("budget_id"),
        F.col(f"{RECORD}.budgetUuid").alias("budget_uuid"),
        amount.alias("original_amount"),
        currency.alias("original_currency"),
        try_double(_cd("exchangeRate")).alias("payload_exchange_rate"),
        F.coalesce(F.trim(amount_text) == F.lit(""), F.lit(False)).alias("is_amount_empty"),
        F.coalesce(currency.isin(list(CURRENCY_CODES)), F.lit(False)).alias("is_currency_valid"),
        F.to_json(F.col(RECORD)).alias("raw_payload"),
    )


def rules() -> list[Rule]:
    c = F.col
    return [
        Rule(ERROR_TYPE, MSG_ID, c("transaction_id").isNull()),
        Rule(ERROR_TYPE, MSG_UUID, c("transaction_uuid").isNull()),
        Rule(ERROR_TYPE, MSG_OCCURRED, c("occurred_time").isNull()),
        Rule(ERROR_TYPE, MSG_EMPTY_AMOUNT, c("is_amount_empty")),
        Rule(ERROR_TYPE, MSG_CURRENCY, ~c("is_currency_valid")),
        Rule(ERROR_TYPE, MSG_CURRENCY_NULL, c("original_currency").isNull()),
        Rule(ERROR_TYPE, MSG_AMOUNT, c("original_amount").isNull() | (c("original_amount") == 0)),
        Rule(ERROR_TYPE, MSG_RATE, c("exchange_rate").isNull()),
    ]


def prepared(raw: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Normalized records with the FX rate applied (before the rules)."""
    df = normalize(raw).withColumn("fx_date", F.to_date("occurred_time"))
    return convert_to_usd(df, fx_rates, "fx_date", "original_currency", "original_amount", "payload_exchange_rate")


def tagged(raw: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Every record with its first failing rule (``_error``, NULL when valid)."""
    return tag_errors(prepared(raw, fx_rates), rules())


def transform(
    raw: DataFrame,
    fx_rates: DataFrame,
    day: str | None = None,
    run_ts=None,
    hold: list | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(valid transactions, quarantine rows) for one snapshot."""
    df = prepared(raw, fx_rates)
    valid, errors = split_valid(
        df, rules(), ENTITY, F.col("transaction_id"), F.col("raw_payload"), day, run_ts, hold=hold
    )
    valid = valid.withColumn(
        "idempotency_key",
        idempotency_key("transaction_id", "transaction_uuid", "occurred_time", money_text("original_amount"), "original_currency"),
    )
    valid = latest_per_key(
        valid, ["idempotency_key", "transaction_id"], ["updated_time desc_nulls_last"], tie_break=[F.xxhash64("raw_payload").desc()]
    )
    valid = valid.select(*VALID_COLUMNS, F.lit(run_ts).cast("timestamp").alias("ingested_at"))
    return valid, errors
