"""Cards: envelope or flat records -> validated, deduplicated cards
(B-01, B-07, B-10, C-04, F-02, F-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.functions import MONEY, try_bool, try_decimal, try_timestamp
from syncforge.functions.casts import unreadable
from syncforge.operators.dedup import latest_per_key
from syncforge.operators.envelope import RECORD, unwrap
from syncforge.operators.validate import Rule, null_or_non_negative, required, split_valid
from syncforge.schemas import FILE, FILE_TIME
from syncforge.sources.lineage import LATEST_FILE, day_of, lineage

ENTITY = "cards"
SOURCE = "api"
# Quarantine type and message.
ERROR_TYPE = "VALIDATION_ERROR"
MESSAGE = "One or more mandatory fields are invalid"


def normalize(raw: DataFrame, day: str | None, run_ts) -> DataFrame:
    r = unwrap(raw, "results", carry=(FILE, FILE_TIME))
    c = lambda p: F.col(f"{RECORD}.{p}")
    return r.select(
        c("id").alias("card_id"),
        c("uuid").alias("card_uuid"),
        c("name").alias("name"),
        c("userId").alias("user_id"),
        c("userUuid").alias("user_uuid"),
        c("budgetId").alias("budget_id"),
        c("budgetUuid").alias("budget_uuid"),
        c("lastFour").alias("last_four"),
        c("validThru").alias("valid_thru"),
        c("status").alias("status"),
        c("type").alias("type"),
        try_bool(c("shareBudgetFunds")).alias("share_budget_funds"),
        try_bool(c("recurring")).alias("recurring"),
        try_decimal(c("recurringLimit")).alias("recurring_limit"),
        try_decimal(c("currentPeriod.limit")).alias("current_limit"),
        try_decimal(c("currentPeriod.spent")).alias("current_spent"),
        try_timestamp(c("createdTime")).alias("created_time"),
        try_timestamp(c("updatedTime")).alias("updated_time"),
        day_of(r, day).alias("last_synced_day"),
        F.lit(SOURCE).alias("source"),
        F.lit(run_ts).cast("timestamp").alias("ingested_at"),
        *lineage(r),
        F.to_json(F.col(RECORD)).alias("_raw"),
        # sent, but not a number or a time: such a row is no card with a NULL there
        (
            unreadable(c("recurringLimit"), MONEY)
            | unreadable(c("currentPeriod.limit"), MONEY)
            | unreadable(c("currentPeriod.spent"), MONEY)
            | unreadable(c("updatedTime"), "timestamp")
        ).alias("_unreadable"),
    )


def transform(
    raw: DataFrame, day: str | None = None, run_ts=None, hold: list | None = None
) -> tuple[DataFrame, DataFrame]:
    df = normalize(raw, day, run_ts)
    rules = [
        required(ERROR_TYPE, MESSAGE, "card_id", "status", "type", "created_time"),
        Rule(ERROR_TYPE, MESSAGE, F.col("_unreadable")),
        null_or_non_negative(ERROR_TYPE, MESSAGE, "current_limit", "current_spent", "recurring_limit"),
    ]
    valid, errors = split_valid(df, rules, ENTITY, F.col("card_id"), F.col("_raw"), day, run_ts, hold=hold)
    valid = latest_per_key(valid, ["card_id"], ["updated_time desc_nulls_last", *LATEST_FILE, "ingested_at desc_nulls_first"], tie_break=[F.xxhash64("_raw").desc()])
    return valid.drop("_raw", "_unreadable", FILE, FILE_TIME), errors
