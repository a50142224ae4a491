"""Budgets: envelope / wrapped / flat records -> validated, deduplicated
budgets (B-01, B-02, B-10, C-03, F-01, F-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.functions import MONEY, try_bool, try_date, try_decimal
from syncforge.operators.dedup import latest_per_key
from syncforge.operators.envelope import RECORD, unwrap
from syncforge.operators.validate import required, split_valid
from syncforge.schemas import FILE, FILE_TIME
from syncforge.sources.lineage import LATEST_FILE, day_of, lineage

ENTITY = "budgets"
SOURCE = "api"
# Quarantine type and message.
ERROR_TYPE = "VALIDATION_ERROR"
MESSAGE = "budget_id or limit_amount is null"


def normalize(raw: DataFrame, day: str | None, run_ts) -> DataFrame:
    r = unwrap(raw, "results", wrapper="budget", carry=(FILE, FILE_TIME))
    b = lambda p: F.col(f"{RECORD}.{p}")
    return r.select(
        b("id").alias("budget_id"),
        b("uuid").alias("budget_uuid"),
        b("name").alias("name"),
        b("description").alias("description"),
        try_bool(b("retired")).alias("retired"),
        try_date(b("startDate"), "yyyy-MM-dd").alias("start_date"),
        b("recurringInterval").alias("recurring_interval"),
        b("timezone").alias("timezone"),
        try_decimal(b("currentPeriod.limit")).alias("limit_amount"),
        try_decimal(b("currentPeriod.overspendBuffer")).alias("overspend_buffer"),
        try_decimal(b("currentPeriod.assigned")).alias("assigned_amount"),
        try_decimal(b("currentPeriod.spent.cleared")).alias("spent_cleared"),
        try_decimal(b("currentPeriod.spent.pending")).alias("spent_pending"),
        try_decimal(b("currentPeriod.spent.total")).alias("spent_total"),
        day_of(r, day).alias("sync_day"),
        F.lit(SOURCE).alias("source"),
        F.lit(run_ts).cast("timestamp").alias("ingested_at"),
        *lineage(r),
        F.to_json(F.col(RECORD)).alias("_raw"),
    )


def transform(
    raw: DataFrame, day: str | None = None, run_ts=None, hold: list | None = None
) -> tuple[DataFrame, DataFrame]:
    df = normalize(raw, day, run_ts)
    rule = required(ERROR_TYPE, MESSAGE, "budget_id", "limit_amount")
    valid, errors = split_valid(df, [rule], ENTITY, F.col("budget_id"), F.col("_raw"), day, run_ts, hold=hold)
    valid = latest_per_key(valid, ["budget_id"], [*LATEST_FILE, "ingested_at desc_nulls_last"], tie_break=[F.xxhash64("_raw").desc()])
    return valid.drop("_raw", FILE, FILE_TIME), errors


def to_core(valid: DataFrame, run_ts) -> DataFrame:
    """J-10 insert values: limit NULL -> 0, created/updated stamped with the run time."""
    ts = F.lit(run_ts).cast("timestamp")
    return valid.withColumns(
        {
            "limit_amount": F.coalesce(F.col("limit_amount"), F.lit(0).cast(MONEY)),
            "created_at": ts,
            "updated_at": ts,
        }
    ).drop("ingested_at")
