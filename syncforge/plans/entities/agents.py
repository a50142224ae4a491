"""Agents: details archive + day's active list -> validated, deduplicated
agents with a derived status (A-07, B-03..B-06, C-01, D-01, F-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.functions import row_json, try_bool, try_long, try_timestamp
from syncforge.operators.dedup import latest_per_key
from syncforge.operators.envelope import nested_or_flat, unwrap
from syncforge.operators.refer import flag_active
from syncforge.operators.validate import required, split_valid, to_quarantine
from syncforge.schemas import AGENTS_DDL, CORRUPT

ENTITY = "agents"
# Quarantine type and message.
ERROR_TYPE = "MISSING_REQUIRED_FIELD"
MESSAGE = "agent_id, email, and name are required"

UNREAD_LIST = ("UNREADABLE_ACTIVE_LIST", "active agents list could not be read")

CONTACT_FIELDS = ("email", "name", "job_title", "language", "mobile", "phone", "time_zone")
TARGET_COLUMNS = [c.split()[0] for c in AGENTS_DDL.split(", ")]


def normalize(details: DataFrame) -> DataFrame:
    d = unwrap(details, "results").select("rec.*")
    cols = [try_long("id").alias("agent_id")]
    cols += [nested_or_flat(d, f"contact.{f}", f).alias(f) for f in CONTACT_FIELDS]
    cols += [
        try_timestamp(nested_or_flat(d, "contact.last_login_at", "last_login_at")).alias("last_login_at"),
        try_bool(F.col("available")).alias("available"),
        try_timestamp("available_since").alias("available_since"),
        try_bool(F.col("deactivated")).alias("deactivated"),
        F.col("focus_mode"),
        F.col("agent_operational_status"),
        try_timestamp("last_active_at").alias("last_active_at"),
        F.col("org_agent_id"),
        F.col("ticket_scope"),
        F.col("signature"),
        F.col("freshchat_agent"),
        try_timestamp("created_at").alias("created_at"),
        try_timestamp("updated_at").alias("updated_at"),
        row_json(*[F.col(c) for c in d.columns]).alias("_raw"),
    ]
    return d.select(*cols)


def transform(
    details: DataFrame,
    active: DataFrame,
    day: str | None = None,
    run_ts=None,
    hold: list | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(agents with status, quarantine rows)."""
    df = normalize(details)
    rule = required(ERROR_TYPE, MESSAGE, "agent_id", "email", "name")
    valid, errors = split_valid(df, [rule], ENTITY, F.col("agent_id"), F.col("_raw"), day, run_ts, hold=hold)
    valid = latest_per_key(valid, ["agent_id"], ["updated_at desc_nulls_last"], tie_break=[F.xxhash64("_raw").desc()])
    act = unwrap(active, "results").select(try_long("rec.id").alias("agent_id"))
    valid = flag_active(valid, act, "agent_id")
    return valid.select(*TARGET_COLUMNS), errors


def unread_lists(active: DataFrame, day: str | None = None, run_ts=None) -> DataFrame:
    """A-07: quarantine rows of the parts of the active list that could not be read."""
    rec = unwrap(active, "results").select("rec.*")
    if CORRUPT not in rec.columns:
        rec = rec.withColumn(CORRUPT, F.lit(None).cast("string"))
    return to_quarantine(rec.where(F.col(CORRUPT).isNotNull()), ENTITY, F.lit(None), F.col(CORRUPT), *UNREAD_LIST, day, run_ts)


def keep_status(valid: DataFrame, stored: DataFrame) -> DataFrame:
    """Agents that the list does not name keep the status they have."""
    known = stored.select("agent_id", F.col("status").alias("_stored"))
    status = F.when(F.col("status") == "inactive", F.coalesce("_stored", "status")).otherwise(F.col("status"))
    return valid.join(known, "agent_id", "left").withColumn("status", status).drop("_stored")
