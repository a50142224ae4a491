"""Roles: flat or nested (``role.*``) records -> validated, deduplicated
roles (B-05, B-06, C-02, H-02, F-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.functions import row_json, try_bool, try_long, try_timestamp
from syncforge.operators.dedup import latest_per_key
from syncforge.operators.envelope import nested_or_flat, unwrap
from syncforge.operators.validate import required, split_valid
from syncforge.schemas import ROLES_DDL

ENTITY = "roles"
# Quarantine type and message.
ERROR_TYPE = "MISSING_REQUIRED_FIELD"
MESSAGE = "Role id or name is null"

TARGET_COLUMNS = [c.split()[0] for c in ROLES_DDL.split(", ")]


def normalize(raw: DataFrame) -> DataFrame:
    d = unwrap(raw, "results").select("rec.*")
    return d.select(
        try_long("id").alias("role_id"),
        nested_or_flat(d, "role.name", "name").alias("name"),
        nested_or_flat(d, "role.description", "description").alias("description"),
        try_bool(nested_or_flat(d, "role.default", "default")).alias("is_default"),
        nested_or_flat(d, "role.agent_type", "agent_type").cast("string").alias("agent_type"),
        try_timestamp(nested_or_flat(d, "role.created_at", "created_at")).alias("created_at"),
        try_timestamp(nested_or_flat(d, "role.updated_at", "updated_at")).alias("updated_at"),
        row_json(*[F.col(c) for c in d.columns]).alias("_raw"),
    )


def transform(
    raw: DataFrame, day: str | None = None, run_ts=None, hold: list | None = None
) -> tuple[DataFrame, DataFrame]:
    df = normalize(raw)
    rule = required(ERROR_TYPE, MESSAGE, "role_id", "name")
    valid, errors = split_valid(df, [rule], ENTITY, F.col("role_id"), F.col("_raw"), day, run_ts, hold=hold)
    valid = latest_per_key(valid, ["role_id"], ["updated_at desc_nulls_last"], tie_break=[F.xxhash64("_raw").desc()])
    return valid.select(*TARGET_COLUMNS), errors
