"""Per-day status snapshot keyed by (entity key, date) (J-03).

The upsert is a partition overwrite: a snapshot holds one date for every
entity, so it replaces that date's folder and nothing else. The date is a parameter (the sync date), so a status flip without
a new ``updated_at`` is recorded on the day it is seen; the reference's
``date(updated_at)`` keying is available as ``date_from``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.operators.merge import ACTION, INSERT, KEEP, UPDATE


def status_snapshot(
    entities: DataFrame,
    sync_date=None,
    key: str = "agent_id",
    status_col: str = "status",
    date_from: str | None = None,
    fallback_date=None,
) -> DataFrame:
    """(key, sync_date, is_active) for every entity row."""
    if date_from is not None:
        day = F.coalesce(F.to_date(F.col(date_from)), F.lit(fallback_date).cast("date"))
    else:
        day = F.lit(sync_date).cast("date")
    return entities.select(
        F.col(key),
        day.alias("sync_date"),
        F.coalesce(F.col(status_col) == F.lit("active"), F.lit(False)).alias("is_active"),
    )


def upsert_snapshot(history: DataFrame, snap: DataFrame, key: str = "agent_id") -> DataFrame:
    """ON CONFLICT (key, sync_date) DO UPDATE is_active; returns history + ``_action``.

    Every row of the snapshot stays one row, also where its key is NULL or comes twice.
    """

    def pairs(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).alias("_key"), F.col("sync_date").alias("_date")).distinct()

    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("sync_date").eqNullSafe(F.col("_date"))
    kept = history.join(pairs(snap), same, "left_anti").withColumn(ACTION, F.lit(KEEP))
    known = pairs(history).withColumn("_known", F.lit(True))
    action = F.when(F.col("_known"), F.lit(UPDATE)).otherwise(F.lit(INSERT))
    new = snap.join(known, same, "left").withColumn(ACTION, action).select(*snap.columns, ACTION)
    return kept.unionByName(new)
