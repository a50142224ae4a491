"""Watermark state and delta selection (J-13, K-01, E-05, I-15).

State is a small table ``(pipeline_name, last_processed_time)``, one row
per pipeline. Advancing it takes ``greatest(stored, max(batch))`` -- the
mark never moves back, and a batch without timestamps leaves it as is.
Selecting a delta keeps rows at or after the mark plus rows without a
timestamp (they cannot be placed, the guarded merge sorts them out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE_COLUMNS = ("pipeline_name", "last_processed_time")


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], "pipeline_name string, last_processed_time timestamp")


def batch_mark(batch: DataFrame, name: str, col: str) -> DataFrame:
    """One row: the batch's max timestamp (global aggregate, partial per task)."""
    return batch.agg(F.max(F.col(col)).cast("timestamp").alias("last_processed_time")).select(
        F.lit(name).alias("pipeline_name"), "last_processed_time"
    )


def advance_watermark(state: DataFrame, batch: DataFrame, name: str, col: str) -> DataFrame:
    """Next state table: this pipeline's mark moved forward, others untouched."""
    mark = batch_mark(batch, name, col).withColumnRenamed("last_processed_time", "_new")
    mine = state.filter(F.col("pipeline_name") == F.lit(name))
    others = state.filter(~(F.col("pipeline_name") == F.lit(name)))
    merged = mine.join(mark, "pipeline_name", "full_outer").select(
        "pipeline_name",
        F.greatest(F.col("last_processed_time"), F.col("_new")).alias("last_processed_time"),
    )
    return others.unionByName(merged)


def current_mark(state: DataFrame, name: str):
    """The pipeline's mark as a value (one row of the small state table), or None."""
    return state.filter(F.col("pipeline_name") == F.lit(name)).agg(F.max("last_processed_time")).first()[0]


def since_watermark(df: DataFrame, state: DataFrame, name: str, col: str) -> DataFrame:
    """K-01: rows with ``col >= mark`` or ``col`` NULL; all rows when no mark exists.

    The mark is read as one value and applied as a literal predicate, so it
    reaches the scan as a pushed filter (row groups before the mark are
    skipped) instead of a join.
    """
    mark = current_mark(state, name)
    if mark is None:
        return df
    return df.filter(F.col(col).isNull() | (F.col(col) >= F.lit(mark).cast("timestamp")))
