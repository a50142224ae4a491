"""Run bookkeeping: action counts and the per-merge metrics row
(E-03, E-04, E-06, J-14, D-13).

All counts of one merge ride on its write as one observation
(``observed_counts``); ``merge_counts`` takes them from a frame by a single
aggregate. Neither reads anything back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from syncforge.operators.assignments import REASSIGN, REMOVE
from syncforge.operators.merge import ACTION, INSERT, KEEP, STALE, UPDATE
from syncforge.schemas import PIPELINE_METRICS_DDL

#: Counts of one step, in the order of the metrics record.
COUNTS = ("rows_inserted", "rows_updated", "rows_deleted", "rows_stale", "rows_kept", "rows_reassigned", "rows_recomputed")


def _count(action: str):
    return F.count_if(F.col(ACTION) == F.lit(action)).cast("bigint")


def merge_counts(merged: DataFrame, deleted_action: str | None = None) -> DataFrame:
    """One row: rows_inserted, rows_updated, rows_deleted, rows_stale, rows_kept, rows_affected."""
    deleted = _count(deleted_action) if deleted_action else F.lit(0).cast("bigint")
    agg = merged.agg(
        _count(INSERT).alias("rows_inserted"),
        _count(UPDATE).alias("rows_updated"),
        deleted.alias("rows_deleted"),
        _count(STALE).alias("rows_stale"),
        _count(KEEP).alias("rows_kept"),
    )
    return agg.withColumn(
        "rows_affected", F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_deleted")
    )


def action_counts() -> list[Column]:
    """The counts of a merge, an assignment merge or a replacement, by ``_action``."""
    named = {"rows_inserted": INSERT, "rows_updated": UPDATE, "rows_deleted": REMOVE, "rows_stale": STALE, "rows_kept": KEEP, "rows_reassigned": REASSIGN}
    return [_count(a).alias(c) for c, a in named.items()]


def observed_counts(merged: DataFrame, *more: Column) -> tuple[DataFrame, Observation]:
    """``merged`` with its action counts (and ``more`` aggregates) as an observation of the write it goes to."""
    seen = Observation()
    return merged.observe(seen, *action_counts(), *more), seen


def report_of(counts: dict) -> dict:
    """All counts of a step; affected rows are those inserted, updated, deleted or assigned again."""
    out = {c: int(counts.get(c) or 0) for c in COUNTS}
    out["rows_affected"] = out["rows_inserted"] + out["rows_updated"] + out["rows_deleted"] + out["rows_reassigned"]
    return out


def run_metrics_row(
    spark: SparkSession,
    counts: dict,
    pipeline_name: str,
    table_name: str,
    day: str | None,
    started_at: dt.datetime,
    finished_at: dt.datetime,
    run_id: str | None = None,
    status: str = "success",
    error_message: str | None = None,
) -> DataFrame:
    """J-14: the metrics record of one merge; ``counts`` as ``report_of`` gives them."""
    row = {
        "flow_run_id": run_id,
        "task_name": f"{pipeline_name}_task",
        "pipeline_name": pipeline_name,
        "table_name": table_name,
        "day": day,
        **counts,
        "status": status,
        "error_message": error_message,
        "started_at": started_at.replace(tzinfo=dt.timezone.utc),
        "finished_at": finished_at.replace(tzinfo=dt.timezone.utc),
        "duration_seconds": (finished_at - started_at).total_seconds(),
    }
    names = [c.split()[0] for c in PIPELINE_METRICS_DDL.split(", ")]
    return spark.createDataFrame([tuple(row[c] for c in names)], PIPELINE_METRICS_DDL)
