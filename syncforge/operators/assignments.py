"""Many-to-many assignments with soft delete and history (J-05..J-07, C-13).

The staged snapshot is the full set of current pairs. One ``full_outer``
join on the composite key classifies every pair:

* ``insert``   -- new pair: assigned now.
* ``update``   -- still assigned: assigned_at kept, removed_at cleared.
* ``reassign`` -- was removed, is back: assigned, assigned_at kept.
* ``remove``   -- stored as assigned, missing from the snapshot: removed now.
* ``keep``     -- stored as removed and still missing: untouched.

History rows are derived from the same frame: ``assigned`` for insert and
reassign, ``removed`` for remove.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.operators.merge import ACTION

ASSIGNED, REMOVED = "assigned", "removed"
INSERT, UPDATE, REASSIGN, REMOVE, KEEP = "insert", "update", "reassign", "remove", "keep"
_IN_C, _IN_S, _UNREAD = "_in_core", "_in_stg", "_unread"

MAPPING_COLUMNS = ("status", "assigned_at", "removed_at", "updated_at")


def empty_mapping(spark, keys: Sequence[str] = ("agent_id", "role_id")) -> DataFrame:
    ddl = ", ".join([f"{k} bigint" for k in keys]) + (
        ", status string, assigned_at timestamp, removed_at timestamp, updated_at timestamp"
    )
    return spark.createDataFrame([], ddl)


def merge_assignments(
    current: DataFrame,
    staged: DataFrame,
    run_ts,
    keys: Sequence[str] = ("agent_id", "role_id"),
    untouched: DataFrame | None = None,
) -> DataFrame:
    """Next mapping table + ``_action``; ``staged`` holds the snapshot's pairs.

    ``untouched`` holds owners (values of the first key) whose list could not
    be read that day: their stored pairs stay as they are.
    """
    keys = list(keys)
    ts = F.lit(run_ts).cast("timestamp")
    s = staged.select(*keys).dropna(subset=keys).distinct().withColumn(_IN_S, F.lit(True))
    c = current.select(*keys, *MAPPING_COLUMNS).withColumn(_IN_C, F.lit(True))
    j = c.join(s, keys, "full_outer")
    unread = F.lit(False)
    if untouched is not None:
        ids = untouched.select(keys[0]).dropna().distinct().withColumn(_UNREAD, F.lit(True))
        j = j.join(ids, keys[0], "left")
        unread = F.col(_UNREAD).isNotNull()
    in_c, in_s, st = F.col(_IN_C).isNotNull(), F.col(_IN_S).isNotNull(), F.col("status")
    action = (
        F.when(~in_c, F.lit(INSERT))
        .when(~in_s & unread, F.lit(KEEP))
        .when(~in_s & F.coalesce(st != F.lit(REMOVED), F.lit(False)), F.lit(REMOVE))
        .when(~in_s, F.lit(KEEP))
        .when(F.coalesce(st == F.lit(REMOVED), F.lit(False)), F.lit(REASSIGN))
        .otherwise(F.lit(UPDATE))
    )
    j = j.withColumn(ACTION, action)
    a = F.col(ACTION)
    present = a.isin(INSERT, UPDATE, REASSIGN)
    return j.select(
        *keys,
        F.when(present, F.lit(ASSIGNED)).when(a == REMOVE, F.lit(REMOVED)).otherwise(st).alias("status"),
        F.when(a == INSERT, ts)
        .when(present, F.coalesce(F.col("assigned_at"), ts))
        .otherwise(F.col("assigned_at"))
        .alias("assigned_at"),
        F.when(present, F.lit(None).cast("timestamp"))
        .when(a == REMOVE, ts)
        .otherwise(F.col("removed_at"))
        .alias("removed_at"),
        F.when(a == KEEP, F.col("updated_at")).otherwise(ts).alias("updated_at"),
        a,
    )


def assignment_history(merged: DataFrame, run_ts, keys: Sequence[str] = ("agent_id", "role_id")) -> DataFrame:
    """J-07: rows to append to the history log."""
    a = F.col(ACTION)
    return merged.filter(a.isin(INSERT, REASSIGN, REMOVE)).select(
        *keys,
        F.when(a == REMOVE, F.lit(REMOVED)).otherwise(F.lit(ASSIGNED)).alias("action"),
        F.lit(run_ts).cast("timestamp").alias("action_time"),
    )


def assignment_counts(merged: DataFrame) -> DataFrame:
    a = F.col(ACTION)
    return merged.agg(
        F.count_if(a == INSERT).cast("bigint").alias("rows_inserted"),
        F.count_if(a.isin(UPDATE, REASSIGN)).cast("bigint").alias("rows_updated"),
        F.count_if(a == REMOVE).cast("bigint").alias("rows_deleted"),
    ).withColumn("rows_affected", F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_deleted"))
