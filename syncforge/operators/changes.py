"""What changed between two versions of a table (J-05..J-07).

Rows are matched on their key by one full outer join and compared null-safe,
column by column. The change log is a function of the two versions, so it can
be derived again after a failure: nothing depends on a write that came between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syncforge.operators.assignments import ASSIGNED, REMOVED

ADDED, CHANGED, DROPPED = "added", "changed", "dropped"
CHANGE = "_change"


def version_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None) -> DataFrame:
    """Keys, ``_change``, and the structs ``before`` and ``after`` (NULL where absent) of rows that differ.

    Keys are unique in each version. ``compare`` names the columns that make
    a change (default: all that are no key).
    """
    keys = list(keys)
    compare = [c for c in after.columns if c not in keys] if compare is None else list(compare)
    old = before.select(*keys, F.struct(*[c for c in before.columns if c not in keys]).alias("before"))
    new = after.select(*keys, F.struct(*[c for c in after.columns if c not in keys]).alias("after"))
    j = old.join(new, keys, "full_outer")
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}"))
    change = F.when(F.col("before").isNull(), ADDED).when(F.col("after").isNull(), DROPPED).when(~same, CHANGED)
    return j.withColumn(CHANGE, change).where(F.col(CHANGE).isNotNull()).select(*keys, CHANGE, "before", "after")


def assignment_changes(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("agent_id", "role_id")) -> DataFrame:
    """J-07: history rows of the pairs whose status changed, with the time the later version gives."""
    d = version_changes(before, after, keys, compare=["status"])
    now, was = F.col("after.status"), F.col("before.status")
    action = F.when(now == ASSIGNED, F.lit(ASSIGNED)).when((now == REMOVED) & (was == ASSIGNED), F.lit(REMOVED))
    return d.select(*keys, action.alias("action"), F.col("after.updated_at").alias("action_time")).where(F.col("action").isNotNull())
