"""Reference checks between entities (D-01..D-05, D-07, D-08, D-10, E-01).

Existence tests are semi/anti joins: Catalyst plans them as hash joins that
emit each probe row at most once, so a reference side with duplicate keys
cannot multiply rows. Reference sides are reduced to distinct keys first.
No join is hinted: AQE picks the join from the sizes it has measured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FOUND = "_found"


def _keys(ref: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-NULL keys."""
    k = ref.select(*keys)
    for c in keys:
        k = k.filter(F.col(c).isNotNull())
    return k.distinct()


def flag_active(
    df: DataFrame,
    active: DataFrame,
    key: str,
    status_col: str = "status",
) -> DataFrame:
    """D-01: ``status`` = 'active' when the key is in the active list, else 'inactive'."""
    a = _keys(active, [key]).withColumn(_FOUND, F.lit(True))
    return (
        df.join(a, key, "left")
        .withColumn(
            status_col,
            F.when(F.col(_FOUND), F.lit("active")).otherwise(F.lit("inactive")),
        )
        .drop(_FOUND)
    )


def split_known(
    df: DataFrame,
    ref: DataFrame,
    keys: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """D-02/D-03: (rows whose key exists in ``ref``, rows whose key does not).

    Rows with a NULL key are in neither side (nothing to check).
    """
    keys = list(keys)
    k = _keys(ref, keys)
    notnull = df
    for c in keys:
        notnull = notnull.filter(F.col(c).isNotNull())
    return notnull.join(k, keys, "left_semi"), notnull.join(k, keys, "left_anti")


def flag_known(df: DataFrame, ref: DataFrame, keys: Sequence[str], flag: str = "is_known") -> DataFrame:
    """D-04: one pass, every row kept with a boolean ``flag``."""
    keys = list(keys)
    k = _keys(ref, keys).withColumn(_FOUND, F.lit(True))
    return df.join(k, keys, "left").withColumn(flag, F.coalesce(F.col(_FOUND), F.lit(False))).drop(_FOUND)


def deactivate_absent(
    merged: DataFrame,
    status_col: str = "status",
    action_col: str = "_action",
    present: DataFrame | None = None,
    key: str = "agent_id",
) -> DataFrame:
    """D-01 option: rows the day's snapshot did not mention (merge action
    ``keep``) become 'inactive' -- "present on day N, missing on day N+1".

    ``present`` holds the ids of the whole snapshot: a row whose record was
    quarantined that day is present, so it keeps its status.
    """
    absent = F.col(action_col) == F.lit("keep")
    if present is not None:
        merged = merged.join(_keys(present, [key]).withColumn(_FOUND, F.lit(True)), key, "left")
        absent = absent & F.col(_FOUND).isNull()
    out = merged.withColumn(status_col, F.when(absent, F.lit("inactive")).otherwise(F.col(status_col)))
    return out.drop(_FOUND)
