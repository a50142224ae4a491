"""Natural-key uniqueness (J-15).

Duplicates are found with a grouped count -- partial aggregation per task,
so a key holding a third of the rows costs one partial row per task -- and
split off with a semi/anti join against the (small) duplicated-key set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)


def split_unique(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is unique, rows whose key repeats)."""
    dups = duplicate_keys(df, keys).select(*keys)
    return df.join(dups, list(keys), "left_anti"), df.join(dups, list(keys), "left_semi")
