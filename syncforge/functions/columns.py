"""Small column utilities shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_path(df: DataFrame, path: str) -> bool:
    """True when ``a.b.c`` exists in the schema (struct fields only)."""
    from pyspark.sql.types import StructType

    dtype = df.schema
    for part in path.split("."):
        if not isinstance(dtype, StructType) or part not in dtype.names:
            return False
        dtype = dtype[part].dataType
    return True
