"""JSON field access (B-07, B-08, B-09, I-08)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from syncforge.functions.columns import as_col


def parse_json(json_col, schema) -> Column:
    """Parse a JSON text column once into a declared struct (B-07).

    Fields declared as strings receive the JSON text of whatever value is
    there (numbers, arrays and objects included), so drifting types never
    fail the parse; absent fields are NULL.
    """
    return F.from_json(as_col(json_col), schema)


def row_json(*cols) -> Column:
    """Raw capture of a row for the quarantine: NULL fields are omitted."""
    if not cols:
        return F.to_json(F.struct(F.col("*")))
    return F.to_json(F.struct(*[as_col(c) for c in cols]))
