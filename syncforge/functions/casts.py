"""Drift-tolerant scalar casts (I-01..I-06, I-17).

Source data is never cast strictly: under ANSI mode a strict cast aborts the
whole job on one bad row. Every helper here returns NULL for a value that
does not parse, so the row can be quarantined instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from syncforge.functions.columns import as_col


def try_long(c) -> Column:
    return as_col(c).try_cast("bigint")


def try_int(c) -> Column:
    return as_col(c).try_cast("int")


def try_double(c) -> Column:
    """Text or number to double; NaN and +-Infinity count as missing."""
    d = as_col(c).try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None)).otherwise(d)


#: Money, from its text to the tables.
MONEY = "decimal(38,9)"


def try_decimal(c) -> Column:
    """Text or number to money; what is no number, or does not fit, is missing."""
    return as_col(c).try_cast(MONEY)


def money_text(c) -> Column:
    """Canonical text of money: no zeros after the last digit, no bare point (``10``, ``10.5``)."""
    return F.regexp_replace(F.regexp_replace(as_col(c).cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def try_bool(c) -> Column:
    return as_col(c).try_cast("boolean")


def try_timestamp(c, fmt: str | None = None) -> Column:
    """ISO-8601 text (with or without offset) to timestamp; NULL if unparsable."""
    col = as_col(c).cast("string")
    if fmt is None:
        return F.try_to_timestamp(col)
    return F.try_to_timestamp(col, F.lit(fmt))


def unreadable(c, kind: str) -> Column:
    """Whether a value was sent (not NULL or blank) but does not parse as ``kind``."""
    text = as_col(c).cast("string")
    parsed = F.try_to_timestamp(text) if kind == "timestamp" else text.try_cast(kind)
    return F.coalesce(F.trim(text) != "", F.lit(False)) & parsed.isNull()


def try_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.to_date(F.try_to_timestamp(as_col(c).cast("string"), F.lit(fmt)))


def empty_to_null(c) -> Column:
    col = as_col(c)
    return F.when(F.trim(col.cast("string")) == "", F.lit(None)).otherwise(col)
