"""Rule tables, first-failure tagging and the quarantine split
(C-01..C-10, E-06).

A rule is (error_type, message, failing predicate). Rules are evaluated in
order and the first failure names the error, exactly like a chained CASE.
The split is one pass: the tagged frame is filtered twice, so callers that
write both sides should persist the tagged frame once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncforge.functions.columns import as_col

ERROR = "_error"

QUARANTINE_COLUMNS = (
    "entity",
    "record_key",
    "error_type",
    "error_message",
    "raw_record",
    "sync_day",
    "created_at",
)


@dataclass(frozen=True)
class Rule:
    error_type: str
    message: str
    fails: Column


def required(error_type: str, message: str, *cols) -> Rule:
    cond = None
    for c in cols:
        x = as_col(c).isNull()
        cond = x if cond is None else cond | x
    return Rule(error_type, message, cond)


def null_or_non_negative(error_type: str, message: str, *cols) -> Rule:
    cond = None
    for c in cols:
        x = F.coalesce(as_col(c) < 0, F.lit(False))
        cond = x if cond is None else cond | x
    return Rule(error_type, message, cond)


def first_failure(rules: Sequence[Rule]) -> Column:
    """struct<error_type, error_message> of the first failing rule, else NULL."""
    expr = None
    for r in rules:
        val = F.struct(F.lit(r.error_type).alias("error_type"), F.lit(r.message).alias("error_message"))
        cond = F.coalesce(r.fails, F.lit(False))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def tag_errors(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(ERROR, first_failure(rules))


def quarantine_record(
    entity: str,
    key: Column,
    raw: Column,
    sync_day: str | None,
    created_at,
    error_type: Column | None = None,
    error_message: Column | None = None,
) -> list[Column]:
    return [
        F.lit(entity).alias("entity"),
        key.cast("string").alias("record_key"),
        (error_type if error_type is not None else F.col(f"{ERROR}.error_type")).alias("error_type"),
        (error_message if error_message is not None else F.col(f"{ERROR}.error_message")).alias("error_message"),
        raw.cast("string").alias("raw_record"),
        F.lit(sync_day).cast("string").alias("sync_day"),
        F.lit(created_at).cast("timestamp").alias("created_at"),
    ]


def split_valid(
    df: DataFrame,
    rules: Sequence[Rule],
    entity: str,
    key,
    raw,
    sync_day: str | None = None,
    created_at=None,
    hold: list | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the tag, quarantine rows in the shared shape).

    Both sides read the same tagged frame. When the caller writes both, it
    passes ``hold`` (a list): the tagged frame is then persisted at the fork
    so the normalization runs once, and appended to ``hold`` for the caller
    to unpersist after the writes.
    """
    tagged = tag_errors(df, rules)
    if hold is not None:
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        hold.append(tagged)
    valid = tagged.filter(F.col(ERROR).isNull()).drop(ERROR)
    errors = tagged.filter(F.col(ERROR).isNotNull()).select(
        *quarantine_record(entity, as_col(key), as_col(raw), sync_day, created_at)
    )
    return valid, errors


def to_quarantine(
    df: DataFrame,
    entity: str,
    key,
    raw,
    error_type: str,
    message: str,
    sync_day: str | None = None,
    created_at=None,
) -> DataFrame:
    """Shape rows already known to be bad (e.g. unknown references)."""
    return df.select(
        *quarantine_record(
            entity, as_col(key), as_col(raw), sync_day, created_at, F.lit(error_type), F.lit(message)
        )
    )
