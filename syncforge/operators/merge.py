"""Keyed upsert of a staging batch into a core table (J-01, J-02, J-04,
J-10..J-12, D-14, K-02).

Spark has no ``MERGE INTO`` for plain Parquet tables, so the merge is a
join on the key plus a per-row ``_action``:

* ``insert`` -- key only in staging: staged values.
* ``update`` -- key on both sides and the guard allows it: staged values,
  except ``keep`` columns (core value) and ``greatest`` columns.
* ``stale``  -- key on both sides, guard refuses (older or NULL timestamp):
  core values, the row is not counted as changed.
* ``keep``   -- key only in core: core values.

The result is the whole next version of the core table.

It is one ``full_outer`` join: each side is read once, and keys are unique on
both sides (core by construction, staging after ``latest_per_key``), so no
key is hot. Nothing is probed or hinted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syncforge.operators.dedup import latest_per_key

INSERT, UPDATE, STALE, KEEP = "insert", "update", "stale", "keep"
ACTION = "_action"
_IN_C, _IN_S = "_in_core", "_in_stg"


_STG = "_stg"


def _s(c: str) -> str:
    return f"{_STG}.{c}"


def conform(df: DataFrame, like: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` onto ``like``'s columns and types; missing ones are NULL."""
    out = []
    for f in like.schema.fields:
        if f.name in df.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def _guard_allows(guard: str | None, null_guard: str) -> Column:
    if guard is None:
        return F.lit(True)
    newer = F.coalesce(F.col(_s(guard)) >= F.col(guard), F.lit(False))
    if null_guard == "reject":
        return newer
    if null_guard == "accept_if_stored_null":
        return F.col(guard).isNull() | newer
    raise ValueError(f"unknown null_guard {null_guard!r}")


def merge_latest(
    core: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    guard: str | None = None,
    null_guard: str = "reject",
    keep: Sequence[str] = (),
    greatest: Sequence[str] = (),
    staging_order: Sequence | None = None,
) -> DataFrame:
    """Merge ``staging`` into ``core`` on ``keys``; returns core's columns + ``_action``.

    ``guard`` names a timestamp column: an existing row is overwritten only
    when the staged value is ``>=`` the stored one. ``null_guard`` decides the
    NULL cases: ``reject`` (either side NULL keeps the stored row) or
    ``accept_if_stored_null`` (a NULL stored value accepts any staged row).
    ``staging_order`` dedups staging first (latest row per key).
    """
    keys = list(keys)
    staging = conform(staging, core)
    if staging_order is not None:
        staging = latest_per_key(staging, keys, staging_order)
    nonkeys = [c for c in core.columns if c not in keys]

    # Staged values travel as one struct column: a single alias instead of
    # one per column keeps Catalyst's constraint propagation linear.
    s = staging.select(*keys, F.struct(*[F.col(c) for c in nonkeys]).alias(_STG), F.lit(True).alias(_IN_S))
    c = core.select(*keys, *nonkeys, F.lit(True).alias(_IN_C))

    # both sides have unique keys: each is read once, and no key is hot
    joined = c.join(s, keys, "full_outer")

    action = (
        F.when(F.col(_IN_C).isNull(), F.lit(INSERT))
        .when(F.col(_IN_S).isNull(), F.lit(KEEP))
        .when(_guard_allows(guard, null_guard), F.lit(UPDATE))
        .otherwise(F.lit(STALE))
    )
    joined = joined.withColumn(ACTION, action)
    a = F.col(ACTION)
    take_staged = a.isin(INSERT, UPDATE)
    out = [F.col(k) for k in keys]
    for col in nonkeys:
        sv, cv = F.col(_s(col)), F.col(col)
        if col in keep:
            expr = F.when(a == INSERT, sv).otherwise(cv)
        elif col in greatest:
            expr = F.when(a == INSERT, sv).when(a == UPDATE, F.greatest(cv, sv)).otherwise(cv)
        else:
            expr = F.when(take_staged, sv).otherwise(cv)
        out.append(expr.alias(col))
    out.append(a)
    return joined.select(*out)


def current_rows(merged: DataFrame) -> DataFrame:
    """The next core version without the bookkeeping column."""
    return merged.drop(ACTION)
