"""Record unwrapping and schema-drift projections (B-01..B-06, B-11, B-16,
B-17, B-18, H-02).

The API wraps records as ``{"results": [...]}``; some files carry flat
records, budgets may come as a wrapped ``{"budget": {...}}`` row. All three
shapes become one struct column per record. Explosions run per row inside
the scan stage -- no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from syncforge.functions.columns import has_path
from syncforge.schemas import FILE, FILE_TIME

RECORD = "rec"
#: Columns of a scan that are no part of a record.
LINEAGE = (FILE, FILE_TIME)


def unwrap(
    df: DataFrame,
    envelope: str = "results",
    wrapper: str | None = None,
    alias: str = RECORD,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per record, as struct column ``alias``; ``carry`` names top-level columns that go with each.

    * ``envelope`` array present on a row -> one row per element; a NULL or
      empty array gives no rows (B-01).
    * else ``wrapper`` struct present (e.g. ``budget``) -> that struct (B-02).
    * else the row's own top-level fields form the record.

    The choice is made per row, so one scan may mix the shapes.
    """
    carry = [c for c in carry if c in df.columns]
    cols = [c for c in df.columns if c not in LINEAGE]
    has_env = envelope in cols and isinstance(df.schema[envelope].dataType, ArrayType)
    elem_type = df.schema[envelope].dataType.elementType if has_env else None
    names = set(elem_type.names) if isinstance(elem_type, StructType) else set()
    # Flat record fields are the top-level columns named like record fields.
    flat = [c for c in cols if c not in (envelope, wrapper) and c in names]

    if has_env:
        if flat and isinstance(elem_type, StructType):
            flat_struct = _struct_like(df, flat, elem_type, wrapper)
            any_flat = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in flat])
            arr = (
                F.when(F.col(envelope).isNotNull(), F.col(envelope))
                .when(any_flat | _wrapper_present(df, wrapper), F.array(flat_struct))
                .otherwise(F.lit(None).cast(ArrayType(elem_type)))
            )
        else:
            arr = F.col(envelope)
        return df.select(F.explode(arr).alias(alias), *carry)
    if wrapper and wrapper in cols:
        return df.select(F.col(wrapper).alias(alias), *carry)
    return df.select(F.struct(*[F.col(c) for c in cols]).alias(alias), *carry)


def _wrapper_present(df: DataFrame, wrapper: str | None) -> Column:
    if wrapper and wrapper in df.columns:
        return F.col(wrapper).isNotNull()
    return F.lit(False)


def _struct_like(df: DataFrame, flat: Sequence[str], target: StructType, wrapper: str | None) -> Column:
    """Build a struct of ``target``'s shape from flat columns (or the wrapper)."""
    fields = []
    for f in target.fields:
        options = []
        if wrapper and has_path(df, f"{wrapper}.{f.name}"):
            options.append(F.col(f"{wrapper}.{f.name}").cast(f.dataType))
        if f.name in flat:
            options.append(F.col(f.name).cast(f.dataType))
        val = F.coalesce(*options) if len(options) > 1 else (options[0] if options else F.lit(None).cast(f.dataType))
        fields.append(val.alias(f.name))
    return F.struct(*fields)


def column_or_null(df: DataFrame, name: str, dtype: str | DataType = "string") -> Column:
    """B-03: the column when present, else a typed NULL."""
    if has_path(df, name):
        return F.col(name)
    return F.lit(None).cast(dtype)


def nested_or_flat(df: DataFrame, nested: str, flat: str | None = None, dtype: str | DataType | None = None) -> Column:
    """B-05/B-06: ``coalesce(struct.field, flat)`` over the paths that exist."""
    flat = flat if flat is not None else nested.split(".")[-1]
    options = [F.col(p) for p in (nested, flat) if has_path(df, p)]
    if dtype is not None:
        options = [o.cast(dtype) for o in options]
    if not options:
        return F.lit(None).cast(dtype or "string")
    return options[0] if len(options) == 1 else F.coalesce(*options)


def explode_ids(
    df: DataFrame, keep: Sequence[str], ids: str, alias: str, outer: bool = False, text: str | None = None
) -> DataFrame:
    """B-16/B-17: one row per element of an id list (text list parsed per row).

    ``ids`` may hold an array or its JSON text; an element that is not a
    whole number becomes NULL. ``outer`` keeps one NULL row for an empty or
    NULL list. ``text`` names a column for the element as it was sent.
    """
    dtype = df.schema[ids].dataType
    if isinstance(dtype, ArrayType):
        arr = F.transform(F.col(ids), lambda x: x.cast("string"))
    else:
        arr = F.from_json(F.col(ids).cast("string"), "array<string>")
    fn = F.explode_outer if outer else F.explode
    sent = text or "_sent"
    rows = df.select(*keep, fn(arr).alias(sent)).withColumn(alias, F.col(sent).try_cast("bigint"))
    return rows if text else rows.drop(sent)


def union_drifted(frames: Sequence[DataFrame]) -> DataFrame:
    """H-02: union by name; a column missing in one input is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
