"""Key derivation (B-15) and deterministic row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from syncforge.functions.columns import as_col

KEY_SEPARATOR = "||"


def idempotency_key(*cols, sep: str = KEY_SEPARATOR) -> Column:
    """SHA-256 hex over the text of ``cols`` joined by ``sep``.

    Like ``concat_ws`` it skips NULL parts, so (a, NULL) and (NULL, a)
    collide; callers derive the key only for rows that passed validation.
    """
    return F.sha2(F.concat_ws(sep, *[as_col(c).cast("string") for c in cols]), 256)


def row_fingerprint(*cols) -> Column:
    """64-bit content hash used as the last tie-break in dedup."""
    return F.xxhash64(*[as_col(c) for c in cols])


def bucket_of(n_buckets: int, *keys) -> Column:
    """Stable bucket id for a key, used to lay out and rewrite core tables."""
    return F.pmod(F.xxhash64(*[as_col(k) for k in keys]), F.lit(n_buckets)).cast("int")
