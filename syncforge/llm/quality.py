"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; its failure is one bit of a long
and the figures it used are kept beside it. A policy is a named, versioned
mask of rules: applying another version, or asking what a rule costs, reads
the narrow ledger and never the texts.

Null, empty and blank texts have no words (all measurements 0) and fail
``few_words``. Rows are judged one by one, so ties, repeated rows and an
empty table need no special case; other columns of the input are ignored.
Windows and lines are found by 64-bit hashes within a document and compared
by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers as B

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "line_chars", "dup_line_chars")
_SYMBOL = B.byte_set(b"#*$%&|<>")
_UPPER = B.byte_set(range(0x41, 0x5B))
_LETTER = B.byte_set([*range(0x41, 0x5B), *range(0x61, 0x7B)])
_HEAD = ~B.byte_set(range(0x80, 0xC0))  # bytes that start a code point
_NOT_BREAK = ~B.byte_set([0x0A])


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a document to reject; ``bit`` is the rule's place in the ledger and never reused."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "2 * n_symbols > n_words"),
    Rule(3, "word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
    Rule(4, "repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(5, "capitals", "2 * n_upper > n_letters"),
    Rule(6, "repeated_line_chars", "100 * dup_line_chars > 30 * line_chars"),
)
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        known = {r.name: r.mask for r in RULES}
        return sum(known[r] for r in set(self.rules))


POLICIES = {
    1: Policy(1, BASE),
    2: Policy(2, (*BASE, "symbols", "word_length", "repeated_lines")),
    3: Policy(3, (*BASE, "symbols", "word_length", "repeated_lines", "capitals")),
    # a short line said twice is no reason to drop a text: lines count by their characters
    4: Policy(4, (*BASE, "symbols", "word_length", "capitals", "repeated_line_chars")),
}
CURRENT = 4


def _per_row(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of a byte-wise array over each row."""
    c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return c[offs[1:]] - c[offs[:-1]]


def _repeats(h: np.ndarray, rows: np.ndarray, equal: Callable[[np.ndarray, np.ndarray], np.ndarray], exact: Callable[[int], object]) -> tuple[np.ndarray, np.ndarray]:
    """For items of rows: whether an equal item is in the same row, and whether an earlier one is.

    Equal hashes are only candidates: ``equal`` compares items pair by pair;
    where it finds a collision, items are told apart by ``exact``.
    """
    order = np.lexsort((h, rows))
    same = (h[order][1:] == h[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    pair = np.flatnonzero(same)
    off = pair[~equal(order[pair], order[pair + 1])]
    later = np.concatenate([[False], same])
    any_, earlier = np.zeros(len(h), bool), np.zeros(len(h), bool)
    any_[order] = later | np.concatenate([same, [False]])
    earlier[order] = later  # lexsort is stable: the first of equal items is the first in the text
    group = np.cumsum(~later) - 1
    for g in np.unique(group[off + 1]).tolist():
        seen: dict[object, int] = {}
        items = np.sort(order[np.searchsorted(group, g) : np.searchsorted(group, g, "right")])
        any_[items] = earlier[items] = False
        for i in items.tolist():
            first = seen.setdefault(exact(i), i)
            if first != i:
                earlier[i] = any_[i] = any_[first] = True
    return any_, earlier


def measure(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of the texts ``data[offs[i]:offs[i + 1]]``."""
    n = len(offs) - 1
    starts, ends, first = B.spans(data, offs, B.VISIBLE)
    out = {"n_words": np.diff(first)}
    for name, v in (
        ("word_chars", B.VISIBLE[data] & _HEAD[data]),
        ("n_symbols", _SYMBOL[data]),
        ("n_upper", _UPPER[data]),
        ("n_letters", _LETTER[data]),
    ):
        out[name] = _per_row(v, offs)
    h, at, rows = B.window_hashes(B.span_hashes(data, starts, ends), first, WINDOW)

    def same_words(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        x, y = (B.ragged(at[k], np.full(len(k), WINDOW)) for k in (i, j))
        return B.equal_spans(data, starts[x], ends[x], data, starts[y], ends[y]).reshape(-1, WINDOW).all(axis=1)

    hit = at[_repeats(h, rows, same_words, lambda i: tuple(data[starts[k] : ends[k]].tobytes() for k in range(at[i], at[i] + WINDOW)))[0]]
    out["n_repeat_words"] = _per_row(B.covered(len(starts), hit, hit + WINDOW), first)
    ls, le, lfirst = B.spans(data, offs, _NOT_BREAK)  # empty lines have no word
    c = np.concatenate([[0], np.cumsum(B.VISIBLE[data], dtype=np.int64)])
    worded = c[le] > c[ls]
    rows = np.repeat(np.arange(n), np.diff(lfirst))[worded]
    ls, le = ls[worded], le[worded]
    _, earlier = _repeats(B.span_hashes(data, ls, le), rows, lambda i, j: B.equal_spans(data, ls[i], le[i], data, ls[j], le[j]), lambda i: data[ls[i] : le[i]].tobytes())
    out["n_lines"] = np.bincount(rows, minlength=n)
    out["n_dup_lines"] = np.bincount(rows[earlier], minlength=n)
    heads = np.concatenate([[0], np.cumsum(_HEAD[data], dtype=np.int64)])
    out["dup_line_chars"] = np.bincount(rows[earlier], (heads[le] - heads[ls])[earlier], minlength=n).astype(np.int64)
    out["line_chars"] = np.bincount(rows, heads[le] - heads[ls], minlength=n).astype(np.int64)
    return out


def _measured(key: str, text: str, kind: pa.DataType):
    schema = pa.schema([(key, kind), *((m, pa.int64()) for m in MEASURES)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.blocks(batches, text):
            got = measure(*B.flat(b.column(text)))
            yield pa.RecordBatch.from_arrays([b.column(key).cast(kind), *(pa.array(got[m], pa.int64()) for m in MEASURES)], schema=schema)

    return run


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(r.mask)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, the measurements, ``fail_bits`` (bit i: rule i failed)."""
    narrow = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    schema = ", ".join([f"`{key}` long", *(f"{m} long" for m in MEASURES)])
    rows = narrow.mapInArrow(_measured(key, text, pa.int64()), schema)
    return rows.withColumn("fail_bits", failure_bits())


def apply_policy(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` (no rule of the policy failed) and ``policy``."""
    mask, base = POLICIES[version].mask, POLICIES[1].mask
    return entries.withColumns(
        {
            "base_failed": F.col("fail_bits").bitwiseAND(F.lit(base)) != 0,
            "kept": F.col("fail_bits").bitwiseAND(F.lit(mask | base)) == 0,
            "policy": F.lit(version),
        }
    )


def ablate(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those kept if it alone were dropped.

    One aggregate over masks (at most 2^rules rows), then one row per rule.
    """
    mask = POLICIES[version].mask
    by_mask = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("bit")) for r in RULES if r.mask & mask))
    each = by_mask.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_only"),
    )


def keep(docs: DataFrame, version: int = CURRENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes the policy, columns unchanged.

    The verdict is computed beside the row (no join, no shuffle), so equal
    keys are judged by their own text.
    """
    kinds = docs.schema
    extra = "__fails"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.blocks(batches, "__text"):
            got = measure(*B.flat(b.column("__text")))
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            names = b.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*cols, *(pa.array(got[m], pa.int64()) for m in MEASURES)], names=[*names, *(f"__{m}" for m in MEASURES)])

    plain = docs.toDF(*(f"c{i}" for i in range(len(kinds))))
    at = docs.columns.index(text)
    schema = ", ".join([*(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kinds)), *(f"__{m} long" for m in MEASURES)])
    rows = plain.withColumn("__text", F.col(f"c{at}").cast("string")).mapInArrow(run, schema)
    renamed = rows.withColumns({m: F.col(f"__{m}") for m in MEASURES}).withColumn(extra, failure_bits())
    mask = POLICIES[version].mask | POLICIES[1].mask
    kept = renamed.where(F.col(extra).bitwiseAND(F.lit(mask)) == 0)
    return kept.select(*(F.col(f"c{i}").alias(f.name) for i, f in enumerate(kinds)))
