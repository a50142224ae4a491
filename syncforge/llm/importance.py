"""Quality classifier by importance resampling.

A target model (documents labelled good) and a raw model (all documents) are
bags of hashed word and word-pair counts with ``FEATURES`` places. A
document's log-weight is the sum over its features of the log ratio of the
two models; Gumbel noise is added and the rows with the ``k`` greatest sums
are the sample. The raw model counts every document; the target model is
fitted on at most ``TARGET_ROWS`` labelled rows (a documented bound; the
least hashes of their keys).

Noise depends on key and seed only, so a rerun draws the same sample. Ties
go to the least key, then text hash. Null and empty texts have no features
and weight 0. Without good labels the target is the raw model, so all
weights are 0. Repeated rows draw together; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers as B
from .staging import settled

FEATURES = 10_000
TARGET_ROWS = 50_000
SEED = 20_24
#: Added to each count of a model.
SMOOTH = 0.5


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of each word and pair of neighbours, and the row of each."""
    data = B.FOLD[data]
    starts, ends, first = B.spans(data, offs, B.VISIBLE)
    words = B.span_hashes(data, starts, ends, seed=5)
    pairs, _, rows = B.window_hashes(words, first, 2)
    own = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    return (np.concatenate([words, pairs]) % np.uint64(FEATURES)).astype(np.int64), np.concatenate([own, rows])


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task: one row with the counts of all rows, one of the good rows."""
    total = np.zeros((2, FEATURES), np.int64)
    for b in B.blocks(batches, "text"):
        f, rows = features(*B.flat(b.column("text")))
        total[0] += np.bincount(f, minlength=FEATURES)
        good = np.asarray(b.column("good").cast(pa.int8())) == 1
        total[1] += np.bincount(f[good[rows]], minlength=FEATURES)
    place = np.tile(np.arange(FEATURES), 2)
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], FEATURES), pa.int32()), pa.array(place, pa.int32()), pa.array(total.reshape(-1))], names=["model", "place", "n"])


def _weights(ratio: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.blocks(batches, "text"):
            f, rows = features(*B.flat(b.column("text")))
            n = np.bincount(rows, minlength=b.num_rows)
            total = np.bincount(rows, weights=ratio[f], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("row"), pa.array(n, pa.int64()), pa.array(total, pa.float64())], names=["key", "row", "n_features", "log_weight"])

    return run


def gumbel(key: Column, seed: int) -> Column:
    """Gumbel noise fixed by key and seed."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def good_label() -> Column:
    return (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)


def good_keys(labels: DataFrame, key: str, good: Column, bound: int) -> DataFrame:
    """Keys of good rows, at most ``bound`` of them: those of least hash."""
    k = F.col(key).cast("long")
    rows = labels.where(good & k.isNotNull()).select(k.alias("key")).distinct()
    return rows.orderBy(F.xxhash64("key"), "key").limit(bound)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", good: Column | None = None, bound: int = TARGET_ROWS) -> np.ndarray:
    """Log ratio of target to raw model for every feature."""
    good = good_label() if good is None else good
    target = good_keys(labels, key, good, bound).withColumn("good", F.lit(True))  # at most ``bound`` longs
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    marked = rows.join(F.broadcast(target), "key", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    sums = marked.mapInArrow(_counts, "model int, place int, n long").groupBy("model", "place").agg(F.sum("n").alias("n"))
    n = np.zeros((2, FEATURES))
    for r in sums.collect():  # 2 * FEATURES rows
        n[r["model"], r["place"]] = r["n"]
    raw, own = n[0] + SMOOTH, n[1] + SMOOTH
    return np.log(own / own.sum()) - np.log(raw / raw.sum()) if n[1].any() else np.zeros(FEATURES)


def label_share(labels: DataFrame, good: Column | None = None) -> float:
    """Share of labelled rows that are good, as the target model means it (1 without a good one)."""
    good = good_label() if good is None else good
    a, b = labels.agg(F.count_if(good), F.count("*")).first()
    return a / b if a else 1.0


def _kth(rows: DataFrame, k: int) -> tuple[int, int]:
    """The k-th greatest ``rank`` (a long) and how many rows of that rank belong to the k greatest: 16 bits a round."""
    top = 0
    left = k
    part = rows.select((F.col("rank")).alias("r"))
    for shift in (48, 32, 16, 0):
        digit = F.shiftright("r", shift).bitwiseAND(F.lit(0xFFFF)) if shift < 48 else F.shiftright("r", 48)
        known = part if shift == 48 else part.where(F.shiftright("r", shift + 16) == top)
        counts = sorted(((r[0], r[1]) for r in known.groupBy(digit.alias("d")).count().collect()), reverse=True)  # at most 65,536 rows
        for d, n in counts:
            if left <= n:
                break
            left -= n
        top = d if shift == 48 else (top << 16) | d
    return top, left


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", share: float | None = None, k: int | None = None, seed: int = SEED, good: Column | None = None) -> DataFrame:
    """One row per document: key, ``n_features``, ``log_weight``, ``score`` (with noise) and ``kept`` (one of the k greatest).

    ``k``, else ``share`` of the documents (all of them by default): the
    sample size is the feature of this operator. Rows equal in key and text
    are kept or dropped together, so more than k are kept where such rows
    stand across the k-th place. A null key has the noise of key 0.
    """
    good = good_label() if good is None else good
    ratio = fit(docs, labels, key, text, good)
    t = F.col(text).cast("string")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.xxhash64(t), F.lit(0)).alias("row"), t.alias("text"))
    weighed = rows.mapInArrow(_weights(ratio), "key long, row long, n_features long, log_weight double")
    scored = weighed.withColumn("score", F.col("log_weight") + gumbel(F.coalesce("key", F.lit(0)), seed))
    # order of doubles as order of longs: millionths are finer than any noise
    ranked = settled(scored.withColumn("rank", F.round(F.col("score") * 1e6).cast("long")))
    if k is None:
        k = math.ceil((1.0 if share is None else share) * ranked.count())
    if k <= 0:
        out = ranked.withColumn("kept", F.lit(False))
    else:
        least, at_least = _kth(ranked, k)
        ties = ranked.where(F.col("rank") == least).select("key", "row").orderBy("key", "row").limit(at_least)
        last = ties.agg(F.max(F.struct("key", "row"))).first()[0]  # rows of one rank in a million
        tie = (F.col("rank") == least) & (F.struct(F.col("key"), F.col("row")) <= F.struct(F.lit(last["key"]).cast("long").alias("key"), F.lit(last["row"]).cast("long").alias("row")))
        out = ranked.withColumn("kept", (F.col("rank") > least) | tie)
    return out.select(F.col("key").alias(key), "n_features", F.round("log_weight", 6).alias("log_weight"), F.round("score", 6).alias("score"), "kept")
