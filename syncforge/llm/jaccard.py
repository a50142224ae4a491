"""Near-duplicate join: documents whose word shingles have a Jaccard similarity of ``threshold`` or more.

1. One pass makes a document's set of ``width``-word shingles (hashes), a
   64-bit identity of the set, and ``BANDS * ROWS`` MinHash values of one byte.
   Documents with equal sets are one node from there on.
2. Nodes meet in buckets of equal bands (a pair at similarity 0.8 meets in
   none with probability 1e-7). A bucket is dealt to block pairs, so a huge
   one is many tasks. Each pair is looked at in its first common band only:
   its MinHash values are compared ``STEP`` at a time, and it is dropped as
   soon as the posterior probability of a similarity over the threshold
   (uniform prior) is below ``TOLERANCE``. Survivors leave the task as a
   spanning forest, never as all pairs.
3. Connected survivors form candidate clusters; the sets of their nodes are
   verified exactly, block pair by block pair. Links are counted, not listed;
   the verified links leave as a spanning forest again.

Words are runs of visible characters. A text of 1 to ``width - 1`` words is
one shingle; a text without words (null, empty, blank) has no links and is a
class of its own. Rows with equal key are told apart by their sets. Null keys
are rows like others and come after all keys; a class of null keys alone has a
null name. Ties in the choice of a class's name or of the row to keep go to
the least key, then the least text hash. Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers as B
from .components import components
from .staging import settled

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
STEP = 20
TOLERANCE = 1e-9
#: Nodes of a block; a task compares one pair of blocks.
BLOCK = 1024
#: Pairs compared at once.
PAIRS = 1 << 15
#: Columns of the matrix that counts common shingles at once.
COLUMNS = 1 << 13

_A = B.constants(101, BANDS * ROWS)
_R = B.constants(103, BANDS * ROWS)


@functools.lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """Fewest equal values among the first STEP, 2 STEP, ... that keep a pair.

    One-byte values are equal with probability s + (1 - s) / 256 at
    similarity s; the posterior is integrated on a grid.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(p) + (n - m) * np.log1p(-p)
        weight = np.exp(log - log.max(axis=1, keepdims=True))
        posterior = weight[:, s >= threshold].sum(axis=1) / weight.sum(axis=1)
        out.append(int(np.argmax(posterior >= tolerance)))
    return tuple(out)


def shingles(data: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within a row, and the offsets of each row."""
    starts, ends, first = B.spans(data, offs, B.VISIBLE)
    words = B.span_hashes(data, starts, ends)
    h, _, rows = B.window_hashes(words, first, width)
    n = np.diff(first)
    few = np.flatnonzero((n > 0) & (n < width))
    if len(few):  # one shingle of all words
        x = np.zeros(len(few), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(width - 1):
                has = n[few] > j
                x[has] = B.mix(x[has] + words[first[few[has]] + j] + np.uint64(j + 1))
        h, rows = np.concatenate([h, x]), np.concatenate([rows, few])
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    h, rows = h[new], rows[new]
    return h, np.searchsorted(rows, np.arange(len(offs)))


def set_ids(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identity of each row's set (0 for an empty set)."""
    size = np.diff(at)
    out = np.zeros(len(size), np.uint64)
    some = size > 0
    if some.any():
        with np.errstate(over="ignore"):
            out[some] = B.mix(np.add.reduceat(B.mix(h + np.uint64(17)), at[:-1][some]) + size[some].astype(np.uint64))
        out[some & (out == 0)] = 1
    return out.view(np.int64)


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash values, one byte each, of every row with shingles."""
    some = np.diff(at) > 0
    heads = at[:-1][some]
    out = np.zeros((len(at) - 1, BANDS * ROWS), np.uint8)
    x = np.empty_like(h)
    if len(heads):
        with np.errstate(over="ignore"):
            for i in range(BANDS * ROWS):
                np.bitwise_xor(h, _R[i], out=x)
                np.multiply(x, _A[i], out=x)
                out[some, i] = B.mix(np.minimum.reduceat(x, heads)) >> np.uint64(56)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row: its values and its number."""
    v = np.zeros((len(sig), BANDS), np.uint64)
    for r in range(ROWS):
        v = v << np.uint64(8) | sig[:, r::ROWS].astype(np.uint64)
    return B.mix(v << np.uint64(8) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _nodes(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.blocks(batches, "text"):
            h, at = shingles(*B.flat(b.column("text")), width)
            sig = signatures(h, at)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("row"), pa.array(set_ids(h, at)), B.binary_rows(sig.reshape(-1), np.arange(len(sig) + 1) * BANDS * ROWS)],
                names=["key", "row", "node", "sig"],
            )

    return run


def _sets(width: int):
    """The shingle sets of rows whose text is their node's; rows of an equal key with another text go."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.blocks(batches, "text"):
            h, at = shingles(*B.flat(b.column("text")), width)
            out = pa.RecordBatch.from_arrays([b.column("cluster"), b.column("node"), B.binary_rows(h.astype("<u8").view(np.uint8), at * 8)], names=["cluster", "node", "items"])
            yield out.filter(pa.array(set_ids(h, at) == np.asarray(b.column("node"))))

    return run


def _bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, _ = B.flat(b.column("sig"))
        keys = band_keys(data.reshape(b.num_rows, -1))
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(np.repeat(np.asarray(b.column("node")), BANDS))], names=["band", "node"])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least connected place of each of n places (min-label propagation with pointer jumping)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (label == before).all():
            return label


def _groups(batches: Iterable[pa.RecordBatch], keys: list[str], limit: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of sorted rows (about ``limit`` rows, or one larger group) and the starts of the groups."""
    held: list[pa.Table] = []
    rows = 0

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for k in keys:
            v = np.asarray(t.column(k))
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for b in batches:
        if not b.num_rows:
            continue
        held.append(pa.Table.from_batches([b]))
        rows += b.num_rows
        if rows >= limit:
            t = pa.concat_tables(held).combine_chunks()
            at = starts(t)
            if len(at) > 1:
                yield t.slice(0, int(at[-1])), at[:-1]
                t = t.slice(int(at[-1]))
            held, rows = [t], t.num_rows
    if rows:
        t = pa.concat_tables(held).combine_chunks()
        yield t, starts(t)


def _pairs(at: np.ndarray, n: int, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within groups, about PAIRS at a time: all in a group of one block, else only across its two blocks."""
    size = np.diff(np.append(at, n))
    end = np.repeat(at + size, size)
    left = np.arange(n)
    two = np.repeat(np.bitwise_or.reduceat(1 << side, at) == 3, size)  # groups with both sides
    count = end - left - 1
    total = np.cumsum(count)
    a = 0
    while a < n:
        e = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, "right")))
        i = np.repeat(left[a:e], count[a:e])
        j = B.ragged(left[a:e] + 1, count[a:e])
        ok = ~two[i] | (side[i] != side[j])
        yield i[ok], j[ok]
        a = e


def _survivors(threshold: float, tolerance: float):
    least = least_matches(threshold, tolerance)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in _groups(batches, ["band", "one", "two"], 4 * BLOCK):
            node = np.asarray(t.column("node"))
            sig = B.flat(t.column("sig"))[0].reshape(len(node), -1)
            keys = band_keys(sig)
            number = np.argmax(keys == np.asarray(t.column("band"))[:, None], axis=1)
            found = []
            for i, j in _pairs(at, len(node), np.asarray(t.column("side")).astype(np.int64)):
                common = keys[i] == keys[j]
                ok = np.argmax(common, axis=1) == number[i]  # in their first common band only
                i, j = i[ok], j[ok]
                match = np.zeros(len(i), np.int32)
                for k, need in enumerate(least):
                    part = slice(k * STEP, (k + 1) * STEP)
                    match += (sig[i, part] == sig[j, part]).sum(axis=1, dtype=np.int32)
                    ok = match >= need
                    i, j, match = i[ok], j[ok], match[ok]
                found.append((i, j))
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            label = forest(len(node), i, j)
            edge = np.flatnonzero(label != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays([pa.array(node[edge]), pa.array(node[label[edge]])], names=["a", "b"])

    return run


def common_counts(items: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common items of each row of ``left`` with each row of ``right`` (rows are sets, laid end to end)."""
    own, which = np.unique(items, return_inverse=True)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    many = np.bincount(which) > 1
    keep = many[which]
    column = (np.cumsum(many) - 1)[which[keep]]
    row = row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    out = np.zeros((len(left), len(right)), np.float32)
    place = np.full((2, len(at) - 1), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(np.searchsorted(column, c), np.searchsorted(column, c + COLUMNS))
        m = []
        for side, rows in enumerate((left, right)):
            x = np.zeros((len(rows), COLUMNS), np.float32)
            p = place[side, row[part]]
            x[p[p >= 0], column[part][p >= 0] - c] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out.astype(np.int64)


def _verified(threshold: float):
    num = round(threshold * 1_000_000)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in _groups(batches, ["cluster", "one", "two"], BLOCK):
            node, side, weight = (np.asarray(t.column(c)).astype(np.int64) for c in ("node", "side", "weight"))
            data, offs = B.flat(t.column("items"))
            items, offs = data.view("<u8"), offs // 8
            size = np.diff(offs)
            links = np.zeros(len(node), np.int64)
            ones, twos = [], []
            for a, e in zip(at.tolist(), [*at[1:].tolist(), len(node)], strict=True):
                rows = np.arange(e - a)
                across = len(set(side[a:e].tolist())) == 2
                left, right = (rows[side[a:e] == 0], rows[side[a:e] == 1]) if across else (rows, rows)
                both = common_counts(items[offs[a] : offs[e]], offs[a : e + 1] - offs[a], left, right)
                union = size[a + left][:, None] + size[a + right][None, :] - both
                linked = both * 1_000_000 >= num * union
                if not across:
                    np.fill_diagonal(linked, False)
                else:
                    links[a + right] += linked.T @ weight[a + left]
                links[a + left] += linked @ weight[a + right]
                i, j = np.nonzero(linked)
                ones.append(a + left[i])
                twos.append(a + right[j])
            label = forest(len(node), np.concatenate(ones), np.concatenate(twos))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[label]), pa.array(links)], names=["a", "b", "links"])

    return run


def _block_pairs(rows: DataFrame, group: str) -> DataFrame:
    """Rows of a group of ``size`` nodes, once for each pair of blocks that theirs is part of (one pair up to BLOCK nodes)."""
    n = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("node"), n).cast("int")
    rows = rows.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), n - 1))})
    return rows.withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")}).drop("own", "other", "size").repartition(group, "one", "two").sortWithinPartitions(group, "one", "two", "node")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: key, ``row`` (hash of its text), ``class_id``, ``n_links``, ``kept``.

    ``class_id``: least key of the documents connected by links;
    ``n_links``: other documents (copies counted each) at the threshold or
    over; ``kept``: the one row of the class that stays.
    """
    t = F.col(text).cast("string")
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.xxhash64(t), F.lit(0)).alias("row"), t.alias("text"))
    every = settled(narrow.mapInArrow(_nodes(width), "key long, row long, node long, sig binary"))
    members = every.where("node <> 0").select("key", "row", "node", "sig")
    nodes = settled(members.groupBy("node").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("who"), F.count("*").alias("weight"), F.first("sig").alias("sig")))
    clusters = settled(_clusters(nodes, threshold, tolerance))
    sized = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    chosen = nodes.select("node", "weight", F.col("who.key").alias("of"), F.col("who.row").alias("its")).join(clusters, "node").join(sized, "cluster")
    texts = narrow.join(chosen.select("of", "its", "node", "cluster"), F.col("key").eqNullSafe(F.col("of")) & (F.col("row") == F.col("its")))
    sets = texts.mapInArrow(_sets(width), "cluster long, node long, items binary").dropDuplicates(["node"])
    placed = _block_pairs(sets.join(chosen.select("node", "weight", "size"), "node"), "cluster")
    checked = settled(placed.mapInArrow(_verified(threshold), "a long, b long, links long"))
    links = checked.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    root = components(checked.where("a <> b").select("a", "b"))
    named = nodes.join(root, "node", "left").join(links, "node", "left").select("node", "weight", "who", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    least = named.groupBy("root").agg(F.min("who").alias("least"))
    by_node = named.join(least, "root").select("node", F.col("least"), (F.col("links") + F.col("weight") - 1).alias("n_links"))
    alone = F.col("node") == 0
    joined = every.select("key", "row", "node").join(by_node, "node", "left")
    return joined.select(
        F.col("key").alias(key),
        "row",
        F.when(alone, F.col("key")).otherwise(F.col("least.key")).alias("class_id"),
        F.when(alone, F.lit(0).cast("long")).otherwise(F.col("n_links")).alias("n_links"),
        (alone | (F.col("key").eqNullSafe(F.col("least.key")) & (F.col("row") == F.col("least.row")))).alias("kept"),
    )


def _clusters(nodes: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Nodes connected by pairs that survive the pruning, by cluster (nodes without such a pair are left out)."""
    bands = nodes.select("node", "sig").mapInArrow(_bands, "band long, node long")
    shared = bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    met = bands.join(shared, "band").join(nodes.select("node", "sig"), "node")
    pairs = _block_pairs(met, "band").mapInArrow(_survivors(threshold, tolerance), "a long, b long")
    return components(pairs).withColumnRenamed("root", "cluster")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with one row of each class (the least key, then the least text hash); columns unchanged.

    Rows equal in key and text are the same document; one of them stays.
    """
    found = classes(docs, key, text, width, threshold, tolerance)
    gone = found.where(~F.col("kept")).select(F.col(key).alias("__key"), F.col("row").alias("__row")).distinct()
    own: Column = F.coalesce(F.xxhash64(F.col(text).cast("string")), F.lit(0))
    left = docs.withColumn("__own", own)
    twice = docs.groupBy(F.col(key).alias("k")).count().agg(F.max("count")).first()[0] or 0
    if twice > 1:  # else no row has an equal
        left = left.dropDuplicates([key, "__own"])
    same = left[key].cast("long").eqNullSafe(gone["__key"]) & (left["__own"] == gone["__row"])
    return left.join(gone, same, "left_anti").drop("__own")
