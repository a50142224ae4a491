"""Benchmark decontamination with an FM-index per training shard.

A shard is a block of documents of a task. Its words become ids of the
benchmark's vocabulary; a word no benchmark item has cannot be part of an
occurrence, so maximal runs of known words are the strings to index. The
index is the Burrows-Wheeler transform of these runs in a wavelet tree with
rank counts, and suffix positions sampled at every ``SAMPLE``-th word. All
test phrases are searched backwards at once; each match is located by
stepping back to a sampled suffix. Matches are merged to removal spans.

The benchmark is a stated query set: it is cut into blocks of at most
``block_words`` words (its proven bound), and each block is searched in all
documents. Nothing about the documents leaves their task but their spans.

A phrase is ``width`` consecutive words of an item, or a shorter item as a
whole. Words are runs of 0-9, a-z (A-Z lower-cased) and all characters from
U+0080 on. Null and empty texts have no words and are never hit; items
without words have no phrase; repeated items count each; an empty benchmark
hits nothing. Equal keys are judged row by row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buffers as B

WIDTH = 10
BLOCK_WORDS = 2_000_000
SAMPLE = 8


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector per level of the symbols' bits, most significant first."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.bits)):
            bit = ((seq >> level) & 1).astype(bool)
            count = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(seq) - int(count[-1]))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol[i]`` before place ``at[i]``."""
        lo = np.zeros_like(at)
        for level, (count, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            lo = np.where(bit, zeros + count[lo], lo - count[lo])
            at = np.where(bit, zeros + count[at], at - count[at])
        return at - lo

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the places ``at``."""
        out = np.zeros(len(at), np.int64)
        for count, zeros in zip(self.ones, self.zeros, strict=True):
            bit = count[at + 1] > count[at]
            out = (out << 1) | bit
            at = np.where(bit, zeros + count[at], at - count[at])
        return out


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of a sequence by their suffixes; symbol 0 ends a run and differs from every other end (the earlier is smaller).

    Prefix doubling; each round sorts only the places whose rank is not yet unique.
    """
    n = len(text)
    end = text == 0
    key = text.astype(np.int64)
    key[end] = np.arange(int(end.sum()))
    key[~end] += int(end.sum())
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    head = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    while True:
        alone = head & np.concatenate([head[1:], [True]])
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            return order
        place = order[open_]
        group, after = rank[place], rank[np.minimum(place + step, n - 1)]
        by = np.lexsort((after, group))
        place, group, after = place[by], group[by], after[by]
        order[open_] = place
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        head[open_] = new
        rank[place] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        step *= 2


class FmIndex:
    """Backward search and location of word phrases in runs of words (each run ends with symbol 0)."""

    def __init__(self, text: np.ndarray, sigma: int):
        order = suffix_order(text)
        self.bwt = WaveletTree(text[order - 1], sigma)
        self.before = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=sigma), out=self.before[1:])
        # kept: places at every SAMPLE-th word and at a run's first word, so a walk never steps over a run's end
        first = np.concatenate([[True], text[:-1] == 0])
        self.sampled = ((order % SAMPLE) == 0) | first[order]
        self.samples = order[self.sampled]
        self.nth = np.concatenate([[0], np.cumsum(self.sampled)])

    def search(self, phrases: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of the suffixes that start with each phrase; phrases are right-aligned in a matrix."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.before[-1], np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1]):
            live = live[(size[live] > j) & (lo[live] < hi[live])]
            c = phrases[live, phrases.shape[1] - 1 - j]
            both = self.bwt.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            lo[live] = self.before[c] + both[: len(live)]
            hi[live] = self.before[c] + both[len(live) :]
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of suffix rows: back to the previous sampled suffix, counting the steps."""
        out, steps, live, at = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows)), rows.copy()
        while len(live):
            here = self.sampled[at]
            out[live[here]] = self.samples[self.nth[at[here]]] + steps[live[here]]
            live, at = live[~here], at[~here]
            steps[live] += 1
            c = self.bwt.access(at)
            at = self.before[c] + self.bwt.rank(c, at)
        return out


@dataclass
class Phrases:
    """Phrases of a block of items: words by hash and bytes, distinct phrases as id rows, and the items of each."""

    vocab: np.ndarray  # sorted hashes, no two alike; id of vocab[i] is i + 1
    seed: int  # of the hashes
    raw: np.ndarray  # the words' bytes, in order of their ids
    raw_at: np.ndarray
    rows: np.ndarray  # phrases, right-aligned
    size: np.ndarray
    items: list[np.ndarray]  # item keys by phrase
    shortest: int

    @classmethod
    def of(cls, items: list[tuple[object, str | None]], width: int) -> Phrases | None:
        items = sorted((str(k), t) for k, t in items if t)
        if not items:
            return None
        data, offs = B.flat(pa.array([t for _, t in items], pa.large_string()))
        data = B.FOLD[data]
        starts, ends, first = B.spans(data, offs, B.ALNUM)
        words = sorted({data[a:e].tobytes() for a, e in zip(starts.tolist(), ends.tolist(), strict=True)})
        raw, raw_at = np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        seed = 1
        while len(vocab := np.unique(B.span_hashes(raw, raw_at[:-1], raw_at[1:], seed))) < len(words):
            seed += 1  # two words of the benchmark share a hash
        order = np.argsort(B.span_hashes(raw, raw_at[:-1], raw_at[1:], seed))
        size = np.diff(raw_at)[order]
        raw, raw_at = raw[B.ragged(raw_at[:-1][order], size)], np.concatenate([[0], np.cumsum(size)])
        ids = np.searchsorted(vocab, B.span_hashes(data, starts, ends, seed)) + 1
        found: dict[tuple[int, ...], set[str]] = {}
        for i, (key, _) in enumerate(items):
            own = ids[first[i] : first[i + 1]].tolist()
            for j in range(max(1, len(own) - width + 1) if own else 0):
                found.setdefault(tuple(own[j : j + width]), set()).add(key)
        if not found:
            return None
        size = np.array([len(p) for p in found])
        rows = np.zeros((len(found), width), np.int64)
        for i, p in enumerate(found):
            rows[i, width - len(p) :] = p
        return cls(vocab, seed, raw, raw_at, rows, size, [np.array(sorted(v)) for v in found.values()], int(size.min()))


def known_runs(ids: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of known words (id > 0) inside a row with at least ``least`` words."""
    known = ids > 0
    starts, ends, _ = B.spans(known.astype(np.uint8), first, np.arange(256) > 0)
    long_ = ends - starts >= least
    return starts[long_], ends[long_]


def matches(data: np.ndarray, offs: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, ...]:
    """Of a shard: word starts, word ends, first word of each row, and its matches (first word, words, phrase)."""
    data = B.FOLD[data]
    starts, ends, first = B.spans(data, offs, B.ALNUM)
    none = np.zeros(0, np.int64)
    h = B.span_hashes(data, starts, ends, phrases.seed)
    at = np.minimum(np.searchsorted(phrases.vocab, h), len(phrases.vocab) - 1)
    alike = np.flatnonzero(phrases.vocab[at] == h)
    alike = alike[B.equal_spans(data, starts[alike], ends[alike], phrases.raw, phrases.raw_at[at[alike]], phrases.raw_at[at[alike] + 1])]
    ids = np.zeros(len(h), np.int64)
    ids[alike] = at[alike] + 1
    rs, re_ = known_runs(ids, first, phrases.shortest)
    if not len(rs):
        return starts, ends, first, none, none, none
    size = re_ - rs
    origin = B.ragged(rs, size + 1)  # each run and one place for its end
    text = np.zeros(len(origin), np.int64)
    inside = np.ones(len(origin), bool)
    inside[np.cumsum(size + 1) - 1] = False
    text[inside] = ids[origin[inside]]
    index = FmIndex(text, len(phrases.vocab) + 1)
    lo, hi = index.search(phrases.rows, phrases.size)
    hit = np.flatnonzero(hi > lo)
    rows = B.ragged(lo[hit], (hi - lo)[hit])
    phrase = np.repeat(hit, (hi - lo)[hit])
    return starts, ends, first, origin[index.locate(rows)], phrases.size[phrase], phrase


#: Of each document: its words, its merged spans of hit words (first word, end word, first byte, end byte) and its items.
SPANS = "n_words long, spans array<struct<first:long,last:long,start:long,end:long>>, items array<string>"
_SPAN = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def shard_hits(data: np.ndarray, offs: np.ndarray, phrases: Phrases | None) -> tuple[np.ndarray, list, list]:
    """Per row of a shard: words, merged spans and sorted items."""
    n = len(offs) - 1
    spans_of: list = [[] for _ in range(n)]
    items_of: list = [[] for _ in range(n)]
    if phrases is None:
        _, _, first = B.spans(B.FOLD[data], offs, B.ALNUM)
        return np.diff(first), spans_of, items_of
    starts, ends, first, at, size, phrase = matches(data, offs, phrases)
    if len(at):
        hit = B.covered(len(starts), at, at + size)
        hs, he, _ = B.spans(hit.astype(np.uint8), first, np.arange(256) > 0)
        row = np.searchsorted(first, hs, "right") - 1
        for r, a, b in zip(row.tolist(), hs.tolist(), he.tolist(), strict=True):
            spans_of[r].append({"first": a - int(first[r]), "last": b - int(first[r]), "start": int(starts[a] - offs[r]), "end": int(ends[b - 1] - offs[r])})
        pairs = np.unique(np.stack([np.searchsorted(first, at, "right") - 1, phrase]), axis=1)
        for r, p in pairs.T.tolist():
            items_of[r].append(phrases.items[p])
        items_of = [sorted(set().union(*map(list, x))) if x else [] for x in items_of]
    return np.diff(first), spans_of, items_of


def _phrase_blocks(benchmark: DataFrame, key: str, text: str, width: int, block_words: int) -> list[Phrases | None]:
    """The benchmark's phrases in blocks of at most ``block_words`` words (or one longer item)."""
    rows = benchmark.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t"))
    size = F.coalesce(F.octet_length("t"), F.lit(0))
    total = rows.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // (2 * block_words)))  # a word and its separator take two bytes at least
    if n == 1:
        return [Phrases.of([tuple(r) for r in rows.collect()], width)]
    part = F.pmod(F.xxhash64("k", "t"), F.lit(n))
    return [Phrases.of([tuple(r) for r in rows.where(part == i).collect()], width) for i in range(n)]


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", width: int = WIDTH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: key, ``n_words``, ``n_hit``, ``spans`` (merged, in words and bytes) and ``items`` (sorted keys)."""
    narrow = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("text"))
    parts = [narrow.mapInArrow(_found(p, key), f"`{key}` long, row long, {SPANS}") for p in _phrase_blocks(benchmark, item_key, item_text, width, block_words)]
    if len(parts) == 1:
        found = parts[0].drop("row")
    else:
        found = _united(parts, key)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])
    return found.withColumn("n_hit", hit)


def _found(phrases: Phrases | None, key: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.blocks(batches, "text"):
            data, offs = B.flat(b.column("text"))
            n, spans, items = shard_hits(data, offs, phrases)
            digest = [int.from_bytes(hashlib.blake2b(data[offs[i] : offs[i + 1]].tobytes(), digest_size=8).digest(), "big", signed=True) for i in range(len(n))]
            yield pa.RecordBatch.from_arrays(
                [b.column(key).cast(pa.int64()), pa.array(digest, pa.int64()), pa.array(n, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))],
                names=[key, "row", "n_words", "spans", "items"],
            )

    return run


def _merged(spans):
    """Overlapping or touching spans of sorted spans joined."""

    def add(done, s):
        last = F.element_at(done, -1)
        both = F.struct(last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"), last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["last"] >= s["first"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(both))).otherwise(F.concat(done, F.array(s)))

    empty = F.array().cast("array<struct<first:long,last:long,start:long,end:long>>")
    return F.aggregate(F.array_sort(spans), empty, add)


def _united(parts: list[DataFrame], key: str) -> DataFrame:
    """Hits of several benchmark blocks; equal (key, text) rows get the same hits, so one of them stands for all."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    rows = every.groupBy(key, "row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), (F.count("*") / F.lit(len(parts))).cast("int").alias("copies"))
    return rows.withColumn("spans", _merged("spans")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies", "row")


def cut(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", width: int = WIDTH, block_words: int = BLOCK_WORDS, length: str | None = None) -> DataFrame:
    """``docs`` with the removal spans cut from the texts; a text that had spans and has no word left is dropped.

    All other rows and columns stay as they are (``length``, if named, is set
    to the code points of a changed text). One pass over the documents per
    block of the benchmark.
    """
    kinds = docs.schema
    at = docs.columns.index(text)
    plain = docs.toDF(*(f"c{i}" for i in range(len(kinds))))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kinds))
    found = _phrase_blocks(benchmark, item_key, item_text, width, block_words)
    marks = plain.withColumn("gone", F.array().cast("array<struct<first:long,last:long,start:long,end:long>>"))
    for p in found[:-1]:
        marks = marks.mapInArrow(_marked(p, at), schema + ", gone array<struct<first:long,last:long,start:long,end:long>>")
    mark, remove = _marked(found[-1], at), _cut(at, None if length is None else docs.columns.index(length))
    rows = marks.mapInArrow(lambda batches: remove(mark(batches)), schema)
    return rows.select(*(F.col(f"c{i}").alias(f.name) for i, f in enumerate(kinds)))


def _marked(phrases: Phrases | None, at: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.blocks(batches, f"c{at}"):
            _, spans, _ = shard_hits(*B.flat(b.column(at)), phrases)
            gone = [a + s for a, s in zip(b.column("gone").to_pylist(), spans, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(gone, pa.list_(_SPAN))], names=b.schema.names)

    return run


def _cut(at: int, length: int | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.blocks(batches, f"c{at}"):
            data, offs = B.flat(b.column(at))
            gone = b.column("gone").to_pylist()
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            hit = [i for i, g in enumerate(gone) if g]
            if hit:
                stay = np.ones(len(data), bool)
                for i in hit:
                    for s in gone[i]:
                        stay[offs[i] + s["start"] : offs[i] + s["end"]] = False
                left = np.concatenate([[0], np.cumsum(stay)])[offs]
                _, _, first = B.spans(data[stay], left, B.ALNUM)
                texts = B.binary_rows(data[stay], left, pa.string())
                touched = np.zeros(len(gone), bool)
                touched[hit] = True
                mask = pa.array(touched)
                cols[at] = pa.compute.if_else(mask, texts, b.column(at).cast(pa.string())).cast(b.column(at).type)
                if length is not None:
                    cols[length] = pa.compute.if_else(mask, pa.compute.utf8_length(texts).cast(cols[length].type), cols[length])
                ok = pa.array(~touched | (np.diff(first) > 0))
                b = pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1]).filter(ok)
            else:
                b = pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])
            yield b

    return run
