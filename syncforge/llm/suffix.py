"""Exact substring deduplication: every byte of a ``length``-byte string that also starts earlier.

Places of one string must meet in one task. Each window of ``length`` bytes
is dealt by its minimizer (the least hash of its ``GRAM``-byte substrings, the
leftmost on a tie): consecutive windows with the same minimizer place form
one short string of at most ``2 * length - GRAM`` bytes, sent once, to the
bucket of the minimizer's hash. Equal windows have equal minimizers at equal
offsets, so they always meet. Grams of a short period (runs of one byte,
rules of dashes) rank after all others, so only windows that are periodic
throughout are dealt by them. Of equal strings of a block of documents only
the one at the least place is sent: the others are removed where they are
found, and their ranges pass beside the strings. A bucket that outgrows
``HELD_BYTES`` is reduced in the same way while it is read.

In a bucket the strings of minimizers that occur in several different
strings are concatenated and their Burrows-Wheeler transform is built. From
the single-symbol intervals on, breadth-first backward extension through
wavelet-tree ranks marks the suffix boundaries with common prefix 0, 1, 2
and so on, each level from the one before; it stops at ``length``. The
boundaries never reached separate suffixes with at least ``length`` bytes in
common: these are the repeated windows. The place that is least by (key,
text hash, start) stays, all others go.

Equal strings are found by a 64-bit hash and compared by their bytes.

Null and empty texts, and texts shorter than ``length``, lose nothing. Null
keys come before all others. Rows with equal key and equal text count as one document and get the same result;
rows with equal key and different texts are ordered by their text's hash. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import buffers as B
from .decontam import WaveletTree

LENGTH = 100
GRAM = 16
#: Window starts that are hashed at once.
STRETCH = 1 << 16
#: Bytes of text a bucket stands for, and bytes of text whose strings are sent together.
BUCKET_BYTES = 12 << 20
BLOCK_BYTES = 4 << 20
#: Bytes of strings of one transform (the strings of one minimizer stay together).
INDEX_BYTES = 1 << 19
#: Bytes of strings of a bucket at which equal ones are reduced to their least place.
HELD_BYTES = 128 << 20

_PLACE, _PLACE_MASK = np.uint64(17), np.uint64((1 << 17) - 1)
_K = B.constants(11, 16)
_TABLE = B.constants(13, 256)


def _grams(d: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on."""
    with np.errstate(over="ignore"):
        g, have, out, done, k = _TABLE[d], 1, None, 0, 0
        while True:
            if size & have:
                if out is None:
                    out = g[: len(d) - size + 1].copy()
                else:
                    out = (out ^ (out >> np.uint64(31))) * _K[k] + g[done : done + len(out)]
                done += have
            if done == size:
                return B.mix(out)
            n = len(g) - have
            g = (g[:n] ^ (g[:n] >> np.uint64(29))) * _K[k + 1] + g[have:]
            have, k = 2 * have, k + 2


def _periodic(d: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` bytes from each place on have a period of at most half of them."""
    out = np.zeros(len(d) - size + 1, bool)
    for p in range(1, size // 2 + 1):
        out |= _sliding_min(d[p:] == d[:-p], size - p)
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x5851F42D4C957F2D
    p, q = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    p[0] = q[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(p), np.multiply.accumulate(q)


def runs(data: np.ndarray, offs: np.ndarray, length: int, gram: int, powers) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimizer place: start, windows, minimizer, a hash of the run's bytes, and the place's offset."""
    parts = []
    valid_to = offs[1:] - length + 1  # past the last window start of each row
    lo, hi = offs[:-1], valid_to
    for p in range(0, len(data) - length + 1, STRETCH):
        d = data[p : p + STRETCH + length - 1]
        n = len(d) - length + 1
        g = _grams(d, gram) >> np.uint64(1) | _periodic(d, gram).astype(np.uint64) << np.uint64(63)
        key = _sliding_min((g >> _PLACE << _PLACE) | np.arange(len(g), dtype=np.uint64), length - gram + 1)[:n]
        ok = np.zeros(n + 1, np.int8)
        a, b = np.clip(lo - p, 0, n), np.clip(hi - p, 0, n)
        some = a < b
        ok[a[some]] += 1
        np.add.at(ok, b[some], -1)
        ok = np.cumsum(ok[:-1]) > 0
        new = ok.copy()
        new[1:] &= (key[1:] != key[:-1]) | ~ok[:-1]
        new[a[some]] = True
        start = np.flatnonzero(new)
        if not len(start):
            continue
        last = ok.copy()
        last[:-1] &= new[1:] | ~ok[1:]
        size = np.flatnonzero(last) + 1 - start
        with np.errstate(over="ignore"):
            c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[d] * powers[0][: len(d)])])
            sid = B.mix((c[start + size + length - 1] - c[start]) * powers[1][start] + size.astype(np.uint64))
        parts.append((start + p, size, key[start] >> _PLACE, sid, (key[start] & _PLACE_MASK).astype(np.int64) - start))
    if not parts:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(np.uint64), z.astype(np.uint64), z
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


#: Strings of a bucket from one block: minimizer (low and high part), windows, offset of its place; key, text hash
#: and start of the string's least place. The strings' bytes follow in a frame of their own.
_KINDS = ("<u4", "<u2", "<u2", "<u2", "<i8", "<i8", "<i4")
#: Ranges to remove that a block finds by itself: key, text hash, from, to. They pass under bucket numbers below 0.
_RANGES = ("<i8", "<i8", "<u4", "<u4")


def _packed(arrays: Iterable[np.ndarray], kinds: tuple[str, ...] = _KINDS) -> bytes:
    raw = [np.ascontiguousarray(a, k).tobytes() for a, k in zip(arrays, kinds, strict=True)]
    return np.array([len(r) for r in raw], "<i8").tobytes() + zstandard.compress(b"".join(raw), 3)


def _unpacked(payload: bytes, kinds: tuple[str, ...] = _KINDS) -> list[np.ndarray]:
    size = np.frombuffer(payload, "<i8", len(kinds))
    raw = zstandard.decompress(payload[8 * len(kinds) :])
    at = np.cumsum(size) - size
    return [np.frombuffer(raw, k, int(n) // np.dtype(k).itemsize, int(a)) for a, n, k in zip(at, size, kinds, strict=True)]


def _least_places(group: np.ndarray, key: np.ndarray, digest: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the least place of each group (0, 1, ... in order), and the places that are greater than their group's."""
    many = np.flatnonzero(np.bincount(group)[group] > 1)
    first = np.empty(int(group.max()) + 1, np.int64)
    first[group] = np.arange(len(group))
    least = _least(group[many], key[many], digest[many], start[many])
    first[group[many[least]]] = many[least]
    own = first[group[many]]
    return first, many[(key[many] != key[own]) | (digest[many] != digest[own]) | (start[many] != start[own])]


def _changes(order: np.ndarray, low: np.ndarray, sid: np.ndarray, text: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where, in this order, another string begins: by minimizer and hash, and by the bytes of those that agree in both."""
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (sid[order][1:] != sid[order][:-1])
    i = np.flatnonzero(~new)
    a, b = order[i - 1], order[i]
    new[i] = ~B.equal_spans(text, at[a], end[a], text, at[b], end[b])
    return new


def _sent(buckets: int, length: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(STRETCH + length)
        for b in B.blocks(batches, "text", BLOCK_BYTES):
            data, offs = B.flat(b.column("text"))
            keys = np.asarray(b.column("key").fill_null(-(1 << 63))).astype(np.int64)
            digest = np.asarray(b.column("row")).astype(np.int64)
            start, size, low, sid, anchor = runs(data, offs, length, gram, powers)
            if not len(start):
                continue
            doc = np.searchsorted(offs, start, "right") - 1
            bucket = (low % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((sid, low, bucket))
            start, size, low, sid, anchor, doc, bucket = (x[order] for x in (start, size, low, sid, anchor, doc, bucket))
            new = _changes(np.arange(len(start)), low, sid, data, start, start + size + length - 1)
            key, row, begin, end = keys[doc], digest[doc], start - offs[doc], start - offs[doc] + size + length - 1
            one, gone = _least_places(np.cumsum(new) - 1, key, row, begin)
            names, packed = [], []
            if len(gone):
                found = _packed(_merged(key[gone], row[gone], begin[gone], end[gone]), _RANGES)
                names.append(-1 - zlib.crc32(found))
                packed.append((found, b""))
            cut = np.flatnonzero(np.concatenate([[True], bucket[one][1:] != bucket[one][:-1], [True]]))
            for a, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                own = one[a:e]
                arrays = (low[own] & np.uint64(0xFFFFFFFF), low[own] >> np.uint64(32), size[own], anchor[own], key[own], row[own], begin[own])
                names.append(int(bucket[own[0]]))
                packed.append((_packed(arrays), zstandard.compress(data[B.ragged(start[own], size[own] + length - 1)].tobytes(), 5)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), *(pa.array(x, pa.binary()) for x in zip(*packed, strict=True))], names=["bucket", "payload", "bytes"])

    return run


def truncated_order(text: np.ndarray, rest: np.ndarray, depth: int) -> np.ndarray:
    """Places by their first ``depth`` symbols (0 ends a string; ``rest``: symbols before the end)."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    key, take = text.astype(np.int64), 1
    while 2 * take * bits <= 63:  # symbols of the first rank, doubled too
        after = np.zeros(n, np.int64)
        after[: max(n - take, 0)] = key[take:]
        after[rest < take] = 0
        key = key << (bits * take) | after
        take *= 2
    order = np.argsort(key)
    sorted_ = key[order]
    head = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = take
    while step < depth:
        open_ = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
        if not len(open_):
            break
        place = order[open_]
        after = np.where(rest[place] >= step, rank[np.minimum(place + step, n - 1)], 0)
        both = rank[place] * (n + 1) + after
        by = np.argsort(both)
        place, both = place[by], both[by]
        order[open_] = place
        new = np.concatenate([[True], both[1:] != both[:-1]])
        head[open_] = new
        rank[place] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        step *= 2
    return order


class Intervals(WaveletTree):
    """Backward extension of suffix intervals by all symbols that precede them."""

    def __init__(self, seq: np.ndarray, sigma: int, before: np.ndarray):
        super().__init__(seq, sigma)
        self.before = before
        symbols = np.arange(sigma)
        self.base = np.zeros(sigma, np.int64)
        for level, (count, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((symbols >> (self.bits - 1 - level)) & 1).astype(bool)
            self.base = np.where(bit, zeros + count[self.base], self.base - count[self.base])

    def extend(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = np.zeros(len(lo), np.int32)
        for count, zeros in zip(self.ones, self.zeros, strict=True):
            a, b = count[lo], count[hi]
            none, some = hi - b > lo - a, b > a
            lo, hi, c = (
                np.concatenate([(lo - a)[none], (zeros + a)[some]]),
                np.concatenate([(hi - b)[none], (zeros + b)[some]]),
                np.concatenate([c[none] << 1, c[some] << 1 | 1]),
            )
        inner = c > 0  # nothing extends over a string's start
        lo, hi, c = lo[inner], hi[inner], c[inner]
        shift = (self.before[c] - self.base[c]).astype(lo.dtype)
        return lo + shift, hi + shift


def repeated(text: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``length`` bytes found several times in strings laid end to end: string, offset, group."""
    used = np.unique(text)
    code = np.zeros(256, np.int32)
    code[used] = np.arange(1, len(used) + 1)
    n = len(text) + len(size)
    seq = np.zeros(n, np.int32)
    inside = np.ones(n, bool)
    ends = np.cumsum(size + 1) - 1
    inside[ends] = False
    seq[inside] = code[text]
    string = np.repeat(np.arange(len(size)), size + 1)
    rest = ends[string] - np.arange(n)
    order = truncated_order(seq, rest, length)
    sigma = len(used) + 1
    before = np.zeros(sigma + 1, np.int64)
    np.cumsum(np.bincount(seq, minlength=sigma), out=before[1:])
    tree = Intervals(seq[order - 1], sigma, before)
    known = np.zeros(n + 1, bool)  # boundaries whose common prefix is found
    known[before] = True
    lo, hi = before[:-1].astype(np.int32), before[1:].astype(np.int32)
    for _ in range(1, length):
        lo, hi = tree.extend(lo, hi)
        new = ~known[hi]
        lo, hi = lo[new], hi[new]
        if not len(lo):
            break
        known[hi] = True
    group = np.cumsum(known[:-1])
    ok = rest[order] >= length
    place, group = order[ok], group[ok]
    many = np.bincount(group)[group] > 1
    place, group = place[many], group[many]
    s = string[place]
    return s, place - (ends[s] - size[s]), group


def _least(key: np.ndarray, *by: np.ndarray) -> np.ndarray:
    """Index of the least item, by ``by``, of each distinct value of ``key`` (in order of the key)."""
    order = np.lexsort((*by[::-1], key))
    k = key[order]
    return order[np.concatenate([[True], k[1:] != k[:-1]])] if len(k) else order


def _sharing(text: np.ndarray, at: np.ndarray, size: np.ndarray, anchor: np.ndarray, group: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which strings can share a window with another of their group.

    A shared window reaches ``half`` bytes or more past the minimizer's place
    on one side, and those bytes are then equal.
    """
    half = -(-(length - gram) // 2)
    end = size + length - 1
    out = np.zeros(len(at), bool)
    for side, ok, begin in ((1, anchor >= half, at + anchor - half), (2, anchor + gram + half <= end, at + anchor + gram)):
        i = np.flatnonzero(ok)
        near = text[B.ragged(begin[i], np.full(len(i), half))]
        step = np.arange(len(i)) * half
        h = B.span_hashes(near, step, step + half, seed=side) if half else np.zeros(len(i), np.uint64)
        _, which, count = np.unique(np.stack([group[i].astype(np.uint64), h]), axis=1, return_inverse=True, return_counts=True)
        out[i[count[which.reshape(-1)] > 1]] = True
    return out


def removals(strings: list[np.ndarray], places: list[np.ndarray], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Byte ranges to remove (key, text hash, from, to), of strings and places whose minimizers occur several times."""
    low, size, anchor, text = strings
    string, key, digest, start = places
    at = np.cumsum(size + length - 1) - (size + length - 1)
    # strings by minimizer and hash, each once
    sid = B.span_hashes(text, at, at + size + length - 1)
    order = np.lexsort((sid, low))
    new = _changes(order, low, sid, text, at, at + size + length - 1)
    number = np.empty(len(low), np.int64)
    number[order] = np.cumsum(new) - 1
    one = order[new]
    string = number[string]
    low, size, anchor, at = low[one], size[one], anchor[one], at[one]
    group = np.cumsum(np.concatenate([[0], low[1:] != low[:-1]]))
    first = _least(string, key, digest, start)
    owner = np.full(len(low), -1, np.int64)
    owner[string[first]] = first
    is_first = (key == key[owner[string]]) & (digest == digest[owner[string]]) & (start == start[owner[string]])
    out = [(key[~is_first], digest[~is_first], start[~is_first], start[~is_first] + size[string[~is_first]] + length - 1)]
    # different strings of one minimizer: find the windows they share
    mixed = np.flatnonzero(np.bincount(group)[group] > 1)
    mixed = mixed[_sharing(text, at[mixed], size[mixed], anchor[mixed], group[mixed], length, gram)]
    total = np.cumsum(size[mixed] + length)
    edge = np.flatnonzero(np.concatenate([[True], group[mixed][1:] != group[mixed][:-1], [True]])) if len(mixed) else mixed
    a = 0
    while a < len(edge) - 1:
        done = total[edge[a] - 1] if edge[a] else 0
        e = max(a + 1, int(np.searchsorted(total[edge[1:] - 1], done + INDEX_BYTES, "right")))
        own = mixed[edge[a] : edge[e]]
        a = e
        bytes_ = text[B.ragged(at[own], size[own] + length - 1)]
        s, off, g = repeated(bytes_, size[own] + length - 1, length)
        if not len(s):
            continue
        s = own[s]
        p = owner[s]
        least = _least(g, key[p], digest[p], start[p] + off)
        winner = np.zeros(int(g.max()) + 1, np.int64)
        winner[g[least]] = least
        gone = np.flatnonzero(winner[g] != np.arange(len(g)))
        gone = gone[np.lexsort((off[gone], s[gone]))]
        s, off, p = s[gone], off[gone], p[gone]
        cut = np.concatenate([[True], (s[1:] != s[:-1]) | (off[1:] != off[:-1] + 1)]) if len(s) else np.zeros(0, bool)
        last = np.append(cut[1:], True) if len(s) else cut
        out.append((key[p[cut]], digest[p[cut]], start[p[cut]] + off[cut], start[p[cut]] + off[last] + length))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _text(part: tuple[list[np.ndarray], bytes | np.ndarray]) -> np.ndarray:
    """The bytes of a part's strings (compressed as sent, plain once folded)."""
    return np.frombuffer(zstandard.decompress(part[1]), np.uint8) if isinstance(part[1], bytes) else part[1]


def folded(parts: list[tuple[list[np.ndarray], bytes | np.ndarray]], length: int) -> tuple[tuple, tuple[np.ndarray, ...]]:
    """The parts as one, each string once at its least place, and the ranges of its other places."""
    every = [np.concatenate(x) for x in zip(*(p for p, _ in parts), strict=True)]
    text = np.concatenate([_text(p) for p in parts])
    size = every[2].astype(np.int64) + length - 1
    at = np.cumsum(size) - size
    low = every[1].astype(np.uint64) << np.uint64(32) | every[0]
    sid = B.span_hashes(text, at, at + size)
    order = np.lexsort((sid, low))
    new = _changes(order, low, sid, text, at, at + size)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    key, row, start = every[4:]
    one, gone = _least_places(group, key, row, start)
    return ([x[one] for x in every], text[B.ragged(at[one], size[one])]), (key[gone], row[gone], start[gone].astype(np.int64), start[gone] + size[gone])


def solve_bucket(parts: list[tuple[list[np.ndarray], bytes | np.ndarray]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Byte ranges to remove, of all that was sent to one bucket; bytes of strings that cannot repeat are never kept."""
    every = [np.concatenate(x) for x in zip(*(p for p, _ in parts), strict=True)]
    low, size, anchor = every[1].astype(np.uint64) << np.uint64(32) | every[0], every[2].astype(np.int64), every[3].astype(np.int64)
    shift = np.cumsum([0, *(len(p[0]) for p, _ in parts)])
    _, of, count = np.unique(low, return_inverse=True, return_counts=True)
    several = (count > 1)[of]
    if not several.any():
        z = np.zeros(0, np.int64)
        return z, z, z, z
    text = []
    for part, a, e in zip(parts, shift[:-1].tolist(), shift[1:].tolist(), strict=True):
        n = size[a:e] + length - 1
        own = several[a:e]
        text.append(_text(part)[B.ragged((np.cumsum(n) - n)[own], n[own])])
    places = [np.arange(int(several.sum())), *(x[several].astype(np.int64) for x in every[4:])]
    return removals([low[several], size[several], anchor[several], np.concatenate(text)], places, length, gram)


def _merged(key: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges ordered by document and start; those that touch the one before are one with it."""
    order = np.lexsort((end, start, row, key))
    key, row, start, end = key[order], row[order], start[order], end[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (start[1:] > end[:-1])
    at = np.flatnonzero(new)
    return key[at], row[at], start[at], np.maximum.reduceat(end, at) if len(at) else end


def _rows(key: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """One row for each range (a row a document and bucket would grow with their product), as a pair of 32-bit numbers."""
    key, row, start, end = _merged(key, row, start, end)
    pairs = np.stack([start, end], axis=1).astype("<u4").view(np.uint8)
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(row), B.binary_rows(pairs.reshape(-1), 8 * np.arange(len(key) + 1))], names=["key", "row", "gone"])


def _bucket_ranges(length: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, limit = None, [], 0, HELD_BYTES
        for b in batches:
            for bucket, payload, packed in zip(b.column("bucket").to_pylist(), b.column("payload"), b.column("bytes"), strict=True):
                if bucket < 0:
                    yield _rows(*_unpacked(payload.as_py(), _RANGES))
                    continue
                if bucket != now and held:
                    yield _rows(*solve_bucket(held, length, gram))
                    held, size, limit = [], 0, HELD_BYTES
                now = bucket
                held.append((_unpacked(payload.as_py()), packed.as_py()))
                size += int(held[-1][0][2].sum(dtype=np.int64)) + (length - 1) * len(held[-1][0][2])
                if size > limit:
                    part, gone = folded(held, length)
                    held, size = [part], len(part[1])
                    limit = max(HELD_BYTES, 2 * size)
                    if len(gone[0]):
                        yield _rows(*gone)
        if held:
            yield _rows(*solve_bucket(held, length, gram))

    return run


def ranges(docs: DataFrame, row: Column, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Byte ranges to remove: ``key``, ``row`` (as given) and ``gone``, a pair of 32-bit from and to (may overlap; a row a range)."""
    narrow = docs.select(_order(F.col(key)).alias("key"), row.alias("row"), F.col(text).cast("string").alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    gram = min(gram, length)
    sent = narrow.mapInArrow(_sent(buckets, length, gram), "bucket long, payload binary, bytes binary")
    dealt = sent.repartition(F.col("bucket")).sortWithinPartitions("bucket")
    return dealt.mapInArrow(_bucket_ranges(length, gram), "key long, row long, gone binary")


def _order(key: Column) -> Column:
    """The key by which documents follow one another: null keys come first."""
    return F.coalesce(key.cast("long"), F.lit(-(1 << 63)))


def _row(docs: DataFrame, key: str, text: str) -> Column:
    """What tells rows of one key apart: 0 where no key occurs twice (two numbers read the keys alone), else the text's hash."""
    k = docs.select(_order(F.col(key)).alias("k"))
    twice = k.groupBy("k").count().agg(F.max("count")).first()[0] or 0
    return F.xxhash64(F.col(text).cast("string")) if twice > 1 else F.lit(0).cast("long")


def _joined(docs: DataFrame, text: str, removed: DataFrame) -> DataFrame:
    """``docs`` (with ``of``, the ordered key, and ``row``) with their ranges, a list a row; a document has fewer ranges than bytes.

    Texts pass the shuffle compressed one by one.
    """
    kinds = [(f.name, "binary" if f.name == text else f.dataType.simpleString()) for f in docs.schema]
    packed = docs.mapInArrow(_deflated(text), ", ".join(f"`{c}` {k}" for c, k in kinds))
    per_doc = removed.groupBy("key", "row").agg(F.collect_list("gone").alias("gone")).withColumnsRenamed({"key": "__key", "row": "__row"})
    return packed.join(per_doc, (packed["of"] == per_doc["__key"]) & packed["row"].eqNullSafe(per_doc["__row"]), "left").drop("__key", "__row")


def _deflated(text: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            i = b.schema.names.index(text)
            cols = list(b.columns)
            cols[i] = pa.array([None if t is None else pack(t) for t in b.column(i).cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return run


def _inflated(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for whole in batches:
        i = whole.schema.names.index(text)
        for b in B.blocks([whole], text, B.BLOCK_BYTES // 2):  # compressed bytes
            cols = list(b.columns)
            cols[i] = pa.array([None if t is None else unpack(t) for t in b.column(i).to_pylist()], pa.large_binary())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)


def _stay(data: np.ndarray, offs: np.ndarray, gone: pa.Array) -> np.ndarray:
    """Which bytes stay, by a column of lists of packed ranges."""
    lists = gone.to_pylist()
    rows = [i for i, g in enumerate(lists) if g]
    if not rows:
        return np.ones(len(data), bool)
    packed = [b"".join(lists[i]) for i in rows]
    pairs = np.frombuffer(b"".join(packed), "<u4").reshape(-1, 2) + np.repeat(offs[rows], [len(p) // 8 for p in packed])[:, None]
    return ~B.covered(len(data), pairs[:, 0], pairs[:, 1])


def _digests(key: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _inflated(batches, "text"):
            data, offs = B.flat(b.column("text"))
            stay = _stay(data, offs, b.column("gone"))
            left = np.concatenate([[0], np.cumsum(stay)])[offs]
            kept = memoryview(data[stay])
            s, _, first = B.spans((~stay).astype(np.uint8), offs, np.arange(256) > 0)
            sha = [hashlib.sha256(kept[a:e]).hexdigest() for a, e in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)]
            size = np.diff(offs)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(size, pa.int64()), pa.array(size - np.diff(left), pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(sha, pa.string())], names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: key, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` of the bytes left."""
    row = _row(docs, key, text)
    narrow = docs.select(F.col(key).cast("long").alias("key"), _order(F.col(key)).alias("of"), row.alias("row"), F.col(text).cast("string").alias("text"))
    rows = _joined(narrow, "text", ranges(docs, row, key, text, length)).select("key", "text", "gone")
    return rows.mapInArrow(_digests(key), f"`{key}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, chars: str | None = None) -> DataFrame:
    """``docs`` without the removed bytes; a changed text with no visible character left is dropped.

    A character stays if one of its bytes stays, so texts remain valid
    UTF-8. Other columns are unchanged (``chars``, if named, gets the code
    points of a changed text).
    """
    kinds = docs.schema
    at, n_at = docs.columns.index(text), None if chars is None else docs.columns.index(chars)
    plain = docs.toDF(*(f"c{i}" for i in range(len(kinds))))
    k, t = f"c{docs.columns.index(key)}", f"c{at}"
    row = _row(plain, k, t)
    removed = ranges(plain, row, k, t, length)
    rows = _joined(plain.withColumns({"of": _order(F.col(k)), "row": row}), t, removed).drop("of", "row")
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kinds))
    return rows.mapInArrow(_cut(at, n_at), schema).select(*(F.col(f"c{i}").alias(f.name) for i, f in enumerate(kinds)))


def _cut(at: int, n_at: int | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _inflated(batches, f"c{at}"):
            data, offs = B.flat(b.column(at))
            stay = _stay(data, offs, b.column("gone"))
            cols, names = list(b.columns[:-1]), b.schema.names[:-1]
            cols[at] = cols[at].cast(pa.large_string())
            if not stay.all():
                heads = np.flatnonzero((data & 0xC0) != 0x80)
                size = np.diff(heads, append=len(data))
                stay = np.repeat(np.logical_or.reduceat(stay, heads), size)
                left = np.concatenate([[0], np.cumsum(stay)])[offs]
                seen = np.concatenate([[0], np.cumsum(B.VISIBLE[data] & stay)])[offs]
                touched = pa.array(np.diff(left) < np.diff(offs))
                texts = B.binary_rows(data[stay], left, pa.large_string())
                cols[at] = pc.if_else(touched, texts, cols[at])
                if n_at is not None:
                    cols[n_at] = pc.if_else(touched, pc.utf8_length(texts).cast(cols[n_at].type), cols[n_at])
                ok = pc.or_(pc.invert(touched), pa.array(np.diff(seen) > 0))
            else:
                ok = pa.array(np.ones(b.num_rows, bool))
            cols[at] = cols[at].cast(pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(ok)

    return run
