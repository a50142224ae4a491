"""Arrow text columns as flat byte buffers, and vectorised word and window hashes over them.

A batch of texts is one ``uint8`` array plus document offsets, so tokenising
and hashing cost a few array passes instead of a Python object per word.
Hashes are 64-bit, deterministic across processes and executors.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task (one longer text is handled alone).
BLOCK_BYTES = 2 << 20
HASHED_BYTES = 1 << 19

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (every output bit depends on every input bit)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit constants from a seed."""
    with np.errstate(over="ignore"):
        x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)
        return mix(x) | np.uint64(1)


def byte_set(pattern: Iterable[int]) -> np.ndarray:
    t = np.zeros(256, np.bool_)
    t[list(pattern)] = True
    return t


#: Word bytes of ``[^\x20\x09-\x0D]+``.
VISIBLE = ~byte_set([0x20, *range(0x09, 0x0E)])
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = byte_set([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Lower-cases A-Z, leaves every other byte.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def flat(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column (null: empty) and the offsets of its rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def blocks(batches: Iterable[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each (no row is split)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0)).astype(np.int64) + 16
        at = np.cumsum(size)
        first = 0
        while first < batch.num_rows:
            done = at[first - 1] if first else 0
            last = max(int(np.searchsorted(at, done + limit, "right")), first + 1)
            yield batch.slice(first, last - first)
            first = last


def spans(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as maximal runs of ``table`` bytes inside a row: starts, ends, and the first word of each row (n + 1)."""
    m = table[data]
    if not len(m):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    before = np.empty_like(m)
    before[0], before[1:] = False, m[:-1]
    before[offs[:-1][offs[:-1] < len(m)]] = False
    after = np.empty_like(m)
    after[-1], after[:-1] = False, m[1:]
    ends_at = offs[1:] - 1
    after[ends_at[ends_at >= 0]] = False
    starts = np.flatnonzero(m & ~before)
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of each byte span (not empty); about ``HASHED_BYTES`` at once, so memory does not follow the input.

    Each eight bytes are mixed with a key of their place before they are
    summed, so no two spans are bound to collide by their structure. Where
    equality decides a result, callers compare the bytes as well.
    """
    total = np.cumsum(ends - starts)
    if len(total) and total[-1] > 2 * HASHED_BYTES:
        cut = np.unique(np.append(np.searchsorted(total, np.arange(HASHED_BYTES, int(total[-1]), HASHED_BYTES)), len(total)))
        return np.concatenate([_span_hashes(data, starts[a:e], ends[a:e], seed) for a, e in zip([0, *cut[:-1]], cut, strict=True)])
    return _span_hashes(data, starts, ends, seed)


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    low, high = int(starts.min()), int(ends.max())
    near = np.zeros(high - low + 8, np.uint8)
    near[: high - low] = data[low:high]
    words = np.ndarray(len(near) - 7, "<u8", near, strides=(1,))  # the eight bytes from each place on
    size = ends - starts
    n = (size + 7) >> 3
    head = np.cumsum(n) - n
    nth = np.arange(int(n.sum())) - np.repeat(head, n)
    v = words[nth * 8 + np.repeat(starts - low, n)]
    last = head + n - 1
    v[last] &= np.uint64(0xFFFFFFFFFFFFFFFF) >> ((n * 8 - size).astype(np.uint64) << np.uint64(3))  # no byte after the span
    with np.errstate(over="ignore"):
        v ^= _place_keys(int(n.max()))[nth]
        h = np.add.reduceat(mix(v), head)
        return mix(h + size.astype(np.uint64) * np.uint64(_BASE) + np.uint64(seed))


@functools.lru_cache(maxsize=4)
def _keys(n: int) -> np.ndarray:
    return constants(7, n)


def _place_keys(n: int) -> np.ndarray:
    return _keys(1 << max(n - 1, 15).bit_length())


def equal_spans(data: np.ndarray, a: np.ndarray, a_end: np.ndarray, other: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether span i of ``data`` holds the same bytes as span i of ``other``; about ``HASHED_BYTES`` at once."""
    size = a_end - a
    out = size == b_end - b
    rows = np.flatnonzero(out & (size > 0))
    done = np.cumsum(size[rows])
    first = 0
    while first < len(rows):
        last = max(int(np.searchsorted(done, (done[first - 1] if first else 0) + HASHED_BYTES, "right")), first + 1)
        own = rows[first:last]
        n = size[own]
        same = data[ragged(a[own], n)] == other[ragged(b[own], n)]
        out[own] = np.logical_and.reduceat(same, np.cumsum(n) - n)
        first = last
    return out


def window_hashes(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each ``width`` consecutive items of a row: hashes, their first item, and the row of each."""
    count = np.maximum(np.diff(first) - (width - 1), 0)
    rows = np.repeat(np.arange(len(count)), count)
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + first[:-1][rows]
    if not len(at):
        return np.zeros(0, np.uint64), at, rows
    n = len(h) - width + 1
    with np.errstate(over="ignore"):
        g = h[:n].copy()
        for j in range(1, width):
            g ^= g >> np.uint64(29)
            g *= _M2
            g += h[j : n + j]
        return mix(g)[at], at, rows


def ragged(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + size[i] - 1`` of all i, one after the other."""
    return np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the (possibly overlapping) spans."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


def binary_rows(data: np.ndarray, offs: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Rows ``data[offs[i]:offs[i + 1]]`` as an Arrow binary (or text) column."""
    out = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offs) - 1, [None, pa.py_buffer(np.ascontiguousarray(offs, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )
    return out.cast(kind or pa.binary())
