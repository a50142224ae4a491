"""Tokenising texts by their distinct chunks.

A chunk starts at an ASCII space or line break that is followed by a
character that is surely no white space. The pre-token pattern never matches
across such a place, so the ids of a text are the ids of its chunks, one
after the other. Each distinct chunk of a block is encoded once, and a
bounded cache keeps the ids of chunks for the next blocks of the task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import buffers as B

#: Chunks after which the cache starts anew (with short ids about 50 MB; several workers share an executor).
CACHE_CHUNKS = 600_000
#: Bytes of new chunks that are encoded as one text.
JOINED_BYTES = 4096

_SPACE = B.byte_set([0x20, 0x0A])
# ASCII but controls and space; first bytes of characters above U+007F but those of Unicode white space
_SOLID = B.byte_set([*range(0x21, 0x7F), *(b for b in range(0xC3, 0xF5) if b not in (0xE1, 0xE2, 0xE3))])


def chunk_starts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the chunks of all rows, and the first chunk of each row (n + 1)."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        cut[: len(data) - 1] = _SPACE[data[:-1]] & _SOLID[data[1:]]
        ends = offs[1:-1]
        cut[ends[ends > 0] - 1] = False  # a row's last byte has no follower
        cut[offs[:-1]] = True
        cut[len(data)] = False
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, offs)


class ChunkEncoder:
    """Encodes blocks of texts with ``encode(list of texts) -> ids of all, one after the other``, called for new chunks only.

    New chunks are joined to longer texts for that; ``token_bytes`` (bytes of
    each token) tells which ids are whose. The cache is an open-addressing table over arrays: hash of a chunk to its
    number, the ids of chunk i are ``ids[at[i]:at[i + 1]]``, and its bytes ``raw[raw_at[i]:raw_at[i + 1]]``. A chunk
    takes ids from the cache only if its bytes are the same; a chunk that shares its hash with another is encoded alone.
    """

    def __init__(self, encode: Callable[[list[str]], np.ndarray], token_bytes: np.ndarray, limit: int = CACHE_CHUNKS):
        self.encode, self.token_bytes, self.limit = encode, token_bytes, limit
        self._clear(1 << 16)

    def _clear(self, size: int) -> None:
        self.mask = np.uint64(size - 1)
        self.key, self.number = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        self.count, self.ids, self.at = 0, np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.raw, self.raw_at = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.int64)

    def _probe(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the chunks, -1 for new ones."""
        out = np.full(len(h), -1, np.int32)
        live, place = np.arange(len(h)), h & self.mask
        while len(live):
            number = self.number[place]
            same = (number >= 0) & (self.key[place] == h[live])
            out[live[same]] = number[same]
            on = (number >= 0) & ~same
            live, place = live[on], (place[on] + np.uint64(1)) & self.mask
        return out

    def _insert(self, h: np.ndarray, numbers: np.ndarray) -> None:
        live, place = np.arange(len(h)), h & self.mask
        while len(live):
            free = self.number[place] < 0
            self.number[place[free]] = numbers[live[free]]  # of several for one place the last stays
            won = free & (self.number[place] == numbers[live])
            self.key[place[won]] = h[live[won]]
            live, place = live[~won], (place[~won] + np.uint64(1)) & self.mask

    def _add(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> None:
        # a chunk that does not start like one between others is encoded alone
        last = len(data) - 1
        inner = (size > 1) & _SPACE[data[starts]] & _SOLID[data[np.minimum(starts + 1, last)]]
        order = np.argsort(inner, kind="stable")
        h, starts, size, inner = h[order], starts[order], size[order], inner[order]
        joined = data[B.ragged(starts, size)]
        ends = np.cumsum(size)
        group = np.where(inner, ends // JOINED_BYTES, -np.arange(1, len(h) + 1))
        cut = np.append(ends[:-1][group[1:] != group[:-1]], ends[-1]).tolist()
        raw = joined.tobytes()
        ids = self.encode([raw[a:b].decode() for a, b in zip([0, *cut[:-1]], cut, strict=True)])
        after = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends, "right")
        own, size = size, np.diff(after, prepend=0)
        if self.count and self.count + len(h) > self.limit:
            self._clear(1 << 16)
        if 2 * (self.count + len(h)) > len(self.key):
            old = self.key[self.number >= 0], self.number[self.number >= 0]
            places = 1 << int(2 * (self.count + len(h))).bit_length()
            self.mask, self.key, self.number = np.uint64(places - 1), np.zeros(places, np.uint64), np.full(places, -1, np.int32)
            self._insert(*old)
        end = self.count + len(h)
        for name, least in (("ids", int(self.at[self.count]) + len(ids)), ("at", end + 1), ("raw", int(self.raw_at[self.count]) + len(joined)), ("raw_at", end + 1)):
            a = getattr(self, name)
            if least > len(a):
                setattr(self, name, np.concatenate([a, np.zeros(max(least - len(a), len(a) // 2), a.dtype)]))
        self.at[self.count + 1 : end + 1] = self.at[self.count] + np.cumsum(size)
        self.ids[self.at[self.count] : self.at[end]] = ids
        self.raw_at[self.count + 1 : end + 1] = self.raw_at[self.count] + np.cumsum(own)
        self.raw[self.raw_at[self.count] : self.raw_at[end]] = joined
        self._insert(h, np.arange(self.count, end, dtype=np.int32))
        self.count = end

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the offsets of each row in them."""
        starts, first = chunk_starts(data, offs)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        ends = np.append(starts[1:], len(data))
        h = B.span_hashes(data, starts, ends, seed=3)
        slot = self._probe(h)
        if (slot < 0).any():
            h_new, one = np.unique(h[slot < 0], return_index=True)
            one = np.flatnonzero(slot < 0)[one]
            if self.count + len(h_new) > self.limit:  # the cache starts anew: all chunks of the block are new
                h_new, one = np.unique(h, return_index=True)
            self._add(h_new, data, starts[one], ends[one] - starts[one])
            slot = self._probe(h)
        size = self.at[slot + 1] - self.at[slot]
        out = self.ids[B.ragged(self.at[slot], size)]
        other = np.flatnonzero(~B.equal_spans(data, starts, ends, self.raw, self.raw_at[slot], self.raw_at[slot + 1]))
        if len(other):
            own = [self.encode([data[a:e].tobytes().decode()]) for a, e in zip(starts[other].tolist(), ends[other].tolist(), strict=True)]
            pieces = np.split(out, np.cumsum(size)[:-1])
            for i, ids in zip(other.tolist(), own, strict=True):
                pieces[i], size[i] = ids.astype(np.uint32), len(ids)
            out = np.concatenate(pieces)
        return out, np.concatenate([[0], np.cumsum(size)])[first]
