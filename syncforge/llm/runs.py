"""Periodic runs of words, found on a Re-Pair grammar of the word ids.

A run is a stretch of consecutive words with smallest period q and at least
``max(6, 4 * q)`` words that no neighbouring word extends keeping that period.

The texts of a block share one grammar. Re-Pair replaces the most frequent
pair of neighbouring symbols by a new nonterminal until no pair occurs twice;
here a round replaces, next to the most frequent pair, every other pair that
does not touch a more frequent one, so a block needs few rounds. What is left
of a text is paired up to one symbol of balanced height. A run lies in the
expansion of a lowest node, and crosses the border of its two halves; so each
nonterminal is searched once, at its border, on its first occurrence, and what
is found is carried to all places that derive from it. A stretch cut off by
the end of its nonterminal lies in the longer one that a node above finds;
merging by period leaves the maximal ones.

At a border b, a period q is tried if the words at b - 1, b + q - 1 and
b + 2q - 1, and those at b and b + q, are equal (for the longer half on the
left: mirrored), as each run demands that has twice its period on the right.
Of several periods of one stretch the smallest counts, and a period whose
four-fold ends within a known stretch is a multiple of that one.

Null, empty and blank texts have no words and no runs. Rows are judged one by
one (ties, repeated rows and keys); an empty table gives an empty result. A
null key leaves the text as it is where keys decide on a change of the words.
Very long texts are taken whole, in a block of their own. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buffers as B

LEAST, FOLD = 6, 4
#: Bytes of text that share a grammar, and (border, period) pairs that are tried at once.
BLOCK_BYTES = 2 << 20
PAIRS = 1 << 21


# the grammar


class Grammar:
    """Nodes with the lengths of both halves and the first place of their expansion, and all places they derive to."""

    def __init__(self, words: np.ndarray, first: np.ndarray):
        """``words``: ids of all texts, one after the other; ``first``: the first word of each text (n + 1)."""
        self.n_symbols = int(words.max(initial=-1)) + 1
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.places: list[tuple[np.ndarray, np.ndarray]] = []  # node numbers and where they start
        self.n_nodes = 0
        at = np.arange(len(words))
        end_of = np.zeros(len(words) + 1, bool)
        end_of[first] = True  # no pair crosses from one text to the next
        known = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # pairs with a nonterminal
        symbol, size = words.astype(np.int64), np.ones(len(words), np.int64)
        symbol, at, size = self._repair(symbol, at, size, end_of, known)
        self._balance(at, size, end_of)

    def _add(self, node: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, new: np.ndarray) -> None:
        """Occurrences of nodes; ``new`` are the indices of those that are the first of a node not seen before, in order of the node."""
        self.left.append(left[new])
        self.right.append(right[new])
        self.first.append(at[new])
        self.places.append((node, at))
        self.n_nodes += len(new)

    def _repair(self, symbol, at, size, end_of, known):
        live = np.ones(max(len(symbol) - 1, 0), bool)  # pairs that may occur twice
        whole = True
        while True:
            start = np.flatnonzero(live & ~end_of[at[1:]]) if len(at) > 1 else np.zeros(0, np.int64)
            key = symbol[start].astype(np.uint64) << np.uint64(32) | symbol[start + 1].astype(np.uint64)
            kinds, back, count = np.unique(key, return_inverse=True, return_counts=True)
            twice = count[back] > 1
            if not twice.any():
                if whole:
                    return symbol, at, size
                live, whole = np.ones(len(symbol) - 1, bool), True  # once more over all pairs
                continue
            start, back = start[twice], back[twice]
            # more frequent pairs go first, equal ones by their symbols; of the same pair in a row every second one
            rank = np.empty(len(kinds), np.int64)
            rank[np.lexsort((kinds, -count))] = np.arange(len(kinds))
            own = rank[back]
            inf = len(kinds)
            before, after = np.full(len(own), inf), np.full(len(own), inf)
            touch = np.flatnonzero(start[1:] == start[:-1] + 1)
            before[touch + 1], after[touch] = own[touch], own[touch + 1]
            same = before == own
            lead = np.flatnonzero(~same)
            odd = np.arange(len(own)) - lead[np.cumsum(~same) - 1] & 1
            # a row of one pair (as in "a a a a") loses to a better pair on either side only at that side
            take = ((own < before) | same) & ((own < after) | (own == after)) & (odd == 0)
            take[1:] &= ~(take[:-1] & (start[1:] == start[:-1] + 1))
            i = start[take]
            pair = key[twice][take]
            node, new, known = self._numbers(pair, known)
            self._add(node, at[i], size[i], size[i + 1], new)
            symbol[i] = self.n_symbols + node
            size[i] += size[i + 1]
            stay = np.ones(len(symbol), bool)
            stay[i + 1] = False
            fresh = np.zeros(len(symbol), bool)
            fresh[i] = True
            again = np.zeros(len(symbol), bool)
            again[start] = True
            symbol, at, size, fresh, again = symbol[stay], at[stay], size[stay], fresh[stay], again[stay]
            live = (again | fresh)[:-1] | fresh[1:]
            whole = False

    def _numbers(self, pair, known):
        """Node of each pair, the places of new ones' first occurrence, and the table of pairs with them."""
        keys, nodes = known
        kinds, first, back = np.unique(pair, return_index=True, return_inverse=True)
        where = np.minimum(np.searchsorted(keys, kinds), max(len(keys) - 1, 0))
        old = keys[where] == kinds if len(keys) else np.zeros(len(kinds), bool)
        number = np.empty(len(kinds), np.int64)
        if old.any():
            number[old] = nodes[where[old]]
        number[~old] = self.n_nodes + np.arange(int((~old).sum()))
        all_keys = np.concatenate([keys, kinds[~old]])
        order = np.argsort(all_keys, kind="stable")
        return number[back], first[~old], (all_keys[order], np.concatenate([nodes, number[~old]])[order])

    def _balance(self, at, size, end_of) -> None:
        """Pairs the symbols that are left, text by text, level by level."""
        while len(at):
            starts = end_of[at]
            place = np.arange(len(at)) - np.flatnonzero(starts)[np.cumsum(starts) - 1]
            last = np.append(starts[1:], True)
            i = np.flatnonzero((place % 2 == 0) & ~last)
            if not len(i):
                return
            self._add(self.n_nodes + np.arange(len(i)), at[i], size[i], size[i + 1], np.arange(len(i)))
            size[i] += size[i + 1]
            stay = np.ones(len(at), bool)
            stay[i + 1] = False
            at, size = at[stay], size[stay]


# runs at the borders


def _reach(a: np.ndarray, i: int, j: int, most: int) -> int:
    """How many words from i on equal those from j on, at most ``most``."""
    got, step = 0, 64
    while got < most:
        n = min(step, most - got)
        off = a[i + got : i + got + n] != a[j + got : j + got + n]
        k = int(off.argmax())
        if off[k]:
            return got + k
        got, step = got + n, 4 * step
    return most


def _back(a: np.ndarray, i: int, j: int, most: int) -> int:
    """How many words up to i (it excluded) equal those up to j."""
    got, step = 0, 64
    while got < most:
        n = min(step, most - got)
        off = (a[i - got - n : i - got] != a[j - got - n : j - got])[::-1]
        k = int(off.argmax())
        if off[k]:
            return got + k
        got, step = got + n, 4 * step
    return most


def _same_ahead(z: np.ndarray) -> np.ndarray:
    """Of each place, how many words from there on equal the array's first words (the Z function)."""
    n = len(z)
    w = z.tolist()
    out = [0] * n
    if n:
        out[0] = n
    a = b = 0
    for i in range(1, n):
        k = min(b - i, out[i - a]) if i < b else 0
        while i + k < n and w[k] == w[i + k]:
            k += 1
        if i + k > b:
            a, b = i, i + k
        out[i] = k
    return np.array(out, np.int64)


def _border_runs(words: np.ndarray, low: int, border: int, high: int, right: np.ndarray, left: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches within [low, high) across the border, of the periods tried: (start, end, smallest period)."""
    found: dict[tuple[int, int], int] = {}
    for periods, ahead in ((right, True), (left, False)):
        if not len(periods):
            continue
        # where many periods are tried, matches are read from one pass over the half instead of compared one by one
        table = None
        if len(periods) > 64 and int(periods.sum()) > 16 * (high - low):
            table = _same_ahead(words[border:high] if ahead else words[low:border][::-1])
        done = 0
        for q in periods.tolist():
            if 2 * q <= done:
                continue  # lies in a stretch whose period divides q
            if ahead:
                on = int(table[q]) if table is not None else _reach(words, border, border + q, high - border - q)
                if on < q:
                    continue
                start, end = border - _back(words, border, border + q, border - low), border + q + on
                done = end - border
            else:
                on = int(table[q]) if table is not None else _back(words, border - q, border, border - q - low)
                if on < q:
                    continue
                start, end = border - q - on, border + _reach(words, border - q, border, high - border)
                done = border - start
            if start < border < end and end - start >= max(LEAST, FOLD * q):
                found[start, end] = min(q, found.get((start, end), q))
    return [(s, e, q) for (s, e), q in found.items()]


def _tried(words: np.ndarray, border: np.ndarray, half: np.ndarray, ahead: bool) -> tuple[np.ndarray, np.ndarray]:
    """(border number, period) that pass the first comparisons, periods rising for each border."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    done = np.cumsum(half)
    first = 0
    while first < len(half):
        last = max(int(np.searchsorted(done, (done[first - 1] if first else 0) + PAIRS, "right")), first + 1)
        n = half[first:last]
        node = np.repeat(np.arange(first, last), n)
        q = B.ragged(np.ones(len(n), np.int64), n)
        b = border[node]
        # the border's inner word, one and two periods on
        step = q if ahead else -q
        at = b - 1 if ahead else b
        ok = np.flatnonzero(words[at] == words[at + step])
        node, q, b, step, at = node[ok], q[ok], b[ok], step[ok], at[ok]
        ok = np.flatnonzero(words[at + step] == words[at + 2 * step])
        node, q, b, step = node[ok], q[ok], b[ok], step[ok]
        at = b if ahead else b - 1
        ok = np.flatnonzero(words[at] == words[at + step])
        node, q, b, step = node[ok], q[ok], b[ok], step[ok]
        at = b + step // 2 if ahead else b - 1 + step // 2
        ok = np.flatnonzero(words[at] == words[at + step])
        out.append((node[ok], q[ok]))
        first = last
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def runs_of(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of the texts: starts and ends (places in ``words``) and periods, by start, then period."""
    none = np.zeros(0, np.int64)
    g = Grammar(words, first)
    if not g.n_nodes:
        return none, none, none
    left, right, at = (np.concatenate(x) for x in (g.left, g.right, g.first))
    size = left + right
    node = np.flatnonzero(size >= LEAST)
    border = at[node] + left[node]
    tried = [_tried(words, border, right[node] // 2, True), _tried(words, border, left[node] // 2, False)]
    some = np.unique(np.concatenate([t[0] for t in tried]))
    span = [np.searchsorted(t[0], some, side) for t in tried for side in ("left", "right")]
    found: list[tuple[int, int, int, int]] = []
    for k, n in enumerate(some.tolist()):
        low = int(at[node[n]])
        here = _border_runs(words, low, int(border[n]), low + int(size[node[n]]), tried[0][1][span[0][k] : span[1][k]], tried[1][1][span[2][k] : span[3][k]])
        found.extend((int(node[n]), s - low, e - low, q) for s, e, q in here)
    if not found:
        return none, none, none
    owner, s, e, q = np.array(found, np.int64).T  # owners rise
    # to all places that derive from the owner
    nodes, places = (np.concatenate(x) for x in zip(*g.places, strict=True))
    has = np.zeros(g.n_nodes, bool)
    has[owner] = True
    keep = has[nodes]
    nodes, places = nodes[keep], places[keep]
    a, b = np.searchsorted(owner, nodes, "left"), np.searchsorted(owner, nodes, "right")
    which = B.ragged(a, b - a)
    moved = np.repeat(places, b - a)
    return _maximal(moved + s[which], moved + e[which], q[which])


def _maximal(s: np.ndarray, e: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each period, the stretches that lie in no other; of equal stretches the smallest period."""
    order = np.lexsort((-e, s, q))
    s, e, q = s[order], e[order], q[order]
    top = np.maximum.accumulate(e + q * (int(e.max()) + 1))  # a new period starts anew
    inside = np.append(False, (e + q * (int(e.max()) + 1))[1:] <= top[:-1])
    s, e, q = s[~inside], e[~inside], q[~inside]
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    again = np.append(False, (s[1:] == s[:-1]) & (e[1:] == e[:-1]))
    s, e, q = s[~again], e[~again], q[~again]
    order = np.lexsort((q, s))
    return s[order], e[order], q[order]


# the operator


def period_change(key: int | None, n: int) -> tuple[int, int] | None:
    """(a, p): from word a on, words repeat with period p; by the checksum of the key's digits, a tenth of the texts."""
    if key is None or n == 0:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _changed(keys: list[int | None], first: np.ndarray, change: Callable[[int | None, int], tuple[int, int] | None]) -> np.ndarray:
    """Index of the word that stands at each place."""
    index = np.arange(int(first[-1]))
    for i, (key, a, n) in enumerate(zip(keys, first[:-1].tolist(), np.diff(first).tolist(), strict=True)):
        if got := change(key, n):
            index[a + got[0] : a + n] = a + got[0] + np.arange(n - got[0]) % got[1]
    return index


def _ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words (by their bytes)."""
    if not len(starts):
        return np.zeros(0, np.int64)
    size = ends - starts
    each = B.binary_rows(data[B.ragged(starts, size)], np.concatenate([[0], np.cumsum(size)]), pa.large_binary())
    return np.asarray(pc.dictionary_encode(each).indices).astype(np.int64)


_COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _judged(key: str, change: Callable[[int | None, int], tuple[int, int] | None] | None, keep: tuple[str, ...]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.blocks(batches, "text", BLOCK_BYTES):
            data, offs = B.flat(b.column("text"))
            starts, ends, first = B.spans(data, offs, B.VISIBLE)
            index = _changed(b.column("key").to_pylist(), first, change) if change else np.arange(len(starts))
            words = _ids(data, starts, ends)[index]
            s, e, q = runs_of(words, first)
            doc = np.searchsorted(first, s, "right") - 1
            n_runs = np.bincount(doc, minlength=b.num_rows)
            from_, length = s - first[doc], e - s
            best = np.full(b.num_rows, -1)
            order = np.lexsort((q, s, -length, doc))
            lead = order[np.append(True, doc[order][1:] != doc[order][:-1])] if len(order) else order
            best[doc[lead]] = lead
            has = best >= 0

            def one(values: np.ndarray, best=best, has=has) -> pa.Array:
                out = np.zeros(len(best), np.int64)
                out[has] = values[best[has]]
                return pa.array(out, pa.int64(), mask=~has)

            made = {
                "n_runs": pa.array(n_runs, pa.int64()),
                "start": one(from_),
                "length": one(length),
                "period": one(q),
                "exponent_milli": one(1000 * length // np.maximum(q, 1)),
            }
            if "runs" in keep:
                rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (from_, length, q)], names=["start", "length", "period"])
                made["runs"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_runs)]), pa.int32()), rows)
            lines = [f"{x},{y},{z}\n" for x, y, z in zip(from_.tolist(), length.tolist(), q.tolist(), strict=True)]
            cut = np.concatenate([[0], np.cumsum(n_runs)]).tolist()
            made["runs_sha256"] = pa.array([hashlib.sha256("".join(lines[x:y]).encode()).hexdigest() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.string())
            stays = ~B.covered(len(words), s + q, e)
            kept = index[stays]
            size = ends[kept] - starts[kept] + 1  # with the space after it
            text = np.full(int(size.sum()), 0x20, np.uint8)
            at = np.cumsum(size) - size
            text[B.ragged(at, size - 1)] = data[B.ragged(starts[kept], size - 1)]
            left = np.concatenate([[0], np.cumsum(stays)])[first]
            ends_at = np.append(at, len(text))[left]
            raw = memoryview(text)
            spans = [(x, max(x, y - 1)) for x, y in zip(ends_at[:-1].tolist(), ends_at[1:].tolist(), strict=True)]
            made["collapsed_sha256"] = pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in spans], pa.string())
            if "collapsed" in keep:
                made["collapsed"] = pa.array([bytes(raw[x:y]).decode() for x, y in spans], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("key"), *made.values()], names=[key, *made])

    return run


def detect(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    change: Callable[[int | None, int], tuple[int, int] | None] | None = None,
    keep: tuple[str, ...] = ("runs", "collapsed"),
) -> DataFrame:
    """Per document: key, ``n_runs``, the longest run (``start``, ``length``, ``period``, ``exponent_milli``), digests, and the asked of ``runs``, ``collapsed``.

    ``collapsed`` is the text with each run cut to its first period, words
    joined by one space. ``change`` (key, number of words) may give (a, p):
    words from a on are then those of the first p words from a, again and
    again. One pass, no shuffle.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    more = {"runs": "runs array<struct<start:long,length:long,period:long>>", "collapsed": "collapsed string"}
    names, _, digests = _COLUMNS.partition(", runs_sha256")
    schema = ", ".join([f"`{key}` long", names, *([more["runs"]] if "runs" in keep else []), f"runs_sha256{digests}", *([more["collapsed"]] if "collapsed" in keep else [])])
    return rows.mapInArrow(_judged(key, change, tuple(keep)), schema)
