"""Whitening of embeddings by spectrum slicing of their covariance.

Entries become whole numbers, ``floor(64 * entry)``; the fit list is each
distinct vector once. Tasks sum its vectors and their products exactly, as
whole numbers, so the covariance (centred, divisor n) is rounded once, and
does not depend on how rows were dealt. Only these sums, bounded by the square
of the dimension, reach the driver.

There the leading eigenvalues are isolated by slicing: the LDL^T factors of
``V - shift`` have as many positive pivots as V has eigenvalues above the
shift, so bisection finds an interval that holds the k-th alone. Rayleigh
quotient iteration then converges cubically, and the counts at the interval's
ends certify that the result is the k-th. Eigenvalues too close to part are
found together, by inverse iteration on a block.

Rows whose vector is null, empty, or holds null or non-finite entries have no
result; of several lengths the one that most distinct vectors have counts (a
tie: the greatest), and the others have no result. Entries beyond 2^52 are
held at that bound. Repeated rows and keys and null keys are rows like others.
Components without variance cannot be whitened and are left out, so a fit list
of fewer than two vectors, like an empty table, gives no row. A ``deviation``
beyond 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import buffers as B
from .staging import settled

COMPONENTS = 16
#: Rows of a matrix that is held at once, by its width: about this many entries.
HELD_ENTRIES = 1 << 20
#: Eigenvalues closer than this share of the greatest are found together.
CLUSTER = 1e-12
_SCALE, _BOUND = 64.0, float(1 << 52)
_KINDS = (np.dtype("<i1"), np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))


# whole-number vectors as short byte strings


def entries(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of lists: which rows count, the offsets of those rows, and their whole numbers one after the other."""
    size = np.asarray(pc.fill_null(pc.list_value_length(col), 0)).astype(np.int64)
    flat = pc.list_flatten(col)
    values = np.asarray(pc.fill_null(flat, float("nan")), np.float64)
    ends = np.cumsum(size)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (size > 0) & (bad[ends] == bad[ends - size])
    whole = np.clip(np.floor(values[np.repeat(good, size)] * _SCALE), -_BOUND, _BOUND).astype(np.int64)
    return good, np.concatenate([[0], np.cumsum(size[good])]), whole


def pack(offs: np.ndarray, whole: np.ndarray) -> pa.Array:
    """One byte string a vector: the narrowest integers that hold it, after a byte that names their width."""
    size = np.diff(offs)
    if not len(size):
        return pa.array([], pa.binary())
    most = np.maximum.reduceat(np.where(whole < 0, ~whole, whole), offs[:-1])
    kind = (most > 0x7F).astype(np.int64) + (most > 0x7FFF) + (most > 0x7FFFFFFF)
    starts = np.cumsum(1 + (size << kind)) - (1 + (size << kind))
    data = np.empty(int((1 + (size << kind)).sum()), np.uint8)
    data[starts] = kind
    for k, t in enumerate(_KINDS):
        rows = np.flatnonzero(kind == k)
        if len(rows):
            raw = whole[B.ragged(offs[rows], size[rows])].astype(t).view(np.uint8)
            data[B.ragged(starts[rows] + 1, size[rows] << k)] = raw
    return B.binary_rows(data, np.append(starts, len(data)))


def unpack(col: pa.Array, dim: int) -> np.ndarray:
    """The vectors as rows of whole numbers."""
    data, offs = B.flat(col)
    out = np.empty((len(offs) - 1, dim), np.int64)
    kind = data[offs[:-1]]
    for k, t in enumerate(_KINDS):
        rows = np.flatnonzero(kind == k)
        if len(rows):
            raw = data[B.ragged(offs[rows] + 1, np.full(len(rows), dim << k))]
            out[rows] = raw.view(t).reshape(len(rows), dim)
    return out


def _codes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        good, offs, whole = entries(b.column("v"))
        yield pa.RecordBatch.from_arrays([pa.array(np.diff(offs).astype(np.int32)), pack(offs, whole)], names=["dim", "code"])


def distinct_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``dim``, ``code`` of each distinct vector: equal ones meet first in their own task, so a hot vector is a row a task."""
    return vectors.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(_codes, "dim int, code binary").distinct()


# exact sums


def products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` in exact whole numbers, as Python integers."""
    dim = y.shape[1]
    total = np.zeros((dim, dim), object)
    most = int(max(np.abs(y).max(initial=0), 1))
    rows = (1 << 53) // (most * most)  # so many products sum up exactly in doubles
    if rows == 0:
        return y.astype(object).T @ y.astype(object)
    for at in range(0, len(y), rows):
        part = y[at : at + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _sums(dim: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        step = max(1, HELD_ENTRIES // dim)
        for b in batches:
            for at in range(0, b.num_rows, step):
                y = unpack(b.column("code").slice(at, step), dim)
                n += len(y)
                sums += np.array([sum(c) for c in y.T.tolist()], object) if np.abs(y).max(initial=0) > 1 << 30 else y.sum(axis=0).astype(object)
                squares += products(y)
        if n:
            i, j = np.triu_indices(dim)
            kind = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([[-1], np.full(dim, -1), i]), pa.int32()),
                    pa.array(np.concatenate([[-1], np.arange(dim), j]), pa.int32()),
                    pa.array(map(Decimal, [n, *sums.tolist(), *squares[i, j].tolist()]), kind),
                ],
                names=["i", "j", "v"],
            )

    return run


@dataclass(frozen=True)
class Moments:
    """Exact sums over the fit list, of whole numbers without the constant that the covariance does not see."""

    n: int
    sums: list[int]
    covariance: np.ndarray

    @classmethod
    def of(cls, fit: DataFrame, dim: int) -> Moments:
        rows = fit.mapInArrow(_sums(dim), "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        v = {(r["i"], r["j"]): int(r["v"]) for r in rows}
        n, sums = v[-1, -1], [v[-1, j] for j in range(dim)]
        cov = np.empty((dim, dim))
        for i in range(dim):
            for j in range(i, dim):
                cov[i, j] = cov[j, i] = (n * v[i, j] - sums[i] * sums[j]) / (n * n)  # whole numbers: rounded once
        return cls(n, sums, cov)


# eigenvalues


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix lie above the shift: positive pivots of LDL^T with 1x1 and 2x2 pivots."""
    a = v - shift * np.eye(len(v))
    n, k, positive = len(a), 0, 0
    alpha = (1 + 17**0.5) / 8
    while k < n:
        below = np.abs(a[k + 1 :, k])
        most = below.max(initial=0.0)
        two = False
        if most > 0 and abs(a[k, k]) < alpha * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            other = row.max()
            if abs(a[k, k]) * other < alpha * most * most:
                two = abs(a[r, r]) < alpha * other
                to = k + two
                if to != r:
                    a[[to, r]] = a[[r, to]]
                    a[:, [to, r]] = a[:, [r, to]]
        if two:  # its determinant is negative: one eigenvalue on either side
            positive += 1
            e, c = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(e, c.T)
            k += 2
        else:
            d = a[k, k]
            positive += bool(d > 0)
            if d != 0:
                c = a[k + 1 :, k]
                a[k + 1 :, k + 1 :] -= np.outer(c / d, c)
            k += 1
    return positive


def _solve(a: np.ndarray, shift: float, x: np.ndarray, size: float) -> np.ndarray:
    """``(a - shift)^-1 x``; an exactly singular matrix is moved by a rounding error."""
    for move in (0.0, 4.0, 64.0, 1024.0):
        try:
            y = np.linalg.solve(a - (shift + move * np.finfo(float).eps * size) * np.eye(len(a)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    return x


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues (falling) and their unit eigenvectors (columns); only those that are positive beyond rounding."""
    size = float(np.abs(v).sum(axis=1).max(initial=0.0))
    none = len(v) * np.finfo(float).eps * size
    k = min(k, above(v, none) if size > 0 else 0)
    found, vectors = [], np.zeros((len(v), 0))
    counts: dict[float, int] = {none: above(v, none), size * (1 + 1e-9): 0}
    rnd = np.random.default_rng(13)

    def count(at: float) -> int:
        if at not in counts:
            counts[at] = above(v, at)
        return counts[at]

    while len(found) < k:
        number = len(found) + 1
        low = max(x for x, c in counts.items() if c >= number)
        high = min(x for x, c in counts.items() if c < number)
        while (count(low) > number or count(high) < number - 1) and high - low > CLUSTER * size:
            middle = (low + high) / 2
            if count(middle) >= number:
                low = middle
            else:
                high = middle
        many = count(low) - len(found)
        if many > 1:  # too close to part
            block = rnd.standard_normal((len(v), many))
            for _ in range(4):
                block -= vectors @ (vectors.T @ block)
                block = np.linalg.qr(_solve(v, (low + high) / 2, block, size))[0]
            block = np.linalg.qr(block - vectors @ (vectors.T @ block))[0]
            own, turn = np.linalg.eigh(block.T @ v @ block)
            own, block = own[::-1][: k - len(found)], (block @ turn[:, ::-1])[:, : k - len(found)]
            found.extend(own.tolist())
            vectors = np.hstack([vectors, block])
            continue
        while True:
            x = rnd.standard_normal(len(v))
            for _ in range(2):  # towards the eigenvector next to the interval's middle
                x = _solve(v, (low + high) / 2, x, size)
                x /= np.linalg.norm(x)
            value = float(x @ v @ x)
            for _ in range(12):
                off = np.linalg.norm(v @ x - value * x)
                if off <= 4 * np.finfo(float).eps * size:
                    break
                x = _solve(v, value, x, size)
                x /= np.linalg.norm(x)
                value = float(x @ v @ x)
            off = float(np.linalg.norm(v @ x - value * x))
            if low - off <= value <= high + off and off <= 1e-11 * size:  # the counts say that this is the one
                break
            if high - low <= np.finfo(float).eps * size:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) >= number else (low, middle)
        x -= vectors @ (vectors.T @ x)
        x /= np.linalg.norm(x)
        found.append(float(x @ v @ x))
        vectors = np.hstack([vectors, x[:, None]])
    return np.array(found), vectors


# the operator


@dataclass(frozen=True)
class Model:
    dim: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def centred(self, y: np.ndarray) -> np.ndarray:
        """``n * y - sums``: whole numbers, as Python integers only where 64 bits do not hold them."""
        most = int(np.abs(y).max(initial=0)) * self.n + max(map(abs, self.sums))
        if most < 1 << 62:
            return y * np.int64(self.n) - np.array(self.sums, np.int64)
        return y.astype(object) * self.n - np.array(self.sums, object)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ (self.vectors / np.sqrt(self.values))


def _spread(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        n, sums, squares = 0, np.zeros(k), np.zeros((k, k))
        step = max(1, HELD_ENTRIES // model.dim)
        for b in batches:
            for at in range(0, b.num_rows, step):
                z = model.whiten(model.centred(unpack(b.column("code").slice(at, step), model.dim)))
                n += len(z)
                sums += z.sum(axis=0)
                squares += z.T @ z
        if n:
            i, j = np.triu_indices(k)
            at = np.concatenate([np.full(k, -1), i]), np.concatenate([np.arange(k), j])
            yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(np.concatenate([sums, squares[i, j]]))], names=["i", "j", "v"])

    return run


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Model | None:
    """The model of a table of vectors; None if nothing varies in it."""
    table = settled(distinct_vectors(vectors, vector))
    sizes = [(r["n"], r["dim"]) for r in table.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()]
    if not sizes:
        return None
    n, dim = sizes[0]
    fits = table.where(F.col("dim") == dim).select("code")
    m = Moments.of(fits, dim)
    values, axes = leading(m.covariance, components)
    if not len(values):
        return None
    model = Model(dim, m.n, tuple(m.sums), values, axes, float(np.trace(m.covariance)))
    seen = {(r["i"], r["j"]): r["v"] for r in fits.mapInArrow(_spread(model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    error = max(abs(seen[i, j] / n - seen[-1, i] / n * (seen[-1, j] / n) - (i == j)) for i in range(len(values)) for j in range(i, len(values)))
    return Model(dim, m.n, tuple(m.sums), values, axes, model.trace, float(error))


def _deviation(centred: np.ndarray) -> pa.Array:
    most = int(np.abs(centred).max(initial=0))
    if most * most * centred.shape[1] < 1 << 63:
        return pa.array((centred.astype(np.int64) ** 2).sum(axis=1), pa.int64())
    exact = (centred.astype(object) ** 2).sum(axis=1).tolist()
    return pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())


def _whitened(model: Model, key: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    k = len(model.values)
    share = model.values / model.trace

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, HELD_ENTRIES // model.dim)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                good, offs, y = entries(b.column("v"))
                rows = np.flatnonzero(good)[np.diff(offs) == model.dim]
                y = y[np.repeat(np.diff(offs) == model.dim, np.diff(offs))].reshape(len(rows), model.dim)
                centred = model.centred(y)
                each = np.repeat(np.arange(len(rows)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("key").take(pa.array(rows[each])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(each), model.n)),
                        _deviation(centred).take(pa.array(each)),
                        pa.array(model.whiten(centred).reshape(-1)),
                        pa.array(np.tile(share, len(rows))),
                        pa.array(np.full(len(each), model.identity_error)),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(vectors: DataFrame, model: Model | None = None, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: key, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Without a model one is fitted on the same table. One pass, no shuffle;
    the model (dimension times components) goes with the tasks.
    """
    model = fit(vectors, vector, components) if model is None else model
    schema = f"`{key}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    if model is None:
        return rows.where("false").selectExpr(f"key AS `{key}`", "0 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error")
    return rows.mapInArrow(_whitened(model, key), schema)
