"""Whitening of embeddings by their principal components.

The components are fitted to distinct vectors, so that copies of one vector, however many, count once. Vectors become
whole numbers first; their sums are exact. Spark adds up the scatter of the centred vectors, one square matrix of the
vectors' dimension per task, in a tree of additions. Only that matrix reaches the driver, whose size depends on the
dimension and not on the number of rows. There a pivoted Cholesky factorisation ``M = G G'`` stops at the rank of the
scatter, and one-sided Jacobi rotations make the columns of ``G`` orthogonal to each other: their squared lengths are
the eigenvalues then, and their directions the components. Working on the factor and not on ``M`` keeps small
eigenvalues as exact as large ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import saved

COMPONENTS = 4
SCALE = 256
# Rows that a task takes into one matrix product.
_ROWS = 4096
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)
_TOP = float(1 << 63)


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n`` vectors with sums ``sums``, all eigenvalues that are not zero, and unit components as columns."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray

    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.eigenvalues.sum()

    def apply(self, x: np.ndarray, components: int) -> np.ndarray:
        """The whitened coordinates of the rows of ``x``."""
        return self.centred(x) @ (self.components[:, :components] / np.sqrt(self.eigenvalues[:components]))

    def centred(self, x: np.ndarray) -> np.ndarray:
        # What is whole is subtracted as whole numbers, so that a large mean costs no digits.
        whole = [s // self.n for s in self.sums]
        rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])
        if _spread(x, whole) < _TOP:
            return (x - np.array(whole, dtype=np.int64)).astype(np.float64) - rest
        return np.array([[float(v - w) for v, w in zip(row, whole, strict=True)] for row in x.tolist()]) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of ``(n * x - S)^2``, exact; null where one does not fit into 64 bits."""
        most = self.n * max((abs(int(v)) for v in (x.min(), x.max())), default=0) + max(map(abs, self.sums))
        if most * most * max(len(self.sums), 1) < 1 << 63:
            return ((x * self.n - np.array(self.sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist())
        return [d if d < 1 << 63 else None for d in exact]


def _spread(x: np.ndarray, whole: list[int]) -> float:
    return float(max(abs(int(x.min())), abs(int(x.max())))) + float(max(map(abs, whole))) if x.size else 0.0


def _quantised(column: pa.Array) -> list[bytes | None]:
    """Each vector as whole numbers, packed with as few bytes a number as the vector needs; null for a row to drop."""
    out: list[bytes | None] = []
    for value in column:
        vector = value.as_py()
        if vector is None or None in vector:
            out.append(None)
            continue
        c = np.array(vector, dtype=np.float64)
        if not np.isfinite(c).all():
            out.append(None)
            continue
        with np.errstate(over="ignore"):
            scaled = np.floor(c * SCALE)
        # A number beyond 64 bits becomes the nearest that fits.
        x = np.where(scaled >= _TOP, (1 << 63) - 1, np.where(scaled < -_TOP, -(1 << 63), np.clip(scaled, -_TOP, _TOP - 1024)).astype(np.int64))
        kind = next(w for w in _WIDTHS if x.size == 0 or (x.min() >= np.iinfo(w).min and x.max() <= np.iinfo(w).max))
        out.append(bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes())
    return out


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype=f"<i{packed[0]}", offset=1).astype(np.int64)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, dim, x`` of the rows whose vectors are whole: no null, nothing that is not finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = _quantised(batch.column("vector"))
            dims = [None if p is None else (len(p) - 1) // p[0] for p in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())], names=["vec_id", "dim", "x"]
            )

    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, "vec_id long, dim int, x binary").where("x is not null")


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        packed = batch.column("x").to_pylist()
        for at in range(0, len(packed), _ROWS):
            part = packed[at : at + _ROWS]
            yield np.array([_unpacked(p) for p in part], dtype=np.int64).reshape(len(part), dim)


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, dtype=np.int64), np.zeros(dim, dtype=np.int64)
        for x in _blocks(batches, dim):
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"]
        )

    totals = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    rows = fit.select("x").mapInArrow(run, "i int, n long, high long, low long").groupBy("i").agg(*totals).collect()
    rows = {r.i: r for r in rows}
    return int(rows[0].n) if rows else 0, [(int(rows[i].high) << 32) + int(rows[i].low) for i in range(dim)]


def _scatter(fit: DataFrame, dim: int, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of products of centred rows ``of(x)``, which are ``width`` numbers each.

    ``of`` centres by the known mean already. What rounding leaves of a mean is taken out as well: batches are centred
    by their own means, and merged by the distance of these.
    """

    def merged(a, b):
        (n, mean, m), (k, other, o) = a, b
        if n == 0 or k == 0:
            return b if n == 0 else a
        apart = other - mean
        return n + k, mean + apart * (k / (n + k)), m + o + np.outer(apart, apart) * (n * k / (n + k))

    empty = (0, np.zeros(width), np.zeros((width, width)))

    def packed(total) -> pa.RecordBatch:
        n, mean, m = total
        arrays = [pa.array([n], pa.int64()), pa.array([mean.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["n", "mean", "m"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = empty
        for x in _blocks(batches, dim):
            if len(x):
                y = of(x)
                mean = y.mean(axis=0)
                y = y - mean
                total = merged(total, (len(y), mean, y.T @ y))
        yield packed(total)

    def unpacked(n: int, mean: bytes, m: bytes):
        return n, np.frombuffer(mean), np.frombuffer(m).reshape(width, width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = empty
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = merged(total, unpacked(*row))
        yield packed(total)

    schema = "n long, mean binary, m binary"
    tasks = fit.rdd.getNumPartitions()
    sums = fit.select("x").mapInArrow(parts, schema)
    if tasks > 8:
        sums = sums.repartition(min(math.isqrt(tasks) + 1, 256)).mapInArrow(add, schema)
    total = empty
    for row in sums.collect():
        total = merged(total, unpacked(row.n, bytes(row.mean), bytes(row.m)))
    return total[2]


def pivoted_cholesky(m: np.ndarray) -> np.ndarray:
    """``G`` with as many columns as ``m`` has rank and ``G G' = m``, for a positive semidefinite matrix.

    The largest diagonal entry of what is left is the next pivot, so columns of noise come last and are cut off.
    """
    m = m.astype(np.float64).copy()
    dim = len(m)
    columns, left = [], np.diag(m).copy()
    floor = left.max(initial=0.0) * dim * np.finfo(np.float64).eps
    for _ in range(dim):
        pivot = int(np.argmax(left))
        if left[pivot] <= floor:
            break
        column = m[:, pivot].copy()
        for done in columns:
            column -= done * done[pivot]
        column /= math.sqrt(left[pivot])
        columns.append(column)
        left -= column**2
        # A pivot is spent, whatever rounding has left of it.
        left[pivot] = -np.inf
    return np.array(columns).T.reshape(dim, len(columns))


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``G G'`` from the largest to the smallest, and their unit eigenvectors as columns.

    Pairs of columns are rotated until all are orthogonal to each other. The pairs of a round share no column (a round
    robin), so a round is one step over arrays.
    """
    g = g.copy()
    size = g.shape[1]
    ring = np.arange(size + size % 2)
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            p, q = ring[:half], ring[half:][::-1]
            real = (p < size) & (q < size)
            p, q = p[real], q[real]
            a, b = g[:, p], g[:, q]
            alpha, beta, gamma = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            turn = np.abs(gamma) > np.finfo(np.float64).eps * np.sqrt(alpha * beta)
            if turn.any():
                turned = True
                safe = np.where(turn, gamma, 1.0)
                zeta = (beta - alpha) / (2.0 * safe)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                t = np.where(turn, t, 0.0)
                c = 1.0 / np.hypot(1.0, t)
                g[:, p], g[:, q] = c * a - c * t * b, c * t * a + c * b
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if not turned:
            break
    values = (g * g).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > 0]
    return values[order], g[:, order] / np.sqrt(values[order])


def fit_whitening(distinct: DataFrame, dim: int) -> Whitening:
    """Fit to a table of different vectors ``x`` of one dimension."""
    n, sums = _sums(distinct, dim)
    if n == 0 or dim == 0:
        return Whitening(0, sums, np.empty(0), np.empty((dim, 0)))
    start = Whitening(n, sums, np.empty(0), np.empty((dim, 0)))
    values, components = one_sided_jacobi(pivoted_cholesky(_scatter(distinct, dim, dim, start.centred)))
    return Whitening(n, sums, values / n, components)


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per vector and component.

    Vectors that are null, or hold a null or a number that is not finite, are left out, and so are vectors of another
    length than most have (of several lengths that are as frequent the greatest counts). A vector is multiplied by 256
    and rounded down; what does not fit into 64 bits becomes the nearest number that does. Rows that repeat an id or a
    vector, and null ids, are rows like others. There are no more components than the scatter has rank: none, and so
    no rows, for an empty table, for one distinct vector, and for vectors without entries. ``deviation`` is null where
    it needs more than 64 bits. Columns of other names are not looked at.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = saved(quantised(vectors, id_col, vector_col), "whitening-rows")
    lengths = rows.groupBy("dim").agg(F.count("*").alias("k")).orderBy(F.desc("k"), F.desc("dim")).limit(1).collect()
    dim = lengths[0].dim if lengths else 0
    rows = rows.where(F.col("dim") == dim)
    fit = saved(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, dim)
    kept = min(components, len(model.eigenvalues))
    if kept == 0:
        return vectors.sparkSession.createDataFrame([], schema)
    error = float(np.abs(_scatter(fit, dim, kept, lambda x: model.apply(x, kept)) / model.n - np.eye(kept)).max())
    explained = model.explained()[:kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                x = next(_blocks(iter([part]), dim))
                k = len(x)
                ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(k), kept)))
                deviations = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(k), kept)))
                arrays = [
                    ids,
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), k)),
                    pa.array(np.full(k * kept, model.n, dtype=np.int64)),
                    deviations,
                    pa.array(model.apply(x, kept).reshape(-1)),
                    pa.array(np.tile(explained, k)),
                    pa.array(np.full(k * kept, error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in schema.split(", ")])

    return rows.select("vec_id", "x").mapInArrow(run, schema)
