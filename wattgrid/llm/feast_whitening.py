"""Whitening of embeddings by FEAST contour integration.

Each entry ``c`` becomes the integer ``floor(64 * c) + 1000000``. Count and sums are exact, the
covariance is summed from centred vectors, all by partial results of one small matrix a task.

The eigenvectors come from the covariance ``V`` alone, a matrix of the number of dimensions. ``V`` is
brought to tridiagonal form; the inertia of that form at a shift counts the eigenvalues below it.
Counts place the ends of intervals in gaps of the spectrum. In every interval a block of
vectors is projected by quadrature of ``(zI - V)^-1 Y`` over a circle through its ends (complex shifted
solves), Rayleigh-Ritz on the projected block gives eigenvalues and eigenvectors, and the step
repeats until residuals vanish. The count of eigenvalues found must equal the count by inertia.

Defined results: rows whose vector is NULL, empty or of another length than most, or holds NULL, NaN,
infinite entries or entries beyond 2**46 (whose integers a double cannot hold), take no part; repeated rows count and
return each; a NULL id stays NULL. Components without variance cannot be whitened and are left
out, so a single vector, or an empty table, gives no rows. Equal eigenvalues may share their space in any basis.
``deviation`` is NULL where the exact sum does not fit a long.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import masked, place_of, ship, table

SCALE, SHIFT = 64, 1_000_000
LIMIT = 2.0 ** 46  # entries beyond it have integers that doubles cannot tell apart
COMPONENTS = 32
GROUP = 8  # eigenvalues that an interval is meant to hold
NODES = 16  # quadrature nodes on the upper half circle
TOLERANCE = 1e-16  # residual of an eigenvector, relative to the largest row sum, a dimension (64 at least)
SEED = 20240613
LONG = 2 ** 63 - 1
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---------------------------------------------------------------- eigenvectors of a covariance

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix orthogonally similar to ``v``."""
    a = np.array(v, np.float64)
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        x[0] += np.copysign(np.sqrt(x @ x), x[0])
        size = x @ x
        if size > 0:
            p = a[k + 1:, k + 1:] @ x * (2 / size)
            p -= x * (x @ p / size)
            a[k + 1:, k + 1:] -= np.outer(x, p) + np.outer(p, x)
            head = a[k + 1:, k] - x * (2 * (x @ a[k + 1:, k]) / size)
            a[k + 1:, k] = a[k, k + 1:] = head
    return np.diag(a).copy(), np.diag(a, 1).copy()


def inertia(tri: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues below each shift: negative pivots of the shifted matrix."""
    diag, off = tri
    tiny = np.finfo(float).tiny * 2 ** 60
    shifts = np.asarray(shifts, np.float64)
    pivot = diag[0] - shifts
    below = (pivot < 0).astype(np.int64)
    for d, o in zip(diag[1:], off):
        pivot = d - shifts - o * o / np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def intervals(tri: tuple[np.ndarray, np.ndarray], components: int) -> tuple[list[tuple[float, float, int]], int]:
    """Intervals (low, high, count), from the top, whose ends lie in gaps and that hold the
    ``components`` largest eigenvalues with variance, or all of them, if fewer; and how many these are."""
    diag, off = tri
    dim = len(diag)
    reach = np.abs(diag)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    top = reach.max() * (1 + 1e-12)
    rank = dim - int(inertia(tri, [top * dim * 1e-15])[0]) if top > 0 else 0
    want = min(components, rank)
    if not want:
        return [], 0
    # bisection, for all eigenvalues at once: the k-th largest lies between low[k] and high[k]
    low, high = np.full(dim, -top), np.full(dim, top * 1.01)
    place = np.arange(dim)
    for _ in range(48):
        mid = (low + high) / 2
        above = dim - inertia(tri, mid) > place
        low, high = np.where(above, mid, low), np.where(above, high, mid)
    value = (low + high) / 2
    gap = np.append(value[:-1] - value[1:], np.inf)  # under the k-th largest
    out, start, end = [], 0, top * 1.01
    while start < want:
        last = min(start + GROUP, want) - 1
        # the widest gap of the second half of the group; at the end, the first real gap at or after the last one
        if last < want - 1:
            last = max(range(start + GROUP // 2, last + 1), key=lambda i: gap[i])
        while gap[last] < top * 1e-11:
            last += 1
        under = value[last] - gap[last] / 2 if last < dim - 1 else min(value[last], 0.0) - top * 0.01
        out.append((under, end, last + 1 - start))
        start, end = last + 1, under
    return out, want


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``v`` between ``low`` and ``high``, falling, and their unit eigenvectors."""
    dim = len(v)
    size = min(dim, count + count // 2 + 4)
    y = np.random.default_rng(seed).standard_normal((dim, size))
    x, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (x + 1))
    middle, radius = (low + high) / 2, (high - low) / 2
    small_enough = TOLERANCE * max(dim, 64) * np.abs(v).sum(1).max()
    eye = np.eye(dim)
    for _ in range(40):
        q = np.zeros((dim, size))
        for z, w in zip(turn, weight):
            q += (w / 2) * (radius * z * np.linalg.solve((middle + radius * z) * eye - v, y.astype(complex))).real
        q, _ = np.linalg.qr(q)
        value, small = np.linalg.eigh(q.T @ v @ q)
        y = q @ small
        # the block is wider than the space looked for: its other directions may give values inside, but no eigenvectors
        error = np.sqrt(((v @ y - y * value) ** 2).sum(0))
        inside = np.flatnonzero((value > low) & (value < high) & (error <= small_enough))
        if len(inside) == count:
            order = inside[np.argsort(-value[inside])]
            return value[order], y[:, order]
    raise ArithmeticError(f"{len(inside)} eigenvalues found between {low} and {high}, {count} by inertia")


def top_eigenvectors(v: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance (none without variance) and unit eigenvectors, as columns."""
    v = (v + v.T) / 2
    values, vectors = [np.empty(0)], [np.empty((len(v), 0))]
    found, want = intervals(tridiagonal(v), components)
    for i, (low, high, count) in enumerate(found):
        e, u = feast(v, low, high, count, SEED + i)
        values.append(e)
        vectors.append(u)
    return np.concatenate(values)[:want], np.concatenate(vectors, axis=1)[:, :want]


# ---------------------------------------------------------------- passes over the rows

@dataclass
class Whitening:
    """Count, exact sums, and for each component its scaled direction and share of the variance."""
    n: int
    sums: list[int]
    turn: np.ndarray
    explained: np.ndarray
    identity_error: float = float("nan")

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole and remaining part of ``x - sums / n``: the second is below one and not negative."""
        return _centred(x, self.n, self.sums)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return x - np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)


def vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Usable rows ``_id``, ``_v`` (doubles) of the commonest length; no row leaves its place."""
    ship(rows.sparkSession)
    v = F.transform(F.col(place_of(rows, vec_col)), lambda x: x.cast("double"))
    fine = F.forall("_v", lambda x: x.isNotNull() & (F.abs(x) <= F.lit(LIMIT)) & ~F.isnan(x))
    ok = masked(rows).select(F.col(place_of(rows, id_col)).cast("long").alias("_id"), v.alias("_v")).filter(F.col("_v").isNotNull() & (F.size("_v") > 0) & fine)
    common = ok.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return ok.filter(F.size("_v") == (common["d"] if common else 0))


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            flat = np.asarray(b.column("_v").flatten(), np.float64).reshape(b.num_rows, -1)
            yield b, np.floor(flat * SCALE).astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for b, x in _integers(batches):
        wide = int(np.abs(x).max()) * len(x) > LONG
        part = (x.astype(object) if wide else x).sum(0)
        total = [int(p) + t for p, t in zip(part, total or [0] * x.shape[1])]
        n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                                          pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["d", "n", "s"])


def _products(n: int, sums: list[int], turn: np.ndarray | None = None):
    """Partial sums of products of centred vectors, turned by ``turn`` if given: the upper triangle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _integers(batches):
            whole, rest = _centred(x, n, sums)
            c = whole - rest / n
            c = c if turn is None else c @ turn
            total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])
    return run


def _matrix(rows: DataFrame, n: int, sums: list[int], turn: np.ndarray | None, dim: int) -> np.ndarray:
    """Covariance of the centred (and turned) vectors, divisor ``n``."""
    found = rows.mapInArrow(_products(n, sums, turn), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((dim, dim))
    for r in found.collect():  # of the size of one matrix, whatever the rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"] / n
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the usable ``rows`` (see ``vectors``), with its error measured; None without variance."""
    found = rows.mapInArrow(_sums, "d int, n long, s decimal(38,0)").groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d").collect()
    if not found:
        return None
    n, sums = found[0]["n"], [int(r["s"]) for r in found]
    v = _matrix(rows, n, sums, None, len(sums))
    e, u = top_eigenvectors(v, components)
    if not len(e):
        return None
    turn = u / np.sqrt(e)
    error = np.abs(_matrix(rows, n, sums, turn, len(e)) - np.eye(len(e))).max()
    return Whitening(n, sums, turn, e / np.trace(v), float(error))


def _deviations(whole: np.ndarray, rest: np.ndarray, n: int) -> pa.Array:
    """Exact sums over the dimensions of ``(n * x - sums) ** 2``."""
    most = n * (int(np.abs(whole).max()) + 1)
    if most * most * whole.shape[1] <= LONG:
        return pa.array(((whole * n - rest) ** 2).sum(1), pa.int64())
    exact = ((whole.astype(object) * n - rest.astype(object)) ** 2).sum(1)
    return pa.array([int(d) if d <= LONG else None for d in exact], pa.int64())


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` of usable ``rows``."""
    k = len(model.explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _integers(batches):
            whole, rest = model.parts(x)
            rows_of = pa.array(np.repeat(np.arange(len(x)), k))
            w = (whole - rest / model.n) @ model.turn
            m = len(x) * k
            yield pa.RecordBatch.from_arrays([
                b.column("_id").take(rows_of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(m, model.n)),
                _deviations(whole, rest, model.n).take(rows_of), pa.array(w.ravel()), pa.array(np.tile(model.explained, len(x))),
                pa.array(np.full(m, model.identity_error))], names=[c.split()[0] for c in SCHEMA.split(", ")])
    return rows.mapInArrow(run, SCHEMA)


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector of ``embeddings``, whitened, in up to 32 components."""
    rows = vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    model = fit(rows)
    return spark.createDataFrame([], SCHEMA) if model is None else whiten(rows, model)
