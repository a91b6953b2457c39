"""Whitening of embeddings by shifted CholeskyQR over distributed Gram passes.

Each entry ``c`` becomes the integer ``floor(1024 * c) + 100000``; sums per
dimension are exact.  Rows are centred exactly (integer part and remainder of
the mean) before any product.  A pass over the rows gives the Gram matrix of the
centred rows times the inverse of the R found so far (a triangular solve per
block).  The first Gram matrix gets the shift of shifted CholeskyQR, so its
Cholesky factor exists whatever the condition; later passes orthogonalise what
is left, and the factors multiply to R.  The SVD of R gives the components and
their variances: singular values of R are as accurate as those of the rows
themselves, where the eigenvalues of one Gram matrix would lose half the digits.
The last Gram matrix enters by its symmetric root, so rows that span fewer
dimensions than they have give right components too.

Tasks sum their rows' Gram matrix first; the matrices are added up by a grouped
aggregate over their entries, and only one matrix (dimension squared, at most
``MAX_DIMS`` squared numbers) reaches the driver.  No row does.

Defined results: rows whose vector is null or holds a null, a NaN or an infinite
entry are left out, and so are entries beyond 2**40 (they have no exact sums);
all vectors have the most common length (of equally common ones the largest),
rows of other lengths lie in no common space and are left out; a null id is kept
as it is; repeated rows give repeated rows; components of equal variance are any
basis, the same for all rows; a component without variance has ``whitened`` null
and ``explained`` 0 (null if no component has any); an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resale.llm.common import written

SCALE, OFFSET = 1024.0, 100_000
COMPONENTS = 8
#: Entries that have exact integer sums.
LARGEST = float(1 << 40)
#: Largest dimension whose Gram matrix one machine holds.
MAX_DIMS = 4096
#: Most factors; two make orthogonal columns of well conditioned rows, rows without full rank use all.
MAX_PASSES = 5
#: Columns count as orthogonal when no entry of their Gram matrix is further from the identity (the rest is in its root).
ORTHOGONAL = 1e-10
#: A Cholesky factor with a smaller diagonal entry is not to be divided by: its matrix gets the shift.
WEAK = 1e-4
#: Share of the largest variance below which a component has none.
RANK = 1e-20
#: Entries worked on at once.
BLOCK = 1 << 20


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))


def fixed_point(batches: Iterator[pa.RecordBatch], dims: int | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, matrix of fixed-point entries) of the usable rows, block by block, vectors of one length (or of the given one) at a time."""
    for b in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(b.column("vec")), 0), np.int64)
        step = max(1, BLOCK // max(1, int(sizes.max(initial=0))))
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            for rows, x in _matrices(part.column("vec")):
                if dims is None or x.shape[1] == dims:
                    yield part.column("vec_id").take(pa.array(rows)), x


def _matrices(arr: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    lengths = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(arr), -1))
    values = arr.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)  # of the vectors that are not null
    sizes = np.maximum(lengths, 0)
    begins = np.cumsum(sizes) - sizes
    bad = np.r_[0, np.cumsum(~(np.abs(values) <= LARGEST))]
    usable = (lengths >= 0) & (bad[begins + sizes] == bad[begins])
    out = []
    for d in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == d))
        picked = values[begins[rows][:, None] + np.arange(d)[None, :]]
        out.append((rows, np.floor(picked * SCALE).astype(np.int64) + OFFSET))
    return out


@dataclass
class Centre:
    """Exact number of rows and sums per dimension."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s % self.n for s in self.sums]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, with one rounding per entry."""
        return (x - self.whole) - np.array(self.rest, np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n*x - S)**2, exact."""
        t = x - self.whole  # n*x - S = n*t - rest
        d, top = len(self.sums), int(np.abs(t).max(initial=0))
        if d * top * max(top, self.n) < 1 << 62:
            squares, mixed = (t * t).sum(axis=1).tolist(), (t @ np.array(self.rest, np.int64)).tolist()
        else:
            wide = t.astype(object)
            squares, mixed = (wide * wide).sum(axis=1).tolist(), (wide * np.array(self.rest, object)).sum(axis=1).tolist()
        own = sum(r * r for r in self.rest)
        return [self.n * self.n * a - 2 * self.n * b + own for a, b in zip(squares, mixed)]


def centre(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> Centre | None:
    """Count and sums of the vectors of the most common length; None if there are none (or they have no entry)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for _, x in fixed_point(batches):
            d = x.shape[1]
            totals[d] = totals.get(d, 0) + np.r_[len(x), x.sum(axis=0)]  # first the number of vectors, at -1
        for d, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * (d + 1), pa.int64()), pa.array(np.arange(-1, d)), pa.array(total)], ["dims", "at", "total"])

    sums = _vectors(df, id_col, vec_col).mapInArrow(step, "dims long, at long, total long").groupBy("dims", "at").agg(F.sum("total").alias("total"))
    sums = written(sums, "vector-sums")
    most = sums.where("at = -1").orderBy(F.desc("total"), F.desc("dims")).first()
    if most is None or most.dims == 0:
        return None
    if most.dims > MAX_DIMS:
        raise ValueError(f"vectors of more than {MAX_DIMS} dimensions")
    return Centre(most.total, [r.total for r in sums.where((F.col("dims") == most.dims) & (F.col("at") >= 0)).orderBy("at").collect()])  # a row per dimension


def _upper_solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows @ inverse(r) for an upper triangular r, column block by column block."""
    out = rows.copy()
    d, step = len(r), 32
    for at in range(0, d, step):
        end = min(d, at + step)
        if at:
            out[:, at:end] -= out[:, :at] @ r[:at, at:end]
        out[:, at:end] = np.linalg.solve(r[at:end, at:end].T, out[:, at:end].T).T
    return out


def gram(df: DataFrame, c: Centre, factors: list[np.ndarray], project: np.ndarray | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> np.ndarray:
    """Gram matrix of the centred rows after the triangular solves (or after a projection), with their sums in the last row."""
    d = len(c.sums)
    width = d if project is None else project.shape[1]
    at = np.triu_indices(width)
    number = (at[0] * width + at[1]).astype(np.int64)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((width, width)), np.zeros(width)
        for _, x in fixed_point(batches, d):
            y = c.centred(x)
            for r in factors:
                y = _upper_solve(y, r)
            if project is not None:
                y = y @ project
            total += y.T @ y
            sums += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[number, np.arange(width) - width]), pa.array(np.r_[total[at], sums])], ["at", "value"])

    parts = _vectors(df, id_col, vec_col).mapInArrow(step, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros((width + 1, width))
    for r in parts.collect():  # entries of one matrix
        if r["at"] < 0:
            out[width, r["at"] + width] = r["value"]
        else:
            i, j = divmod(r["at"], width)
            out[i, j] = out[j, i] = r["value"]
    return out


def _shift(n: int, d: int, size: float) -> float:
    """Shift of shifted CholeskyQR for n x d rows of squared norm ``size``."""
    return 11.0 * (float(n) * d + d * (d + 1)) * (np.finfo(float).eps / 2) * size


def _factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper Cholesky factor of a Gram matrix, with the shift if it is asked for or needed."""
    d = len(g)
    if not shifted:
        try:
            r = np.linalg.cholesky(g).T
            if np.diag(r).min() >= WEAK:
                return r
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(g + _shift(n, d, float(np.linalg.norm(g, 2))) * np.eye(d)).T


def triangular(df: DataFrame, c: Centre, id_col: str = "vec_id", vec_col: str = "embedding") -> np.ndarray:
    """R with R'R = A'A for the centred rows A: the Cholesky factors of all passes, and the root of the last Gram matrix."""
    d = len(c.sums)
    factors: list[np.ndarray] = []
    g = gram(df, c, factors, None, id_col, vec_col)[:d]
    if not g.any():
        return g
    while len(factors) < MAX_PASSES and (not factors or np.abs(g - np.eye(d)).max() > ORTHOGONAL):
        factors.append(_factor(g, c.n, shifted=not factors))
        g = gram(df, c, factors, None, id_col, vec_col)[:d]
    values, vectors = np.linalg.eigh(g)
    out = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
    for r in reversed(factors):
        out = out @ r
    return out


@dataclass
class Whitening:
    """Components (columns), their variances and all variance, and how far whitened rows are from an identity covariance."""

    centre: Centre
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def has_variance(self) -> np.ndarray:
        return self.variances > RANK * max(self.variances.max(initial=0), 1e-300)

    def projection(self) -> np.ndarray:
        return self.components[:, self.has_variance] / np.sqrt(self.variances[self.has_variance])


def fit(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> Whitening | None:
    """Fit on all usable rows; None if there are none."""
    c = centre(df, id_col, vec_col)
    if c is None:
        return None
    _, s, v = np.linalg.svd(triangular(df, c, id_col, vec_col))
    variances = s * s / c.n
    out = Whitening(c, v[:components].T, variances[:components], float(variances.sum()), None)
    p = out.projection()
    if p.shape[1]:
        g = gram(df, c, [], p, id_col, vec_col) / c.n
        k = p.shape[1]
        out.identity_error = float(np.abs(g[:k] - np.outer(g[k], g[k]) - np.eye(k)).max())
    return out


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def transform(df: DataFrame, w: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row per usable row and component.

    ``deviation_exact`` is the exact deviation; ``deviation`` is the same as a
    long, null where it does not fit one (``deviation_exact`` is null beyond 38 digits).
    """
    rows = _vectors(df, id_col, vec_col)
    if w is None:
        return df.sparkSession.createDataFrame([], SCHEMA)
    d, k = len(w.centre.sums), w.components.shape[1]
    some = w.has_variance
    projection = w.projection()
    explained = [float(v / w.trace) if w.trace > 0 else None for v in np.where(some, w.variances, 0)]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in fixed_point(batches, d):
            m = len(x)
            white = np.zeros((m, k))
            white[:, some] = w.centre.centred(x) @ projection
            dev = w.centre.deviations(x)
            again = pa.array(np.repeat(np.arange(m), k))
            longs = pa.array([v if v < 1 << 63 else None for v in dev], pa.int64())
            exact = pa.array([Decimal(v) if v < 10**38 else None for v in dev], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.centre.n)), longs.take(again),
                    pa.array(white.ravel(), mask=np.tile(~some, m)), pa.array(explained * m, pa.float64()), pa.array([w.identity_error] * (m * k), pa.float64()), exact.take(again),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
            )

    return rows.mapInArrow(step, SCHEMA)
