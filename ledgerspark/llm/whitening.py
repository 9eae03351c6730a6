"""Whitening of vectors: principal components by a randomised range finder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize

#: Components given at most.
COMPONENTS = 8
#: Columns of the sketch beyond the components.
OVERSAMPLING = 8
#: Passes over all rows before the residuals must have settled.
PASSES = 4
#: A component's residual against the largest eigenvalue.
TOLERANCE = 1e-13
#: Eigenvalues below this share of the largest are none.
NOTHING = 1e-12
#: Entries become whole numbers: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Rows of an Arrow batch that are multiplied at once.
ROWS = 4096
_SEED = 13


def whole_numbers(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """The other columns as ``row`` and the vector's entries as ``y``, floor(SCALE * entry) without SHIFT.

    Rows go whose vector is null, holds null, NaN or an infinity, or has another number
    of entries than most of the others (of lengths as frequent, the longest counts).
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    y = F.transform(v, lambda c: F.floor(c * SCALE).cast("long"))
    others = F.struct(*[F.col(f"`{c}`") for c in vectors.columns if c != vector_col])
    rows = materialize(vectors.select(others.alias("row"), F.when(v.isNotNull() & finite, y).alias("y")).where("y is not null"), "vectors")
    usual = rows.groupBy(F.size("y").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    return rows.where(F.size("y") == (usual.n if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """A batch of lists of one length as a matrix."""
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def _summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str) -> list:
    """``of`` every batch's matrix of whole numbers, flattened and added up over all rows.

    A task adds up its batches and sends one array; the arrays are added by position, so
    what moves has the size of the result for each task, whatever the rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(0, len(batch), ROWS):
                part = of(_matrix(batch.column(0).slice(i, ROWS))).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64() if kind == "long" else pa.float64()))], names=["sums"])

    parts = rows.select("y").mapInArrow(work, f"sums array<{kind}>").select(F.posexplode("sums").alias("at", "v"))
    exact = F.col("v").cast("decimal(38,0)") if kind == "long" else F.col("v")
    return [r.v for r in parts.groupBy("at").agg(F.sum(exact).alias("v")).orderBy("at").collect()]


@dataclass(frozen=True)
class Whitening:
    """Count and sums of the fitted whole numbers, and their components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    full: bool
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([t / self.n for t in self.sums])

    def __call__(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows of a matrix of whole numbers."""
        return (y - self.mean) @ (self.directions / np.sqrt(self.eigenvalues))


def _ritz(q: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, directions and residuals that the range of ``q`` has of V, with ``z = V q``."""
    b = q.T @ z
    e, g = np.linalg.eigh((b + b.T) / 2)
    e, g = e[::-1], g[:, ::-1]
    u = q @ g
    return e, u, np.linalg.norm(z @ g - u * e, axis=0)


def fit(rows: DataFrame, components: int = COMPONENTS, oversampling: int = OVERSAMPLING, passes: int = PASSES) -> Whitening | None:
    """Components of whole_numbers(); None without rows or entries.

    The first pass counts and sums in whole numbers. Each later one multiplies V, the
    covariance of the centred rows, with an orthonormal basis, at first a random one of
    ``components + oversampling`` columns; its image is the next basis, and the
    Rayleigh-Ritz step in the last basis gives components with their residuals. Where
    these have not settled after ``passes``, one more pass takes the basis of all
    dimensions, for which the step is exact. The driver and each task hold matrices of
    the dimension at most, never rows.
    """
    counted = _summed(rows, lambda y: np.concatenate([[len(y)], (y >> 32).sum(axis=0), (y & 0xFFFFFFFF).sum(axis=0)]), "long")
    d = len(counted) // 2
    if not d:
        return None
    n, sums = int(counted[0]), tuple((int(hi) << 32) + int(lo) for hi, lo in zip(counted[1 : d + 1], counted[d + 1 :], strict=True))
    mean = np.array([t / n for t in sums])
    trace = sum(_summed(rows, lambda y: np.square(y - mean).sum(axis=0), "double")) / n
    if trace == 0:
        return Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), trace, False)

    def image(q: np.ndarray) -> np.ndarray:
        def of(y: np.ndarray) -> np.ndarray:
            x = y - mean
            return x.T @ (x @ q)

        return np.array(_summed(rows, of, "double")).reshape(d, -1) / n

    wide, full = components + oversampling, False
    if wide < d:
        q = np.linalg.qr(np.random.default_rng(_SEED).normal(size=(d, wide)))[0]
        for k in range(passes + 1):
            z = image(q)
            if k < passes:
                q = np.linalg.qr(z)[0]
        e, u, residuals = _ritz(q, z)
        full = bool((residuals[:components] > TOLERANCE * e[0]).any())
    if wide >= d or full:
        full = True
        e, u, _ = _ritz(np.eye(d), image(np.eye(d)))
    have = int((e[:components] > NOTHING * e[0]).sum())
    u = u[:, :have]
    u = u * np.where(u[np.abs(u).argmax(axis=0), np.arange(have)] < 0, -1.0, 1.0)  # the largest entry is positive
    return Whitening(n, sums, u, e[:have], trace, full)


def _deviations(y: np.ndarray, model: Whitening) -> list[Decimal | None]:
    """Each row's sum of (n * y - sum)**2, exactly; null beyond 38 digits."""
    if max(int(y.max()), -int(y.min())) * model.n < 1 << 48 and max(map(abs, model.sums)) < 1 << 48:
        v = np.abs(model.n * y - np.array(model.sums, dtype=np.int64))
        hi, lo = v >> 24, v & 0xFFFFFF
        sums = zip(*((a * b).sum(axis=1).tolist() for a, b in ((hi, hi), (hi, lo), (lo, lo))), strict=True)
        exact = [(a << 48) + (b << 25) + c for a, b, c in sums]
    else:
        exact = [sum((model.n * v - t) ** 2 for v, t in zip(row, model.sums, strict=True)) for row in y.tolist()]
    return [Decimal(x) if x < 10**38 else None for x in exact]


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, from one pass over them."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0
    sums = np.array(_summed(rows, lambda y: np.concatenate([(w := model(y)).sum(axis=0), (w.T @ w).ravel()]), "double"))
    mean = sums[:k] / model.n
    return float(np.abs(sums[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """``row, deviation decimal(38,0), whitened array<double>`` of every row of whole_numbers()."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                y = _matrix(batch.column(1))
                w = model(y)
                ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * w.shape[1])
                cols = [batch.column(0), pa.array(_deviations(y, model), pa.decimal128(38, 0)), pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(w).ravel()))]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "deviation", "whitened"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(work, f"row {kind}, deviation decimal(38,0), whitened array<double>")


def whiten(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """The vectors' rows with their whitened components, and the model.

    ``row`` (the other columns under any name), ``deviation`` (sum over dimensions of
    (n * x - sum)**2, exact) and ``whitened``, one value a component; see whole_numbers()
    for the rows that go and fit() for the method. Rows that repeat count as often as they
    occur. Where all rows are equal, or the table is empty, there are no components, and
    fewer than asked for where the rows span fewer dimensions.
    """
    rows = whole_numbers(vectors, vector_col)
    model = fit(rows, components)
    if model is None:
        kind = rows.schema["row"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"row {kind}, deviation decimal(38,0), whitened array<double>"), None
    model = replace(model, identity_error=identity_error(rows, model))
    return transform(rows, model), model
