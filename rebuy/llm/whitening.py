"""Whitening by pivoted Cholesky and one-sided Jacobi.

Vectors become integers, ``x = floor(1024 * c) + 100000``, so the count ``n``
and the sums ``S`` are exact. The scatter of the centred vectors is summed per
task, a row per pair of dimensions, and added up by Spark; ``d * (d + 1) / 2``
sums reach the driver whatever the number of vectors.

Pivoted Cholesky factors the scatter, largest remaining diagonal first, and
ends at the numerical rank. One-sided Jacobi then rotates columns of the
triangular factor against each other until all are orthogonal; the scatter of
the factor doesn't change by that. The squared norms of the rotated columns are
its eigenvalues and the normalised columns the components. Nothing squares the
factor's condition, so small eigenvalues keep their relative precision.

Vectors are centred before they are multiplied: ``whitened`` is
``(x - S / n) . u / sqrt(e)``, and the covariance of the result is taken from
centred sums again for ``identity_error``.

Defined cases: vectors that are null, empty, or hold null or non-finite entries
take no part. The dimension is the most frequent length (the larger one of
equally frequent ones); vectors of another length take no part. Repeated rows
count as often as they occur; ids may be null. There are no components beyond
the rank, so without two different vectors no rows come, and an empty table
gives none. ``deviation`` is null where it doesn't fit a long. Other columns
are ignored. Entries beyond ``LARGEST`` after scaling raise ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.common import pieces, stage_table

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Scaled entries up to here are exact as doubles, and so are their sums a batch as longs.
LARGEST = 1 << 48
ROWS = 8192
MAX_SWEEPS = 60


def finite_vectors(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``_id, x``: the vectors that hold numbers only, as longs."""
    v = vectors[vector].cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.filter(v.isNotNull() & (F.size(v) > 0) & finite).select(vectors[vec_id].alias("_id"), v.alias("v"))
    large = F.exists("v", lambda c: F.abs(c * scale) >= float(LARGEST))
    message = F.lit(f"an entry is beyond {LARGEST / scale}")
    x = F.when(large, F.raise_error(message)).otherwise(F.transform("v", lambda c: F.floor(c * scale).cast("long") + offset))
    return kept.select("_id", x.cast("array<long>").alias("x"))


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``l`` (rows in the order of ``a``, as many columns as the rank) with ``l @ l.T == a``."""
    d = len(a)
    l, rest, order = np.zeros((d, d)), np.diag(a).astype(float), np.arange(d)
    least = max(rest.max(initial=0.0), 0.0) * d * np.finfo(float).eps
    for j in range(d):
        p = j + int(np.argmax(rest[order[j:]]))
        if rest[order[p]] <= least:
            return l[:, :j]
        order[[j, p]] = order[[p, j]]
        pivot, below = order[j], order[j + 1 :]
        l[pivot, j] = np.sqrt(rest[pivot])
        l[below, j] = (a[below, pivot] - l[below, :j] @ l[pivot, :j]) / l[pivot, j]
        rest[below] -= l[below, j] ** 2
        rest[pivot] = 0.0
    return l


def one_sided_jacobi(l: np.ndarray) -> np.ndarray:
    """The columns of ``l`` rotated against each other until all are orthogonal, longest first."""
    g = l.copy()
    n, eps = g.shape[1], np.finfo(float).eps
    for _ in range(MAX_SWEEPS):
        turned = False
        for i in range(n - 1):
            for j in range(i + 1, n):
                a, b, c = g[:, i] @ g[:, i], g[:, j] @ g[:, j], g[:, i] @ g[:, j]
                if abs(c) <= 4 * eps * np.sqrt(a * b):
                    continue
                turned = True
                t = (b - a) / (2 * c)
                t = (1.0 if t >= 0 else -1.0) / (abs(t) + np.hypot(1.0, t))
                cos = 1 / np.hypot(1.0, t)
                sin = cos * t
                g[:, i], g[:, j] = cos * g[:, i] - sin * g[:, j], sin * g[:, i] + cos * g[:, j]
        if not turned:
            break
    return g[:, np.argsort(-(g**2).sum(0), kind="stable")]


@dataclass(frozen=True)
class Whitening:
    """The fit: count, exact sums per dimension, eigenvalues (falling) and components (a row each)."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _total(rows: DataFrame) -> tuple[int, list[int]]:
    """Count and exact sums per dimension of rows of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in pieces(batches, ROWS):
            if batch.num_rows:
                x = _matrix(batch.column(0), len(batch.column(0)[0]))
                part = [int(s) for s in x.sum(0)]
                n, sums = n + len(x), part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
        if sums is not None:
            columns = [pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "n", "s"])

    parts = rows.select("x").mapInArrow(run, "i int, n long, s decimal(38,0)")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()  # d rows
    return (int(found[0].n) if found else 0), [int(r.s) for r in found]


def _scatter(rows: DataFrame, mean: np.ndarray) -> np.ndarray:
    """Sum of the centred vectors' outer products."""
    centre = mean.tolist()
    d = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in pieces(batches, ROWS):
            x = _matrix(batch.column(0), d) - np.array(centre)
            total += x.T @ x
        i, j = np.triu_indices(d)
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "s"])

    parts = rows.select("x").mapInArrow(run, "i int, j int, s double")
    out = np.zeros((d, d))
    for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # d * (d + 1) / 2 rows
        out[r.i, r.j] = out[r.j, r.i] = r.s
    return out


def of_common_length(rows: DataFrame) -> DataFrame:
    """The rows with as many entries as most have."""
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.filter(F.size("x") == (most.d if most else 0))


def fit_whitening(rows: DataFrame) -> Whitening | None:
    """The whitening of rows ``x`` of one length; None without rows."""
    n, sums = _total(rows)
    if not n:
        return None
    scatter = _scatter(rows, np.array([s / n for s in sums]))
    g = one_sided_jacobi(pivoted_cholesky(scatter))
    norms = np.sqrt((g**2).sum(0))
    return Whitening(n, sums, norms**2 / n, (g / norms).T, float(np.trace(scatter)) / n)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of ``(n * x - S) ** 2`` of each row, exact; None beyond a long."""
    if n * int(np.abs(x).max(initial=0)) >= 2**62 or max(map(abs, sums)) >= 2**62:  # whole numbers of any size
        found = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
        return [v if v < 2**63 else None for v in found]
    off = np.abs(n * x - np.array(sums, np.int64))
    small = (off < 1 << 32).all(1)
    square = np.where(small[:, None], off, 0).astype(np.uint64) ** 2
    low, high = (square & np.uint64(0xFFFFFFFF)).sum(1), (square >> np.uint64(32)).sum(1)
    high += low >> np.uint64(32)
    fits = small & (high < 1 << 31)
    total = ((high << np.uint64(32)) | (low & np.uint64(0xFFFFFFFF))).tolist()
    return [v if ok else None for v, ok in zip(total, fits.tolist(), strict=True)]


def whiten(rows: DataFrame, fit: Whitening, components: int = COMPONENTS) -> DataFrame:
    """``_id, deviation, whitened`` (an array of the first components) of the rows."""
    k = min(components, len(fit.eigenvalues))
    n, sums, mean = fit.n, list(fit.sums), fit.mean.tolist()
    axes, roots = fit.components[:k].T.tolist(), np.sqrt(fit.eigenvalues[:k]).tolist()
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ROWS):
            x = _matrix(batch.column(1), d)
            deviation = _deviation(x, n, sums)
            white = (x - np.array(mean)) @ np.array(axes).reshape(d, k) / np.array(roots)
            offsets = np.arange(0, len(x) * k + 1, k) if k else np.zeros(len(x) + 1, np.int64)
            arrays = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), arrays], ["_id", "deviation", "whitened"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.select("_id", "x").mapInArrow(run, f"_id {kind}, deviation long, whitened array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    w = [F.col("whitened")[i] for i in range(k)]
    found = white.agg(*(F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()  # centred sums, merged by task
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))


def whitened(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``_id, component, n, deviation, whitened, explained, identity_error``: a row per vector and component."""
    rows = of_common_length(stage_table(finite_vectors(vectors, vec_id=vec_id, vector=vector), "op13_vectors"))
    fit = fit_whitening(rows)
    k = 0 if fit is None else min(components, len(fit.eigenvalues))
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        kind = rows.schema["_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"_id {kind}, {schema}")
    white = stage_table(whiten(rows, fit, components), "op13_white")
    explained = F.array(*(F.lit(float(e / fit.trace)) for e in fit.eigenvalues[:k]))
    return white.select("_id", "deviation", F.posexplode("whitened").alias("at", "w")).select(
        "_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        F.col("w").alias("whitened"),
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(identity_error(white, k)).alias("identity_error"),
    )
