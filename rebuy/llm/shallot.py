"""Exact k-means with Shallot search.

Vectors become integers, ``floor(64 * x)``, and centroids stay integer vectors
(componentwise ``floor(sum / count)``), so every distance that decides anything
is an exact 64-bit sum of squares and ties go to the smaller centroid number.

*Search.* A row carries its centroid, the one that was second nearest, an upper
bound on the distance to the first and a lower bound on that to all others.
Bounds follow the centroids' moves. Where the upper one lies below the lower
one, or below half the way from the centroid to its next neighbour, nothing
changes. Else the upper bound is made exact, and if that isn't enough the row
starts from the closer one of its two centroids and goes through that one's
neighbours in order of their distance; the search ball shrinks with every
nearer centroid found, and the walk ends when the next neighbour lies outside
it, as nothing beyond can be nearer than the second found. Bounds are doubles
with a margin and only ever leave out; survivors are compared in integers.

*Rounds.* Each round is one narrow pass that writes the rows with their bounds
to the shared folder, so a lost executor repeats its own partitions only. The
sums of a round come from the same table: a task gives one row per centroid and
component, Spark adds them up, and ``k`` times ``d`` sums reach the driver. No
row is shuffled until the final sums of distances, a row per centroid a task.

Defined cases: vectors that are null, have another number of components, or
hold null or non-finite ones take no part. Repeated rows count as often as they
occur. The first centroids are the vectors with the smallest hashes; a null id
comes last there, equal hashes go by the vector, and rows that repeat both give
a centroid each. With fewer than ``k`` vectors there are as many centroids; an
empty table gives no rows. A centroid without vectors stays where it is. Other
columns are ignored. Components beyond ``LARGEST`` after scaling raise
``ValueError``, as a squared distance might not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.common import pieces, stage_table

DIM, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Scaled components up to here have exact squared distances in 64 bits.
LARGEST = 1 << 27
#: Share by which bounds are widened, far above the rounding of a square root.
MARGIN = 1e-12

_STATE = "_id {id}, x array<int>, cluster int, second int, upper double, lower double"


def scaled(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``_id, x``: the vectors that take part, as integers."""
    v = vectors[vector].cast("array<double>")
    fit = F.size(v) == dim
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.filter(v.isNotNull() & fit & finite).select(vectors[vec_id].alias("_id"), v.alias("v"))
    large = F.exists("v", lambda c: F.abs(c * scale) >= float(LARGEST))
    message = F.lit(f"a component is beyond {LARGEST / scale}")
    checked = F.when(large, F.raise_error(message)).otherwise(F.transform("v", lambda c: F.floor(c * scale).cast("int")))
    return kept.select("_id", checked.cast("array<int>").alias("x"))


def first_centroids(rows: DataFrame, k: int = CLUSTERS, seed: str = "1") -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of ``seed:id``, in the order of their hashes."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256)
    found = rows.select(order.alias("o"), "x").orderBy(F.asc_nulls_last("o"), "x").limit(k).collect()
    return np.array([r.x for r in found], np.int64)


class Centres:
    """The centroids of a round: their neighbours by distance, and how far each moved."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None) -> None:
        self.at = now
        k = len(now)
        apart = np.sqrt(((now[:, None, :] - now[None, :, :]) ** 2).sum(2).astype(float)) * (1 - MARGIN)
        np.fill_diagonal(apart, -1.0)
        self.neighbours = np.argsort(apart, axis=1, kind="stable")[:, 1:].astype(np.int64)
        np.fill_diagonal(apart, 0.0)
        self.apart = np.take_along_axis(apart, self.neighbours, axis=1)
        self.half = self.apart[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if before is None else np.sqrt(((now - before) ** 2).sum(1).astype(float)) * (1 + MARGIN)
        self.moved = moved
        # The farthest move of any other centroid.
        self.others = np.array([np.delete(moved, c).max() if k > 1 else 0.0 for c in range(k)])


def _squared(x: np.ndarray, centres: Centres, which: np.ndarray) -> np.ndarray:
    return ((x - centres.at[which]) ** 2).sum(1)


def assign(x: np.ndarray, centres: Centres, state: tuple[np.ndarray, ...] | None) -> tuple[tuple[np.ndarray, ...], int]:
    """``(cluster, second, upper, lower)`` of the rows, and how many distances were taken."""
    n, k = len(x), len(centres.at)
    taken = 0
    if state is None:
        first, second = np.zeros(n, np.int64), np.full(n, min(1, k - 1), np.int64)
        upper, lower = np.full(n, np.inf), np.zeros(n)
    else:
        first, second, upper, lower = (s.copy() for s in state)
        upper += centres.moved[first]
        lower -= centres.others[first]
    if k == 1:
        return (first, first.copy(), upper, np.full(n, np.inf)), taken
    # A row stays if its bound is strictly below both; a tie is looked at.
    open_ = np.flatnonzero(upper >= np.maximum(lower, centres.half[first]))
    exact = _squared(x[open_], centres, first[open_])
    taken += len(open_)
    upper[open_] = np.sqrt(exact) * (1 + MARGIN)
    left = upper[open_] >= np.maximum(lower[open_], centres.half[first[open_]])
    rows, near = open_[left], exact[left]
    if not len(rows):
        return (first, second, upper, lower), taken
    v, best, next_ = x[rows], first[rows], second[rows]
    far = _squared(v, centres, next_)
    taken += len(rows)
    closer = (far < near) | ((far == near) & (next_ < best))
    best, next_ = np.where(closer, next_, best), np.where(closer, best, next_)
    near, far = np.where(closer, far, near), np.where(closer, near, far)
    middle, reach, begun = best.copy(), np.sqrt(near) * (1 + MARGIN), next_.copy()
    inside = np.arange(len(rows))
    for step in range(k - 1):
        # Beyond the ball, a centroid is farther than the second nearest found.
        ball = reach[inside] + np.sqrt(far[inside]) * (1 + MARGIN)
        inside = inside[centres.apart[middle[inside], step] <= ball]
        if not len(inside):
            break
        other = centres.neighbours[middle[inside], step]
        new = other != begun[inside]
        at, other = inside[new], other[new]
        d = _squared(v[at], centres, other)
        taken += len(at)
        wins = (d < near[at]) | ((d == near[at]) & (other < best[at]))
        seconds = ~wins & ((d < far[at]) | ((d == far[at]) & (other < next_[at])))
        w, s = at[wins], at[seconds]
        next_[w], far[w] = best[w], near[w]
        best[w], near[w] = other[wins], d[wins]
        next_[s], far[s] = other[seconds], d[seconds]
    first[rows], second[rows] = best, next_
    upper[rows], lower[rows] = np.sqrt(near) * (1 + MARGIN), np.sqrt(far) * (1 - MARGIN)
    return (first, second, upper, lower), taken


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _assigned(rows: DataFrame, now: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """The rows with centroids and bounds of this round; ``rows`` are those of the last one (or have no bounds yet)."""
    shape = now.shape
    values, old = now.tolist(), None if before is None else before.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = Centres(np.array(values, np.int64), None if old is None else np.array(old, np.int64))
        for batch in pieces(batches, 8192):
            x = _matrix(batch.column(1), shape[1])
            state = None if old is None else tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6))
            if state is not None:
                state = (state[0].astype(np.int64), state[1].astype(np.int64), *state[2:])
            (first, second, upper, lower), _ = assign(x, centres, state)
            columns = [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(upper), pa.array(lower)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["_id", "x", "cluster", "second", "upper", "lower"])

    return rows.mapInArrow(run, _STATE.format(id=rows.schema["_id"].dataType.simpleString()))


def _new_centroids(rows: DataFrame, now: np.ndarray) -> np.ndarray:
    """Componentwise ``floor(sum / count)`` of each centroid's rows; one without rows stays."""
    k, dim = now.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in pieces(batches, 8192):
            cluster, x = batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
            counts += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                sums[c] += x[cluster == c].sum(0)
        for c in np.flatnonzero(counts):
            columns = [np.full(dim, c), np.arange(dim), np.full(dim, counts[c]), sums[c]]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], ["c", "i", "n", "s"])

    parts = rows.select("cluster", "x").mapInArrow(run, "c long, i long, n long, s long")
    exact = parts.select("c", "i", *(F.col(name).cast("decimal(28,0)").alias(name) for name in ("n", "s")))
    out = now.copy()
    for r in exact.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():  # k * d rows
        out[r.c, r.i] = int(r.s) // int(r.n)
    return out


def clusters(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", dim: int = DIM, scale: int = SCALE,
             k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "1") -> tuple[DataFrame, np.ndarray]:
    """``_id, x, cluster, distance`` of every vector that takes part, and the centroids (``k`` times ``dim``)."""
    rows = stage_table(scaled(vectors, vec_id=vec_id, vector=vector, dim=dim, scale=scale), "op12_vectors")
    now, before = first_centroids(rows, k, seed), None
    if not len(now):
        return rows.select("_id", "x", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), now
    for _ in range(rounds):
        rows = stage_table(_assigned(rows, now, before), "op12_rows")
        before, now = now, _new_centroids(rows, now)
    rows = _assigned(rows, now, before)
    values = now.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = np.array(values, np.int64)
        for batch in pieces(batches, 8192):
            x, cluster = _matrix(batch.column(1), centres.shape[1]), batch.column(2)
            distance = ((x - centres[cluster.to_numpy()]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cluster, pa.array(distance)], ["_id", "x", "cluster", "distance"])

    kind = rows.schema["_id"].dataType.simpleString()
    final = rows.select("_id", "x", "cluster").mapInArrow(run, f"_id {kind}, x array<int>, cluster int, distance long")
    return stage_table(final, "op12_assigned"), now


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``, which come from a table of a row a centroid."""
    if not len(centroids):
        return rows.select("*", *(F.lit(0).cast("long").alias(name) for name in ("cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256"))
    sums = {r.cluster: r.s for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(sums.values())
    per = [(c, sums.get(c, 0), total, centroid_digest(centroid)) for c, centroid in enumerate(centroids)]
    names = rows.sparkSession.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(names), "cluster")  # as many rows as centroids
