"""Clustering against plain k-means, and whitening against an eigenvalue solver."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from rebuy.llm.registry import QUERIES
from rebuy.llm.shallot import Centres, assign, centroid_digest, clusters, with_inertia
from rebuy.llm.whitening import LARGEST, finite_vectors, fit_whitening, one_sided_jacobi, pivoted_cholesky, whitened

SF = "/root/testdata/sf0.01"
ODD = [(5000, None), (5001, []), (5002, [float("nan")] + [1.0] * 63), (5003, [float("-inf")] + [1.0] * 63), (5004, [None] + [1.0] * 63)]


def frame(spark, rows, element="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{element}>")
    for name in ("_id", "x", "cluster", "second", "upper", "n", "whitened"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def plain_kmeans(rows, k=16, rounds=3):
    """``(cluster, distance)`` of every vector and the centroids, by all distances in whole numbers."""
    kept = [(i, [math.floor(64 * float(np.float64(c))) for c in v]) for i, v in rows if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    hashed = sorted((i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept)
    centroids = np.array([x for _, _, x in hashed[:k]], dtype=object)
    x = np.array([v for _, v in kept], dtype=object)

    def nearest():
        d = np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)
        return [min(range(len(centroids)), key=lambda c: (row[c], c)) for row in d], d

    for _ in range(rounds):
        which, _ = nearest()
        for c in set(which):
            members = x[[w == c for w in which]]
            centroids[c] = [int(s) // len(members) for s in members.sum(0)]
    which, d = nearest()
    return [(i, w, int(row[w])) for (i, _), w, row in zip(kept, which, d, strict=True)], centroids


def check_clusters(spark, rows, element="float"):
    expected, centroids = plain_kmeans(rows)
    made, found = clusters(frame(spark, rows, element))
    got = with_inertia(made, found).collect()
    assert found.tolist() == centroids.tolist()
    assert Counter((r["_id"], r.cluster, r.distance) for r in got) == Counter(expected)
    total, per = sum(d for _, _, d in expected), Counter()
    for _, c, d in expected:
        per[c] += d
    for r in got:
        assert (r.inertia, r.cluster_inertia, r.centroid_sha256) == (total, per[r.cluster], centroid_digest(centroids[r.cluster]))


def test_clusters_equal_plain_kmeans(spark):
    rnd = np.random.default_rng(1)
    spread = [(i, v.tolist()) for i, v in enumerate(rnd.normal(size=(400, 64)).astype(np.float32))]
    check_clusters(spark, spread + spread[:30] + ODD)
    # Few different values: many ties, equal centroids and empty ones.
    ties = [(i, [float(i % 3 - 1) / 64] * 32 + [float(i % 2) / 64] * 32) for i in range(200)] + [(None, [0.0] * 64)] * 3
    check_clusters(spark, ties)
    check_clusters(spark, [(i, v) for i, (_, v) in enumerate(spread[:7])] + ODD)
    check_clusters(spark, [(1, [1e6, -1e6] * 32)] * 4 + [(2, [0.25] * 64)], "double")


def test_clusters_of_nothing(spark):
    for rows in ([], ODD):
        made, found = clusters(frame(spark, rows))
        assert with_inertia(made, found).collect() == [] and len(found) == 0


def test_components_too_large_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        clusters(frame(spark, [(1, [1e30] * 64)]))


def test_bounds_skip_distances():
    """On clustered data most rows keep their centroid without a look at the others."""
    rnd = np.random.default_rng(2)
    heart = rnd.integers(-500, 500, size=(16, 64))
    x = heart[rnd.integers(0, 16, 4000)] + rnd.integers(-9, 10, size=(4000, 64))
    before = heart + rnd.integers(-5, 6, size=heart.shape)
    state, first = assign(x, Centres(before, None), None)
    state, later = assign(x, Centres(heart, before), state)
    d = ((x[:, None, :] - heart[None]) ** 2).sum(2)
    assert (state[0] == d.argmin(1)).all()
    assert later < 0.1 * d.size and first < d.size


def test_random_rounds_keep_the_nearest():
    rnd = np.random.default_rng(3)
    for _ in range(40):
        k, dim = int(rnd.integers(1, 9)), int(rnd.integers(1, 4))
        x, now, state, before = rnd.integers(-6, 7, size=(120, dim)), rnd.integers(-6, 7, size=(k, dim)), None, None
        for _ in range(6):
            state, _ = assign(x, Centres(now, before), state)
            assert (state[0] == ((x[:, None, :] - now[None]) ** 2).sum(2).argmin(1)).all()
            before, now = now, now + rnd.integers(-2, 3, size=now.shape)


def test_registered_clusters(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected, _ = plain_kmeans(rows)
    got = QUERIES["op12_shallot"](spark, SF)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in got.collect()) == Counter(expected)
    assert dict(got.dtypes)["distance"] == dict(got.dtypes)["inertia"] == "bigint"


def test_factor_and_rotations():
    rnd = np.random.default_rng(4)
    for rank, d in ((6, 6), (3, 7), (1, 5), (0, 4)):
        half = rnd.normal(size=(d, rank)) * 10.0 ** rnd.integers(-3, 4, size=rank)
        a = half @ half.T
        l = pivoted_cholesky(a)
        assert l.shape == (d, rank) and np.allclose(l @ l.T, a, atol=1e-12 * max(1.0, np.trace(a)))
        g = one_sided_jacobi(l)
        assert np.allclose(g @ g.T, a, atol=1e-12 * max(1.0, np.trace(a)))
        off = g.T @ g - np.diag((g**2).sum(0))
        assert np.abs(off).max(initial=0) <= 1e-12 * max(1.0, np.trace(a))
        assert np.allclose((g**2).sum(0), np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-6)


def check_whitened(spark, rows, got):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(0)
    centred = (x - np.array([s / n for s in sums])).astype(float)
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    deviation = Counter((i, int(s)) for (i, _), s in zip(kept, ((n * x - sums) ** 2).sum(1), strict=True))
    k = min(8, int((e > 1e-9 * e.max()).sum()))
    assert len(got) == n * k and {r.component for r in got} == set(range(1, k + 1))
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-8
    for c in range(k):
        mine = sorted((r for r in got if r.component == c + 1), key=lambda r: (r["_id"], r.deviation, r.whitened))
        assert Counter((r["_id"], r.deviation) for r in mine) == deviation
        assert mine[0].explained == pytest.approx(e[c] / np.trace(v), rel=1e-9)
        if c + 1 < len(e) and (e[c] - e[c + 1]) < 1e-6 * e[0] or c and (e[c - 1] - e[c]) < 1e-6 * e[0]:
            continue  # equal eigenvalues have no single component
        want = centred @ u[:, c] / np.sqrt(e[c])
        if len({i for i, _ in kept}) == n:
            want = want[np.argsort([i for i, _ in kept])]
            have = np.array([r.whitened for r in mine])
            sign = np.sign(have @ want)
            assert np.allclose(have, sign * want, atol=1e-7)


def test_whitening_against_a_solver(spark):
    rnd = np.random.default_rng(5)
    turn = np.linalg.qr(rnd.normal(size=(12, 12)))[0]
    rows = [(i, v.tolist()) for i, v in enumerate((rnd.normal(size=(300, 12)) * 1.6 ** -np.arange(12)) @ turn * 4)]
    other = [(9000, [1.0, 2.0])]
    check_whitened(spark, rows, whitened(frame(spark, rows + ODD[:1] + [(5002, [float("nan")] * 12), (5004, [None] * 12)] + other, "double")).collect())
    flat = [(i, [v[0], v[1], v[0] - v[1], 1.5]) for i, v in rows]  # near rank two, one constant dimension
    got = whitened(frame(spark, flat, "double")).collect()
    assert got[0].identity_error <= 1e-4 and {r.n for r in got} == {300}


def test_whitening_of_copies_and_of_nothing(spark):
    rows = [(1, [1.0, 2.0])] * 5
    assert whitened(frame(spark, rows)).collect() == []
    assert whitened(frame(spark, [])).collect() == [] and whitened(frame(spark, ODD[:2])).collect() == []
    two = [(1, [0.0, 0.0])] * 3 + [(None, [1.0, 0.0])] * 3
    got = whitened(frame(spark, two)).collect()
    assert len(got) == 6 and {r.component for r in got} == {1} and all(abs(abs(r.whitened) - 1) < 1e-12 for r in got)
    assert {r.deviation for r in got} == {(6 * 0 - 3 * 1024) ** 2} and got[0].explained == pytest.approx(1.0)


def test_deviation_beyond_a_long_is_null(spark):
    got = whitened(frame(spark, [(1, [0.0]), (2, [2.0**36]), (3, [1.0])], "double")).collect()
    assert sum(r.deviation is None for r in got) == 3 and got[0].identity_error < 1e-8
    with pytest.raises(Exception, match="beyond"):
        finite_vectors(frame(spark, [(1, [float(LARGEST)])], "double")).collect()
    rows = finite_vectors(frame(spark, [(i, [2.0**37 + i, 1.0 * (i % 3)]) for i in range(40)], "double"))
    assert fit_whitening(rows).sums[0] == sum((2**37 + i) * 1024 + 100_000 for i in range(40))


def test_registered_whitening(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op13_whitening"](spark, SF)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(spark, rows, got.withColumnRenamed("vec_id", "_id").collect())
