"""The set join against all pairs of sets."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rebuy.llm import set_join
from rebuy.llm.components import connected
from rebuy.llm.set_join import similar_sets
from tests.llm.conftest import ROWS


def brute(rows, width, threshold):
    """(id, n, component id) of each row."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                root[find(i)] = find(j)
    ids = {}
    for i, (own, _) in enumerate(rows):
        if own is not None:
            ids[find(i)] = min(ids.get(find(i), own), own)
    return sorted((own, len(sets[i]), ids.get(find(i)) if sets[i] else own) for i, (own, _) in enumerate(rows))


def key(row):
    return tuple((x is None, x or 0) for x in row)


def by_rows(rows, width, threshold):
    """As ``brute``, with ids that may repeat or be null."""
    found = brute([(i, text) for i, (_, text) in enumerate(rows)], width, threshold)
    size, component = {i: n for i, n, _ in found}, {i: c for i, _, c in found}
    least = {}
    for i, (own, _) in enumerate(rows):
        if own is not None and size[i]:
            least[component[i]] = min(least.get(component[i], own), own)
    return [(own, size[i], least.get(component[i]) if size[i] else own) for i, (own, _) in enumerate(rows)]


def check(docs, rows, width, threshold):
    got = similar_sets(docs, width=width, threshold=threshold).select("_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(by_rows(rows, width, threshold), key=key)


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def near_copies(seed, n_base=6, copies=40, common=True):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    rows = []
    for b in range(n_base):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 160))] + (passage if common else [])
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                at = rnd.randrange(len(text))
                text[at : at + rnd.randint(0, 1)] = [rnd.choice(vocabulary)]
            rows.append((rnd.randrange(10**6), " ".join(text)))
    return rows + [(rnd.randrange(10**6), " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 90)))) for _ in range(150)]


@pytest.mark.parametrize(("seed", "width", "threshold"), [(1, 3, 90), (2, 5, 80)])
def test_near_copies(spark, seed, width, threshold):
    rows = near_copies(seed)
    check(plain(spark, rows), rows, width, threshold)


def test_small_blocks_and_common_shingles(spark, monkeypatch):
    """Long lists, several blocks and a crowded map of common shingles change nothing."""
    for name, value in (("BLOCK", 8), ("LONG", 4), ("SKIP", 4), ("COMMON", 3), ("COMMON_BITS", 2**10), ("GROUP", 4)):
        monkeypatch.setattr(set_join, name, value)
    monkeypatch.setattr(set_join._blocks, "__defaults__", (8,))
    rows = near_copies(3, n_base=3, copies=30)
    check(plain(spark, rows), rows, 3, 90)


def test_odd_rows(spark, odd):
    check(odd(ROWS), [(r[0], r[1]) for r in ROWS], 3, 90)


def test_empty_table(spark, odd):
    assert similar_sets(odd([]), width=3, threshold=90).count() == 0


def test_components(spark):
    rnd = random.Random(5)
    chain = [(i, i + 1) for i in range(60)]
    rnd.shuffle(chain)
    edges = chain + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    got = connected(spark.createDataFrame(edges, "u long, v long"))
    roots = {r.node: r.root for r in got.collect()}
    assert all(roots[i] == 0 for i in range(61))
    assert all(roots[i] == 100 for i in range(100, 160))
    assert roots[200] == roots[201] == 200
    assert got.groupBy("node").count().filter(F.col("count") > 1).count() == 0
