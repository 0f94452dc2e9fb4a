"""Nearest neighbours, archives, the temporal list join, the pipeline and the registry."""

import datetime as dt
import hashlib
import math
import random
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rebuy.llm import multi_index, warc
from rebuy.llm.list_history import evaluate, intervals
from rebuy.llm.multi_index import nearest, walk
from rebuy.llm.registry import ORACLES, QUERIES
from rebuy.llm.warc import archive_folder, page_records, read_chunks, write_archives
from tests.llm.conftest import CLASHES, ROWS

SMALL = "/root/testdata/sf0.001"


def vectors(seed, n, dim=8):
    rnd = np.random.default_rng(seed)
    return [(i, rnd.normal(size=dim).astype(np.float32).tolist()) for i in range(n)]


def exact(rows, every, k):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    found = {}
    for own, q in zip(ids, x, strict=True):
        if own % every == 0:
            d = np.sqrt(((x - q) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != own][:k]
            found[own] = [(int(ids[j]), d[j]) for j in order]
    return found


def test_a_walk_over_all_entries_is_exact(spark):
    rows = vectors(1, 300) + [(1000 + i, [1.0] * 8) for i in range(40)] + [(2000, [1.0] * 8)]
    bad = [(5000, None), (5001, [0.0] * 8), (5002, [float("nan")] + [1.0] * 7), (5003, [float("inf")] + [1.0] * 7)]
    bad += [(5004, [None] + [1.0] * 7), (5005, [1.0, 2.0]), (None, [1.0] * 8), (5100, [])]
    df = spark.createDataFrame(rows + rows[:5] + bad, "vec_id long, embedding array<float>")
    for name in ("id", "e", "a", "b", "score"):
        df = df.withColumn(name, F.lit("x"))
    got = {}
    for r in nearest(df, every=100, visit=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = exact(rows, 100, 10)
    assert got.keys() == expected.keys()
    for own, found in expected.items():
        assert [v for v, _ in got[own]] == [v for v, _ in found]
        assert np.allclose([d for _, d in got[own]], [d for _, d in found], rtol=1e-12)


def recall(spark, rows, every, **more):
    got = {}
    for r in nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=every, **more).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    expected = exact(rows, every, 10)
    return sum(len(got[q] & {v for v, _ in found}) for q, found in expected.items()) / 10 / len(expected)


def test_recall_and_blocks(spark, monkeypatch):
    for name, value in (("BLOCK", 16), ("QUERY_BLOCK", 8)):
        monkeypatch.setattr(multi_index, name, value)
    assert recall(spark, vectors(2, 2000, 16), 50) >= 0.9
    rnd = np.random.default_rng(3)
    hearts = rnd.normal(size=(40, 16)) * 6
    clustered = [(i, (hearts[i % 40] + rnd.normal(size=16)).astype(np.float32).tolist()) for i in range(2000)]
    assert recall(spark, clustered, 50) >= 0.95
    # A fifth of the entries is enough where vectors come in clusters.
    assert recall(spark, clustered, 50, visit=0.2) >= 0.9


def test_recall_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert recall(spark, rows, 50) >= 0.95


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (3, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in nearest(df).collect()] == [(0, 1, 3)]
    assert nearest(df.limit(0)).count() == 0


def test_walk_goes_by_summed_distance():
    rnd = random.Random(4)
    a, b = np.array([rnd.random() for _ in range(7)]), np.array([rnd.random() for _ in range(5)])
    counts = np.array([[rnd.choice([0, 1, 3]) for _ in b] for _ in a])
    for enough in (1, 10, 25, 10**6):
        passed = {(i, j) for i, js in walk(a, b, counts, enough).items() for j in js}
        order = sorted((a[i] + b[j], i, j) for i in range(7) for j in range(5))
        expected, total = set(), 0
        for _, i, j in order:
            if total >= enough:
                break
            if counts[i, j]:
                expected.add((i, j))
                total += counts[i, j]
        assert passed == expected


PAGES = [
    (1, "http://a/1", "x" * 2000),
    (2, "http://a/2", "x" * 2000),
    (3, None, "x" * 2000),
    (4, "http://a/4", "short"),
    (5, "http://a/5", "short"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "http://a/8", "é\r\n\r\nWARC/1.1\r\n" * 5000),
    (8, "http://a/8", "é\r\n\r\nWARC/1.1\r\n" * 5000),
    (9, "http://a/\r\nb", "other"),
    (9, "http://a/9", "another under the same id"),
    (None, None, "x" * 2000),
    (None, "http://a/n", "no id"),
]


@pytest.mark.parametrize("chunk", [7, 1024, warc.CHUNK_BYTES])
def test_archives_round_trip(spark, chunk):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("chunk_no", F.lit(1)).repartition(3)
    manifest = write_archives(pages, archive_folder(spark), chunk_bytes=chunk, archive_bytes=10_000)
    read = read_chunks(manifest, chunk_bytes=chunk).cache()
    distinct = {(i, t or "") for i, _, t in PAGES}
    whole, digest = {}, {}
    for r in read.orderBy("record_id", "chunk_no").collect():
        assert r.chunk_no == len(whole.setdefault(r.record_id, []))
        whole[r.record_id].append(bytes(r.data))
        so_far = b"".join(whole[r.record_id])
        assert (r.payload_bytes, r.payload_digest) == (len(so_far), hashlib.sha1(so_far).hexdigest())
        assert len(r.data) <= chunk
        digest[r.record_id] = r.record_type, r.page_id, so_far.decode(errors="ignore")
    assert {(i, t) for kind, i, t in digest.values() if kind == "response"} == distinct - {(1, "x" * 2000), (2, "x" * 2000), (None, "x" * 2000)}
    got = page_records(read).collect()
    assert sorted((r.page_id or 0, r.payload_bytes) for r in got) == sorted((i or 0, len((t or "").encode())) for i, _, t in PAGES)
    for r in got:
        assert r.payload_digest == r.declared_digest
        text = next(t for i, t in distinct if i == r.page_id and hashlib.sha1(t.encode()).hexdigest() == r.payload_digest)
        assert r.payload_bytes == len(text.encode())
        revisit = text == "x" * 2000 and r.page_id != 3
        assert (r.record_type, r.refers_to) == (("revisit", 3) if revisit else ("response", None))


def test_repeated_rows_and_a_large_payload(spark, monkeypatch):
    """Every row of pages has its result row, the repeats of a response too; a payload of many chunks comes back whole."""
    monkeypatch.setattr(warc, "RUN", 3)
    large = "".join(f"{i:07x}" for i in range(1_300_000))  # 9 MB, 139 chunks
    rows = [(1, "u", large), *[(2, "u", "y" * 1500)] * 8, *[(3, "u", "y" * 1500)] * 2, *[(4, "u", "")] * 3]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    read = read_chunks(write_archives(pages, archive_folder(spark))).cache()
    assert read.filter("page_id = 1").count() == -(-len(large) // warc.CHUNK_BYTES)
    assert read.agg(F.max(F.octet_length("data"))).first()[0] == warc.CHUNK_BYTES
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in page_records(read).collect())
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    assert got == {
        (1, len(large), sha(large), "response", None): 1,
        (2, 1500, sha("y" * 1500), "revisit", 3): 8,
        (3, 1500, sha("y" * 1500), "response", None): 2,
        (4, 0, sha(""), "response", None): 3,
    }


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert page_records(read_chunks(write_archives(pages, archive_folder(spark)))).count() == 0


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_list_history(spark):
    rnd = random.Random(6)
    values = [("domain", "x.org"), ("domain", "a.x.org"), ("host", "a.x.org"), ("prefix", "a.x.org/p"), ("prefix", "a.x.org/p/q")]
    log = [(*rnd.choice(values), rnd.choice(["add", "remove"]), day(rnd.randrange(900))) for _ in range(60)]
    odd = [("domain", None, "add", day(1)), (None, "x.org", "add", day(1)), ("domain", "x.org", "??", day(1)), ("domain", "x.org", "add", None)]
    urls = ["http://a.x.org/p/q/r?x=/z#y", "HTTPS://u:p@A.X.ORG:80/p2", "http://b.x.org", "http://xx.org/p", "a.x.org/p", "", None]
    shots = [(i % 50, rnd.choice(urls), day(rnd.randrange(-10, 1000))) for i in range(300)] + [(None, urls[0], day(5)), (1, urls[0], None)]
    entries = spark.createDataFrame(log + odd, "kind string, value string, action string, day date").withColumn("slice", F.lit(1))
    captures = spark.createDataFrame(shots, "page long, url string, fetched date").withColumn("kind", F.lit("x"))

    def active(kind, value, at):
        said = [(d, a) for k, v, a, d in log if (k, v) == (kind, value) and d <= at]
        return bool(said) and max(said)[1] == "add"

    def matches(url, at):
        url = (url or "").lower()
        if "://" not in url or at is None:
            return set()
        rest = url.split("://")[1].split("?")[0].split("#")[0].split("@")[-1]
        host, _, path = rest.partition("/")
        host = host.split(":")[0]
        keys = {("host", host), *(("domain", ".".join(host.split(".")[i:])) for i in range(host.count(".") + 1))}
        parts = [p for p in path.split("/") if p]
        keys |= {("prefix", "/".join([host, *parts[: i + 1]])) for i in range(len(parts))}
        return {k for k in keys if active(*k, at)}

    got = evaluate(captures, entries, capture_id="page", url="url", day="fetched").collect()
    assert len(got) == len(shots)
    for r in got:
        found = matches(r.url, r.day)
        assert (r.blocked, r.n_active) == (bool(found), len(found))
        if found:
            assert (r.kind, r.value) == min(found, key=lambda k: (["prefix", "host", "domain"].index(k[0]), -len(k[1]), k[1]))
    held = intervals(entries)
    assert held.filter("until <= since").count() == 0
    nothing = captures.limit(0)
    assert evaluate(nothing, entries, capture_id="page", url="url", day="fetched").count() == 0
    assert not any(r.blocked for r in evaluate(captures, entries.limit(0), capture_id="page", url="url", day="fetched").collect())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    expected = con.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(names)
    key = lambda row: tuple((x is None, str(x)) for x in row)
    found = sorted((tuple(r) for r in got.select(*names).collect()), key=key)
    assert found == sorted(expected.fetchall(), key=key)


def test_pipeline_stages(spark, odd):
    """Each stage keeps clean documents, its decisions take effect, and all but the last keep the columns."""
    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    clean = [(1000 + i, text(80), "en", f"s{i % 12}", 1) for i in range(60)]
    copy = (9000, clean[0][1], "en", "s1", 1)
    near = (9001, clean[1][1] + " more", "en", "s1", 1)
    passage = spark.read.parquet(f"{SMALL}/benchmark.parquet").filter("length(text) > 150").first().text
    leak = (9002, passage, "en", "s2", 1)
    docs = odd([*clean, copy, near, leak, copy, *ROWS])
    kept = docs
    for name, stage in corpus_pipeline.STAGES[1:]:
        before = kept
        kept = stage(spark, kept, SMALL).cache()
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert {r[0] for r in clean} <= ids, name
        if name != "mix":
            assert kept.columns == before.columns
        if name == "near_duplicates":
            assert not ids & {9000, 9001, 2, 8} and 7 in ids and None in ids
            assert kept.filter("doc_id = 1").count() == 2
        if name == "decontamination":
            assert 9002 not in ids
    assert set(CLASHES) - {"mix_slot"} <= set(kept.columns)


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.count() > 100
    assert got.select("mix_slot", "mix_place").distinct().count() == got.count()


def test_vectors_of_one_number(spark):
    df = spark.createDataFrame([(i, [float(i + 1)]) for i in range(4)], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(df).orderBy("rank").collect()] == [
        (0, 1, 1, 1.0),
        (0, 2, 2, 2.0),
        (0, 3, 3, 3.0),
    ]


def test_vectors_of_doubles(spark):
    """Scores are the measure on the original doubles, and numbers that no float holds take part."""
    rows = [(0, [1.0, 1e-60]), (1, [1.0 + 1e-12, 0.0]), (2, [1e60, 1.0]), (3, [0.0, 1e-60])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(df).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 1), (0, 3), (0, 2)]
    assert [r.score for r in got] == [math.dist(rows[0][1], rows[r.vec_id][1]) for r in got]
