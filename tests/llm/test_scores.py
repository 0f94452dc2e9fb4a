"""Toxicity and quality: the kernel and the model against plain definitions, and held-out labels."""

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rebuy.llm import kneser_ney, string_kernel
from rebuy.llm.kneser_ney import classify, perplexities, trusted_ids
from rebuy.llm.queries01 import op1_subsequence_kernel
from rebuy.llm.queries08 import op8_kneser_ney
from rebuy.llm.string_kernel import features, kernel, normalised, toxic_labels, toxicity
from tests.llm.conftest import ROWS

MID = "/root/testdata/sf0.01"


def slow_kernel(a, b):
    def count(s):
        found = defaultdict(float)
        letters = [(i, c) for i, c in enumerate(s) if c.isalpha()]
        for (i, x), (_, y), (k, z) in combinations(letters, 3):
            found[x + y + z] += string_kernel.DECAY ** (k - i + 1)
        return found

    x, y = count(a), count(b)
    dot = lambda p, q: sum(v * q.get(u, 0) for u, v in p.items())
    norm = math.sqrt(dot(x, x) * dot(y, y))
    return dot(x, y) / norm if norm else 0.0


def test_kernel_matches_its_definition():
    strings = ["idiot", "i-d-i-o-t", "idxiot", "banana", "ananas", "ab", "", "a.b.c", "aaaaaaa", "mississippi"]
    marks = ["idiot", "banana", "mississippi"]
    expected = np.array([[slow_kernel(a, b) for b in marks] for a in strings])
    mapped = [features(m) for m in marks]
    assert np.allclose(kernel(strings, mapped), expected, atol=1e-5)
    assert np.allclose(np.column_stack([normalised(strings, m) for m in mapped]), expected, atol=1e-5)
    assert slow_kernel("i-d-i-o-t", "idiot") > 0.9


def test_windows_and_runs_of_letters():
    long = "x" * 50 + "idiot" + "x" * 50
    assert normalised([long], features("idiot"))[0] > 0.03
    assert "i d i o t" in string_kernel.words("you I D I O T there")


def test_letters_of_all_scripts_count_by_their_own_code(monkeypatch):
    strings = ["идиот", "и-д.иот", "привет", "你真是笨蛋", "他真是笨-蛋", "丠睿是笨蛋", "غبي جدا", "straße", "strasse", "łódź"]
    marks = ["идиот", "你真是笨蛋", "غبي جدا", "straße"]
    expected = np.array([[slow_kernel(a, b) for b in marks] for a in strings])
    for table in (string_kernel.TABLE, 0):
        monkeypatch.setattr(string_kernel, "TABLE", table)
        mapped = [features(m) for m in marks]
        assert np.allclose(kernel(strings, mapped), expected, atol=1e-5)
        assert np.allclose(np.column_stack([normalised(strings, m) for m in mapped]), expected, atol=1e-5)
    # No string of other letters is like another, whatever the letters' codes.
    other = "".join(chr(ord(c) + 37) for c in "你真是笨蛋")
    assert normalised([other], features("你真是笨蛋"))[0] == 0


def test_short_neighbours_are_read_as_one_word():
    assert {"id iot", "you id"} <= string_kernel.words("You ID iot!")
    assert normalised(["id iot"], features("idiot"))[0] > 0.5
    assert string_kernel.words("a longer neighbour") == {"a", "longer", "neighbour"}


def test_toxicity_of_held_out_and_disguised_words(spark, odd):
    rnd = random.Random(3)
    plain = ["".join(rnd.choice("aeioustrnl") for _ in range(rnd.randint(3, 9))) for _ in range(900)]
    bad = ["idiot", "moron", "pathetic"]
    rows, labels = [], []
    for i in range(500):
        text = [rnd.choice(plain) for _ in range(40)]
        if i % 5 == 0:
            text[rnd.randrange(40)] = rnd.choice(bad)
        rows.append((i, " ".join(text), "en", "a", 1))
        labels.append((i, int(i % 5 == 0)))
    calm = " ".join(plain[:30])
    tests = [(9000, f"{calm} i-d-i-o-t {calm}"), (9001, f"{calm} mor.on"), (9002, f"{calm} p a t h e t i c"), (9003, calm), (9004, ""), (9005, f"{calm} id iot {calm}")]
    docs = odd(rows + [(i, t, "en", "a", 1) for i, t in tests] + ROWS)
    learnt = toxic_labels(spark.createDataFrame(labels + [(None, 1), (9003, None), (9004, 7)], "doc_id long, toxic int"))
    got = toxicity(docs, learnt.filter("_lid % 7 <> 0"))
    assert got.count() == docs.count()
    score = {r._id: r.score for r in got.collect()}
    held = [(i, y) for i, y in labels if i % 7 == 0]
    assert all((score[i] >= 0.5) == bool(y) for i, y in held)
    assert min(score[i] for i in (9000, 9001, 9002, 9005)) >= 0.5
    assert max(score[i] for i in (9003, 9004, 3, 4, 5, 7)) < 0.5
    assert all(0 <= s <= 1 for s in score.values())


def test_toxicity_without_both_classes(spark, odd):
    none = toxic_labels(spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity(odd(ROWS), none).collect()} == {0.5}
    assert toxicity(odd([]), none).count() == 0


def test_registered_toxicity_on_held_out_labels(spark):
    got = op1_subsequence_kernel(spark, MID).join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id")
    rows = got.select("held_out", "toxic", "predicted").collect()
    english_or_not = [r.toxic == r.predicted for r in rows if r.held_out]
    assert sum(english_or_not) >= 0.95 * len(english_or_not)


def test_clean_texts_of_every_language_are_left_alone(spark):
    """Held-out rows of the largest given table, by language: the smaller ones hold clean words that look like insults."""
    large = "/root/testdata/sf0.1"
    told = spark.read.parquet(f"{large}/labels.parquet").join(spark.read.parquet(f"{large}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = op1_subsequence_kernel(spark, large).filter("held_out").join(told, "doc_id").select("lang", "toxic", "predicted").collect()
    for lang in ("en", "de", "fr", "es"):
        clean = [r.predicted for r in rows if r.lang == lang and r.toxic == 0]
        toxic = [r.predicted for r in rows if r.lang == lang and r.toxic == 1]
        assert sum(clean) <= 0.04 * len(clean) and sum(toxic) >= 0.8 * len(toxic), lang


def slow_model(texts, order=4):
    """Interpolated modified Kneser-Ney over symbols (characters, or a list's words), straight from the counts; returns log p(text)."""
    chars = sorted({c for t in texts for c in t})
    v = len(chars) + 2
    padded = lambda t: ("^",) * (order - 1) + tuple(t)
    counts = [None] * (order + 1)
    counts[order] = Counter(padded(t)[i : i + order] for t in texts for i in range(len(t)))
    for o in range(order - 1, 0, -1):
        counts[o] = Counter(g[1:] for g in counts[o + 1])
    discounts, totals = {}, {}
    for o in range(1, order + 1):
        n = Counter(min(c, 5) for c in counts[o].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        made = [max(0.05 * i, min(i - (i + 1) * y * n[i + 1] / n[i], i)) if n[i] and n[1] else 0.5 * i for i in (1, 2, 3)]
        discounts[o] = lambda c, m=made: m[min(c, 3) - 1]
        totals[o] = defaultdict(lambda: [0, 0.0])
        for g, c in counts[o].items():
            totals[o][g[:-1]][0] += c
            totals[o][g[:-1]][1] += discounts[o](c)

    def p(gram):
        o = len(gram)
        total, mass = totals[o].get(gram[:-1], (0, 0))
        lower = 1 / v if o == 1 else p(gram[1:])
        if not total:
            return lower
        c = counts[o].get(gram, 0)
        own = (c - discounts[o](c)) / total if c else 0
        if o == 1 and not c:
            return min((c - discounts[1](c)) / total for c in counts[1].values()) + mass / total / v
        return own + mass / total * lower

    return lambda text: sum(math.log(p(padded(text)[i : i + order])) for i in range(len(text)))


def test_model_matches_its_definition(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "PIECE", 7)
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("aab bcd") for _ in range(rnd.randint(1, 60))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(60)], "_tid long")
    model = slow_model(texts[:60])
    for rows_of_shard in (kneser_ney.SHARD_ROWS, 40):
        monkeypatch.setattr(kneser_ney, "SHARD_ROWS", rows_of_shard)
        got = {r._id: r for r in perplexities(docs, trusted, doc_id="doc_id", text="text", lang="lang").collect()}
        assert len(got) == 80
        for i, t in enumerate(texts):
            assert got[i].n == len(t)
            assert got[i].logp == pytest.approx(model(t), rel=1e-4)


def test_word_model_with_two_folds_matches_its_definition(spark, monkeypatch):
    """What the registered query runs: word trigrams, and no trusted text judged by a model that has read it."""
    monkeypatch.setattr(kneser_ney, "PIECE", 5)
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice("the cat sat on a mat and ran".split()) for _ in range(rnd.randint(1, 40))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    fold = {r.doc_id: r.f for r in docs.select("doc_id", F.pmod(F.xxhash64("text"), F.lit(2)).alias("f")).collect()}
    assert set(fold.values()) == {0, 1}
    trusted = spark.createDataFrame([(i,) for i in range(90)], "_tid long")
    models = {k: slow_model([texts[i].split() for i in range(90) if fold[i] != k], order=3) for k in (0, 1)}
    for rows_of_shard in (kneser_ney.SHARD_ROWS, 40):
        monkeypatch.setattr(kneser_ney, "SHARD_ROWS", rows_of_shard)
        found = perplexities(docs, trusted, doc_id="doc_id", text="text", lang="lang", words=True, folds=2).collect()
        assert len(found) == 120
        for r in found:
            words = texts[r._id].split()
            assert (r.n, r.pairs, r.trusted) == (len(words), len(set(zip(words, words[1:]))), r._id < 90)
            assert r.logp == pytest.approx(models[fold[r._id]](words), rel=1e-9)


@pytest.mark.parametrize("words", [False, True])
def test_units_passes_and_codes_change_no_number(spark, monkeypatch, words):
    """Symbols with several units, several passes, and symbols without a code."""
    monkeypatch.setattr(kneser_ney, "UNIT_ROWS", 300)
    monkeypatch.setattr(kneser_ney, "CODES", 5)
    monkeypatch.setattr(kneser_ney, "SLICES", 3)
    rnd = random.Random(8)
    cut, join, order = (str.split, " ", 3) if words else (list, "", 4)
    pool = "the the the cat sat on a mat and ran off" .split() if words else list("aaab bcdefgh")
    texts = [join.join(rnd.choice(pool) for _ in range(rnd.randint(1, 60))) for _ in range(100)]
    texts += [join.join("xyz"[: 1 + i % 3]) for i in range(6)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(70)], "_tid long")
    model = slow_model([cut(t) for t in texts[:70]], order=order)
    got = perplexities(docs, trusted, doc_id="doc_id", text="text", lang="lang", words=words).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.logp == pytest.approx(model(cut(texts[r._id])), rel=1e-9)


def test_symbols_are_those_of_the_regular_expressions(spark):
    rnd = random.Random(3)
    ranges = [(0, 0x250), (0x300, 0x600), (0x900, 0x3100), (0x4E00, 0x4E80), (0xFE00, 0x10000), (0x1F000, 0x1FA00), (0x20000, 0x20040)]
    one = lambda: chr(rnd.randrange(*rnd.choice(ranges))) if rnd.random() < 0.4 else rnd.choice("ab  c.\n")
    texts = ["".join(one() for _ in range(rnd.randint(0, 80))) for _ in range(500)]
    parted = F.filter(F.split(F.regexp_replace("t", kneser_ney._LONE, " $0 "), r"[\s\p{Z}]+"), lambda w: w != "")
    want = [r.w for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parted.alias("w")).collect()]
    kinds = kneser_ney._kinds(spark)
    flat, counts = kneser_ney._symbols(texts, kinds)
    assert counts.tolist() == [len(w) for w in want]
    known: dict[str, int] = {}
    assert all(known.setdefault(w, h) == h for w, h in zip((w for ws in want for w in ws), flat.tolist(), strict=True))
    assert len(set(known.values())) == len(known)
    for t in texts:
        assert "".join(kneser_ney._cut(t, 5)) == t
        parts = [kneser_ney._symbols([p], kinds)[0] for p in kneser_ney._cut(t, 5)]
        assert sum(map(len, parts)) == len(kneser_ney._symbols([t], kinds)[0])


def test_only_texts_that_the_sieve_lets_through_are_shuffled(spark):
    """the optimizer did the exact join first, so that every pass shuffled the texts of all documents."""
    rows = spark.range(300).selectExpr("id AS _id", "cast(id AS string) AS _text").unionAll(spark.sql("SELECT null, 'x'"))
    trusted = spark.createDataFrame([(i,) for i in (3, 3, 40, 999, None)], "_tid long")
    found = kneser_ney._sieved(rows, trusted)
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert "_tid" in joins[0] and "_word" in joins[1]
    assert found.columns == ["_id", "_text"] and sorted(r._id for r in found.collect()) == [3, 40]


def test_hashes_are_found_by_their_first_bits():
    """as by halving, where many share the first bits, too."""
    rnd = np.random.default_rng(6)
    for keys in (rnd.integers(0, 2**64, 5000, np.uint64), rnd.integers(0, 300, 200, np.uint64), np.array([2**64 - 1], np.uint64), np.empty(0, np.uint64)):
        keys = np.unique(keys)
        wanted = np.concatenate([keys, keys + np.uint64(1), rnd.integers(0, 2**64, 1000, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        at, known = kneser_ney._Index(keys).found(wanted)
        assert (known == np.isin(wanted, keys)).all() and (keys[at[known]] == wanted[known]).all()


def test_quality_keeps_little_on_disk(spark):
    """Stage tables and shuffle files that are left when the scores are there."""
    import os
    from pathlib import Path

    from rebuy.sources.stage import stage_root

    root = Path(stage_root(spark).removeprefix("file:"))
    size = lambda: sum(p.stat().st_size for p in root.rglob("*") if "op8_" in str(p) and p.is_file())
    before = size()
    docs, labels = (spark.read.parquet(f"{MID}/{t}.parquet") for t in ("documents", "labels"))
    assert classify(docs, labels).count() == docs.count()
    assert size() - before <= 1.5 * os.path.getsize(f"{MID}/documents.parquet")


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (3, 1), (None, 1), (7, 0)], "doc_id long, quality int")
    got = classify(odd(ROWS), labels).collect()
    assert len(got) == len(ROWS)
    assert all(r.perplexity is None and not r.rejected for r in got if r._id in (3, 4))
    assert [r._tid for r in trusted_ids(labels).filter("_tid < 3").collect()] == [1]
    assert classify(odd([]), labels).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, quality int")
    assert not any(r.rejected for r in classify(odd(ROWS), nothing).collect())


def test_registered_quality_keeps_good_documents(spark):
    got = op8_kneser_ney(spark, MID).join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id")
    rate = {r.quality: r.share for r in got.groupBy("quality").agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
    assert rate[1] < 0.02 and rate[0] > 0.7


def test_every_symbol_counts(spark):
    """More symbols than bytes have: a known rare one differs from one that no trusted text has."""
    texts = ["".join(chr(0x4E00 + (7 * i + j) % 400) for j in range(40)) for i in range(400)]
    tests = [(900, texts[3]), (901, "".join(chr(0x4E00 + 500 + j) for j in range(40)))]
    docs = spark.createDataFrame([*((i, t, "zh") for i, t in enumerate(texts)), *((i, t, "zh") for i, t in tests)], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(400)], "_tid long")
    got = {r._id: r.logp / r.n for r in perplexities(docs, trusted, doc_id="doc_id", text="text", lang="lang").collect()}
    model = slow_model(texts)
    assert got[900] == pytest.approx(model(texts[3]) / 40, rel=1e-4)
    assert got[901] < got[900] - 2
    spaceless = perplexities(docs, trusted, doc_id="doc_id", text="text", lang="lang", words=True).collect()
    assert {r.n for r in spaceless} == {40}


def test_registered_quality_rejects_every_kind_of_junk(spark):
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    texts = {r.doc_id: r.text.split() for r in spark.read.parquet(f"{MID}/documents.parquet").join(labels.filter("quality = 0"), "doc_id").collect()}
    kinds = {
        "repeats": lambda w: sum(a == b for a, b in zip(w, w[1:])) > len(w) / 2,
        "pieces": lambda w: w.count("|") > len(w) / 10,
        "capitals": lambda w: sum(x.endswith("!!") for x in w) > len(w) / 5,
        "marks": lambda w: sum(x[-1] in "#$%&*" for x in w) > len(w) / 5,
    }
    rejected = {r.doc_id for r in op8_kneser_ney(spark, MID).filter("rejected").collect()}
    for kind, holds in kinds.items():
        members = [i for i, w in texts.items() if holds(w)]
        assert members and sum(i in rejected for i in members) >= 0.8 * len(members), kind
