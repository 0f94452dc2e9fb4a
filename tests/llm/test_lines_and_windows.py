"""Line dedup, decontamination, token counts and mixing against plain Python."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rebuy.llm import length_histogram as lh
from rebuy.llm import line_spread, pfair_mix
from rebuy.llm.line_spread import drop_spread_lines
from rebuy.llm.pfair_mix import mixed
from rebuy.llm.winnowing import find_contamination
from tests.llm.conftest import LONG, ROWS


def split_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def hits(docs, items, window=13):
    windows = defaultdict(set)
    for own, text in items:
        w = split_words(text)
        for i in range(len(w) - min(window, len(w)) + 1 if w else 0):
            windows[tuple(w[i : i + window])].add(own)
    found = []
    for _, text in docs:
        w = split_words(text)
        hit, names = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                of = windows.get(tuple(w[i : i + n]))
                if of:
                    hit.update(range(i, i + n))
                    names |= {str(x) for x in of if x is not None}
        found.append((len(w), len(hit), sorted(names)))
    return found


ITEMS = [
    (10, "The quick brown fox jumps over the lazy dog and then runs away home again."),
    (11, "brown FOX"),
    (12, None),
    (13, "..."),
    (14, "One"),
    (None, "lazy dog and"),
    (15, "alpha beta gamma delta alpha beta gamma delta alpha beta gamma delta alpha beta"),
    (15, "a document without"),
    (16, "É é Straße 42"),
]


def test_contamination(spark, odd):
    extra = [(20, "é É straße 42 É É STRAßE 42 É é straße 42", "de", "a", 1), (21, "fox brown fox brown", "en", "a", 1)]
    docs = odd(ROWS + extra)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("_fp", F.lit(1))
    got = find_contamination(docs, items).select("_id", "n_words", "n_hit", "items", "spans").collect()
    plain = [(r[0], r[1]) for r in ROWS + extra]
    expected = Counter((own[0], n, h, tuple(i)) for own, (n, h, i) in zip(plain, hits(plain, ITEMS), strict=True))
    assert Counter((r._id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == expected
    assert all(sum(s.past - s.first for s in r.spans) == r.n_hit for r in got)


def test_contamination_empty(spark, odd):
    items = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in find_contamination(odd(ROWS), items).collect()} == {0}
    assert find_contamination(odd([]), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


@pytest.mark.parametrize("text", ["a b c d e f g h i j k l m", "x a b c d e f g h i j k l m y a b c d e f g h i j k l m"])
def test_a_span_of_the_window_is_always_found(spark, text):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l m")], "item_id long, text string")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert find_contamination(docs, items).first().n_hit == 13 * text.count("m")


def test_line_spread(spark, odd, monkeypatch):
    rows = [(400 + i, f"shared line \nown line {i}\n\nshared line", "en", f"s{i % 7}", 1) for i in range(40)]
    rows += [(100 + i, "only boilerplate", "en", f"s{i}", 1) for i in range(5)]
    rows += [(200, "few sites\nkept", "en", "s1", 1), (201, "few sites", "en", "s2", 1), (400, rows[0][1], "en", "s0", 1)]
    rows += [(300 + i, "null site", "en", None if i else "z", 1) for i in range(3)]
    rows += ROWS
    for band in (0.2, 0.0, 1.0):
        monkeypatch.setattr(line_spread, "BAND", band)
        got = drop_spread_lines(odd(rows), min_sites=5).select("doc_id", "text", "_n_dropped", "_emptied", "score").collect()
        by_id = defaultdict(list)
        for r in got:
            by_id[r.doc_id].append(r)
        assert len(got) == len(rows)
        assert {r.score for r in got} == {"x"}
        assert [r.text for r in by_id[400]] == ["shared line \nown line 0\n"] * 2
        assert by_id[405][0].text == "own line 5\n" and by_id[405][0]._n_dropped == 2
        assert by_id[100][0].text == "only boilerplate" and not by_id[100][0]._emptied
        assert by_id[101][0].text == "" and by_id[101][0]._emptied
        assert by_id[200][0].text == "few sites\nkept"
        assert by_id[3][0].text is None and by_id[4][0].text == "" and by_id[5][0].text == " \t\n "
    assert drop_spread_lines(odd([])).count() == 0


def test_spread_of_few_sites(spark, odd):
    """Long passages in few of many sites, or mostly in a hot one, and tables with fewer than ten sites."""
    few, hot = (" ".join(f"{name}{i}" for i in range(60)) for name in ("few", "hot"))
    for sites in (4, 20):
        rows = [(i, f"own text {i}", "en", f"s{i % sites}", 1) for i in range(40)]
        rows += [(100 + i, f"{few}\nown {i}", "en", f"s{i}", 1) for i in range(3)]
        rows += [(200 + i, f"{hot}\nhot {i}", "en", f"s{max(0, i - 297)}", 1) for i in range(300)]
        rows += [(600 + i, "two sites", "en", f"s{i}", 1) for i in range(2)]
        got = {r.doc_id: r for r in drop_spread_lines(odd(rows)).collect()}
        assert {i: got[i].text for i in (100, 101, 102)} == {100: f"{few}\nown 0", 101: "own 1", 102: "own 2"}
        assert got[200].text.startswith(hot) and all(got[200 + i].text == f"hot {i}" for i in range(1, 300))
        assert got[600].text == got[601].text == "two sites" and sum(r._n_dropped for r in got.values()) == 301


@pytest.fixture(scope="module")
def encoder():
    with open(lh.VOCABULARY, "rb") as f:
        return lh.encoding(f.read())


def test_length_histogram(spark, odd, encoder, monkeypatch):
    monkeypatch.setattr(lh, "BUCKET", 4)
    texts = [r[1] for r in ROWS] + ["word " * i for i in range(60)] + ["<|endoftext|>"]
    docs = odd([(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    sizes = [len(encoder.encode_ordinary(t or "")) for t in texts]
    histogram = lh.length_histogram(lh.token_counts(docs)).cache()
    rows = {r.n_tokens: r for r in histogram.collect()}
    assert {n: r.n_docs for n, r in rows.items()} == Counter(sizes)
    for limit, r in rows.items():
        assert r.docs_at_least == sum(s >= limit for s in sizes)
        assert r.tokens_at_least == sum(s for s in sizes if s >= limit)
        assert r.docs_at_most == sum(s <= limit for s in sizes)
        assert r.truncated_total == sum(min(s, limit) for s in sizes)
        assert r.truncated_total + r.tokens_cut == sum(sizes)
    for r in lh.at_limits(histogram, [0, 7, 33, 10**9]).collect():
        assert (r.docs_whole, r.total) == (sum(s <= r.context_limit for s in sizes), sum(min(s, r.context_limit) for s in sizes))
    ordered = sorted(sizes)
    for r in lh.quantiles(histogram, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == next(s for i, s in enumerate(ordered) if (ordered[i + 1 :] + [10**9])[0] != s and i + 1 >= r.share * len(ordered))


def test_length_histogram_empty(odd):
    assert lh.length_histogram(lh.token_counts(odd([]))).count() == 0


def simulated(weights, blocks):
    """The class of each slot: earliest deadline first, phase by phase."""
    left, order = dict(blocks), []
    while any(left.values()):
        live = {c: w for c, w in weights.items() if left[c] and w} or {c: 1 for c in left if left[c]}
        q, done, t = sum(live.values()), Counter(), 0
        while all(left[c] for c in live):
            ready = [(-(-(done[c] + 1) * q // w), c) for c, w in sorted(live.items()) if done[c] * q // w <= t]
            _, c = min(ready)
            done[c] += 1
            left[c] -= 1
            t += 1
            order.append(c)
            assert all(abs(done[x] * q - w * t) < q for x, w in live.items())
    return order


@pytest.mark.parametrize("targets", [None, {"a": 50, "b": 30, "c": 15}, {"a": 1, "b": 0}, {}])
def test_mix(spark, odd, targets, monkeypatch):
    monkeypatch.setattr(pfair_mix, "RUN", 10)
    rows = [(i, f"t{i}", "en", "abcde"[min(i % 9, 4)], 1) for i in range(400)] + ROWS
    got = mixed(odd(rows), targets=targets, block_docs=4, keep=["doc_id", "source", "rank"]).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.mix_slot].append(r)
    assert sorted(slots) == list(range(len(slots)))
    for held in slots.values():
        assert len({(r.mix_class, r.mix_block) for r in held}) == 1
        assert sorted(r.mix_place for r in held) == list(range(len(held)))
    name = {r.mix_class: r.mix_class or "\0" for r in got}
    weights = {name[r.mix_class]: r.mix_weight for r in got}
    blocks = Counter(name[held[0].mix_class] for held in slots.values())
    assert simulated(weights, blocks) == [name[slots[s][0].mix_class] for s in sorted(slots)]


@pytest.mark.parametrize("sources", [30, 250])
def test_every_source_of_many_keeps_its_target(spark, odd, sources, monkeypatch):
    """Shares with fractions, and more sources than percents: each is near its exact weight all along."""
    monkeypatch.setattr(pfair_mix, "RUN", 40)
    rows = [(i * 100 + k, f"t{i} {k}", "en", f"s{i:03}", 1) for i in range(sources) for k in range(12 + i % 7)]
    got = mixed(odd(rows), block_docs=1, keep=["source"]).orderBy("mix_slot").collect()
    sizes = Counter(r[3] for r in rows)
    assert Counter(r.source for r in got) == sizes
    total = sum(n**0.5 for n in sizes.values())
    done = Counter()
    # Until the first source runs out; a block of its own class and one of the others at most.
    for t, r in enumerate(got, 1):
        done[r.source] += 1
        if done[r.source] == sizes[r.source]:
            break
        assert all(abs(done[x] - t * n**0.5 / total) < 2 for x, n in sizes.items())
    assert t > len(got) / 2


def test_mix_empty_and_wrong_targets(odd):
    assert mixed(odd([])).count() == 0
    with pytest.raises(ValueError, match="percents"):
        mixed(odd(ROWS), targets={"a": 101})


def test_long_text_is_whole(odd):
    docs = odd([(1, LONG, "en", "a", 1)])
    assert drop_spread_lines(docs).first().text == LONG
