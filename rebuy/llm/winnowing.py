"""Benchmark decontamination by winnowing (native DataFrame operations only).

Every text is a sequence of words. A *window* is ``window`` consecutive words
of a benchmark item; an item of fewer words, but not none, is one window of
all its words. The fingerprint of a window is the smallest hash among its
``k``-grams, which is what winnowing keeps: a document window with the same
words has the same smallest hash, so a shared span of ``window`` words always
shares a fingerprint, and no such span can be missed.

1. every document gives its distinct fingerprints, about two for every
   ``window - k + 2`` words, and these meet the benchmark's in one join;
2. in the documents with a common fingerprint, the positions that carry it
   are extended to the whole window and compared word by word (the windows'
   words are the join key, so equal hashes alone decide nothing);
3. overlapping hits are merged to spans, and the words inside are counted.

Spark decides from the measured size of the staged fingerprints whether they
are broadcast. All steps are linear in the words; no pairs of documents or of
items are formed.

Defined cases: null or empty text has no words, no windows and no hits. A
benchmark item whose id is null counts for hit words but not as an item; an
item id on several rows is one item with the windows of all of them. Repeated
document rows each get the row's result; rows that share an id and differ in
text are judged each by its own text. Empty tables give no rows, or no hits.
Other columns of both inputs are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebuy.llm.common import KEY, key_join, keyed, lower_ascii, stage_table

#: What separates words, after lower-casing A-Z (fixed by the contract).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _shifted(name: str, by: int) -> str:
    return f"slice({name}, {by + 1}, size({name}))"


def _grams(df: DataFrame, k: int) -> tuple[DataFrame, str]:
    """Adds the hash of the k words from each position, by doubling."""
    have, name = 1, "_g1"
    while have < k:
        step = min(have, k - have)
        made = f"_g{have + step}"
        if made not in df.columns:
            df = df.withColumn(made, F.expr(f"zip_with({name}, {_shifted(name, step)}, (x, y) -> xxhash64(x, y))"))
        have, name = have + step, made
    return df, name


def _fingerprints(df: DataFrame, length: int, k: int) -> DataFrame:
    """Adds ``_m{length}``: for each position, the smallest k-gram hash among the ``length`` words from there.

    Positions with fewer words left are cut off. ``zip_with`` fills the
    shorter side with nulls; ``least`` skips them, and they only reach the
    positions that are cut off.
    """
    k = min(k, length)
    df, name = _grams(df, k)
    have, want = 1, length - k + 1
    while have < want:
        step = min(have, want - have)
        made = f"_s{length}_{have + step}"
        df = df.withColumn(made, F.expr(f"zip_with({name}, {_shifted(name, step)}, (x, y) -> least(x, y))"))
        have, name = have + step, made
    return df.withColumn(f"_m{length}", F.expr(f"slice({name}, 1, greatest(size(_words) - {length - 1}, 0))"))


def _hashed(df: DataFrame, lengths: list[int], k: int) -> DataFrame:
    """Adds ``_m{n}`` for each window length; drops the steps on the way."""
    kept = [c for c in df.columns if c != "_g1"]
    df = df.withColumn("_g1", F.expr("transform(_words, w -> xxhash64(w))"))
    df = reduce(lambda d, n: _fingerprints(d, n, k), lengths, df)
    return df.select(*kept, *(f"_m{n}" for n in lengths))


def benchmark_windows(items: DataFrame, lengths: list[int], window: int, k: int) -> DataFrame:
    """``_item, _len, _fp, _win``: the distinct windows of every item, with fingerprints."""
    parts = []
    for n in lengths:
        own = F.size("_words") >= n if n == window else F.size("_words") == n
        made = F.expr(
            f"transform(_m{n}, (fp, i) -> struct({n} AS _len, fp AS _fp, array_join(slice(_words, i + 1, {n}), ' ') AS _win))"
        )
        part = _hashed(items.filter(own), [n], k)
        parts.append(part.select("_item", F.explode(made).alias("_w")).select("_item", "_w.*"))
    return reduce(DataFrame.unionAll, parts).distinct()


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    k: int = 4,
) -> DataFrame:
    """One row per row of ``docs``: ``_id, _h, n_words, n_hit, spans, items``.

    ``spans`` are the merged hit spans ``(first, past)`` in word positions,
    ``items`` the sorted ids, as strings, of the items with a window in the
    document.
    """
    own = items.select(items[item_id].cast("string").alias("_item"), words(items[item_text].cast("string")).alias("_words"))
    size = F.least(F.size("_words"), F.lit(window)).alias("n")
    # At most `window` values.
    lengths = sorted(r.n for r in own.select(size).distinct().collect() if r.n) or [window]
    windows = stage_table(benchmark_windows(own, lengths, window, k), "op10_windows")

    base = keyed(docs, doc_id=doc_id, text=text)
    split = base.select(*KEY, words(F.col("_text")).alias("_words"))
    marks = F.concat(
        *(F.expr(f"transform(array_distinct(_m{n}), x -> struct({n} AS _len, x AS _fp))") for n in lengths)
    )
    prints = stage_table(
        _hashed(split, lengths, k).select(*KEY, F.size("_words").alias("n_words"), marks.alias("_marks")), "op10_prints"
    )
    wanted = windows.select("_len", "_fp").distinct()
    found = (
        prints.select(*KEY, F.explode("_marks").alias("_mark"))
        .select(*KEY, "_mark.*")
        .join(wanted, ["_len", "_fp"], "left_semi")
        .select(*KEY)
        .distinct()
    )
    # Only documents with a common fingerprint go on.
    near = key_join(base, found, "left_semi").dropDuplicates(KEY)
    near = _hashed(near.select(*KEY, words(F.col("_text")).alias("_words")), lengths, k)
    near = stage_table(near, "op10_near")
    at = reduce(
        DataFrame.unionAll,
        (
            near.select(*KEY, F.posexplode(f"_m{n}").alias("_at", "_fp")).select(
                *KEY, F.lit(n).alias("_len"), "_at", "_fp"
            )
            for n in lengths
        ),
    )
    at = at.join(wanted, ["_len", "_fp"], "left_semi").groupBy(*KEY).agg(
        F.collect_list(F.struct("_len", "_at")).alias("_ats")
    )
    cut = F.expr("transform(_ats, a -> struct(a._len, a._at, array_join(slice(_words, a._at + 1, a._len), ' ') AS _win))")
    hits = (
        key_join(near.select(*KEY, "_words"), at, "inner")
        .select(*KEY, F.explode(cut).alias("_hit"))
        .select(*KEY, "_hit.*")
        .join(windows.select("_len", "_win").distinct(), ["_len", "_win"], "left_semi")
    )
    hits = stage_table(hits, "op10_hits")

    run = Window.partitionBy(*KEY).orderBy("_at")
    before = F.max(F.col("_at") + F.col("_len")).over(run.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        hits.select(*KEY, "_at", "_len")
        .distinct()
        .withColumn("_new", F.when(F.col("_at") <= before, 0).otherwise(1))
        .withColumn("_span", F.sum("_new").over(run.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*KEY, "_span")
        .agg(F.min("_at").alias("first"), F.max(F.col("_at") + F.col("_len")).alias("past"))
        .groupBy(*KEY)
        .agg(
            F.sum(F.col("past") - F.col("first")).alias("n_hit"),
            F.array_sort(F.collect_list(F.struct("first", "past"))).alias("spans"),
        )
    )
    named = (
        hits.select(*KEY, "_len", "_win")
        .distinct()
        .join(windows.select("_len", "_win", "_item"), ["_len", "_win"])
        .groupBy(*KEY)
        .agg(F.array_sort(F.collect_set("_item")).alias("items"))
    )
    per_doc = key_join(spans, named, "left")
    return key_join(prints.select(*KEY, "n_words"), per_doc, "left").select(
        *KEY,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.expr("cast(array() AS array<struct<first: int, past: int>>)")).alias("spans"),
        F.coalesce("items", F.expr("cast(array() AS array<string>)")).alias("items"),
    )
