"""Token counts as an exact length histogram.

Documents are encoded once, in Arrow batches, and aggregated by their length in
tokens. Suffix sums over the histogram then answer, for every context limit,
how many documents reach it, how many tokens they hold and how many tokens
remain when every document is cut at the limit; nothing is estimated.

The histogram has a row per distinct length. Its sums are taken at two levels:
lengths are summed in buckets of ``BUCKET``, the few bucket totals get their
sums, and windows within the buckets add to these, so no task sorts the whole
histogram.

The vocabulary is a file of ranks whose path is a parameter. The driver reads
it (at most ``MAX_VOCABULARY`` bytes) and Spark broadcasts it. Tokens are
counted over whole texts; special tokens in a text are ordinary text.

Defined cases: null and empty texts have 0 tokens and count as documents.
Repeated rows count as often as they occur. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.llm.common import pieces, stage_table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY = 64 * 1024 * 1024
BUCKET = 1024

#: How the vocabulary's tokenizer parts a text before merging (fixed with the vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_loaded: dict[int, tiktoken.Encoding] = {}


def encoding(vocabulary: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The tokenizer of a rank file, made once per Python process."""
    name = hash((vocabulary, pattern))
    if name not in _loaded:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        _loaded[name] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[name]


def token_counts(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``n_tokens`` of every row."""
    with open(vocabulary, "rb") as f:
        data = f.read(MAX_VOCABULARY + 1)
    if len(data) > MAX_VOCABULARY:
        raise ValueError(f"{vocabulary} has over {MAX_VOCABULARY} bytes")
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(shared.value, pattern)
        for batch in pieces(batches):
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            sizes = [len(encoder.encode_ordinary(t.decode("utf-8", "replace"))) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n_tokens"])

    return docs.select(docs[text].cast("string").alias("_text")).mapInArrow(count, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per distinct ``n_tokens``, which is also read as a context limit.

    ``n_docs`` documents have this length; ``docs_at_least`` and
    ``tokens_at_least`` cover those of this length or more, ``docs_at_most``
    those that fit the limit whole; ``truncated_total`` are the tokens left
    when each document is cut at the limit, ``tokens_cut`` those lost, and
    ``quantile`` the share of documents that fit.
    """
    counts = stage_table(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "op7_lengths")
    counts = counts.withColumn("bucket", F.expr(f"n_tokens DIV {BUCKET}"))
    tokens = F.col("n_tokens") * F.col("n_docs")
    buckets = counts.groupBy("bucket").agg(F.sum("n_docs").alias("b_docs"), F.sum(tokens).alias("b_tokens"))
    # A row per BUCKET lengths.
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    buckets = buckets.select(
        "bucket",
        F.coalesce(F.sum("b_docs").over(above), F.lit(0)).alias("above_docs"),
        F.coalesce(F.sum("b_tokens").over(above), F.lit(0)).alias("above_tokens"),
        F.sum("b_docs").over(every).alias("all_docs"),
        F.sum("b_tokens").over(every).alias("all_tokens"),
    )
    within = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    summed = counts.join(buckets, "bucket").select(
        "n_tokens",
        "n_docs",
        (F.col("above_docs") + F.sum("n_docs").over(within)).alias("docs_at_least"),
        (F.col("above_tokens") + F.sum(tokens).over(within)).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    short = F.col("all_tokens") - F.col("tokens_at_least")
    cut = short + F.col("n_tokens") * F.col("docs_at_least")
    fit = F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")
    return summed.select(
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        fit.alias("docs_at_most"),
        cut.alias("truncated_total"),
        (F.col("all_tokens") - cut).alias("tokens_cut"),
        (fit / F.col("all_docs")).alias("quantile"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``context_limit, docs_whole, docs_cut, total`` for any limits, from one pass over the histogram."""
    figures = F.array(
        *(
            F.struct(
                F.lit(limit).cast("long").alias("context_limit"),
                F.sum(F.when(F.col("n_tokens") <= limit, F.col("n_docs")).otherwise(0)).alias("docs_whole"),
                F.sum(F.when(F.col("n_tokens") > limit, F.col("n_docs")).otherwise(0)).alias("docs_cut"),
                F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")).alias("total"),
            )
            for limit in limits
        )
    )
    return histogram.agg(figures.alias("f")).select(F.explode("f").alias("f")).select("f.*")


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """``share, n_tokens``: the least length that this share of the documents doesn't exceed."""
    found = F.array(
        *(
            F.struct(
                F.lit(share).alias("share"),
                F.min(F.when(F.col("quantile") >= share, F.col("n_tokens"))).alias("n_tokens"),
            )
            for share in shares
        )
    )
    return histogram.agg(found.alias("f")).select(F.explode("f").alias("f")).select("f.*")
