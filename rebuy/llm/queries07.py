"""The registered query of the token counts (tested against a brute-force count; SQL has no tokenizer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rebuy.llm.common import table
from rebuy.llm.length_histogram import length_histogram, token_counts


def op7_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of all documents with its suffix sums."""
    return length_histogram(token_counts(table(spark, sf_dir, "documents")))


QUERIES = {"op7_length_histogram": op7_length_histogram}
ORACLES: dict[str, str] = {}
