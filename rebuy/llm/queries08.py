"""The registered query of the quality classifier (tested against a brute-force model and held-out labels)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import table
from rebuy.llm.kneser_ney import classify


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document; trusted text is that labelled as good."""
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("_id").alias("doc_id"), "n_chars", "perplexity", "threshold", "rejected")


QUERIES = {"op8_kneser_ney": op8_kneser_ney}
ORACLES: dict[str, str] = {}
