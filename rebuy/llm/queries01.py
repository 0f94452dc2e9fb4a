"""The registered query of the toxicity operator (tested on held-out labels)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import table
from rebuy.llm.string_kernel import toxic_labels, toxicity


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that no label is learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def op1_subsequence_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    labels = toxic_labels(table(spark, sf_dir, "labels")).filter(~held_out(F.col("_lid")))
    found = toxicity(table(spark, sf_dir, "documents"), labels)
    return found.select(
        F.col("_id").alias("doc_id"),
        held_out(F.col("_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


QUERIES = {"op1_subsequence_kernel": op1_subsequence_kernel}
ORACLES: dict[str, str] = {}
