"""The registered query of the whitening (tested against an eigenvalue solver)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rebuy.llm.common import table
from rebuy.llm.whitening import whitened


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every vector."""
    return whitened(table(spark, sf_dir, "embeddings")).withColumnRenamed("_id", "vec_id")


QUERIES = {"op13_whitening": op13_whitening}
ORACLES: dict[str, str] = {}
