"""The registered query of the mixing operator (tested against a scheduler and the Pfair bound)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rebuy.llm.common import table
from rebuy.llm.pfair_mix import mixed


def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the mix of all sources, weighted by the root of their sizes."""
    return mixed(table(spark, sf_dir, "documents"), keep=["doc_id", "source"])


QUERIES = {"op3_pfair_mix": op3_pfair_mix}
ORACLES: dict[str, str] = {}
