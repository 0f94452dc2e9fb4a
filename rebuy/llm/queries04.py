"""The registered query of the nearest-neighbour operator (recall is tested; SQL can't express the walk)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rebuy.llm.common import table
from rebuy.llm.multi_index import nearest


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every row whose vec_id is divisible by 100."""
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op4_multi_index": op4_multi_index}
ORACLES: dict[str, str] = {}
