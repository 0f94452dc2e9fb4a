"""The registered query of the clustering (tested against plain k-means)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rebuy.llm.common import table
from rebuy.llm.shallot import clusters, with_inertia


def op12_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after three rounds from sixteen of them."""
    rows, centroids = clusters(table(spark, sf_dir, "embeddings"))
    found = with_inertia(rows, centroids)
    return found.select(
        found["_id"].alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


QUERIES = {"op12_shallot": op12_shallot}
ORACLES: dict[str, str] = {}
