"""Parquet, JSON and model sinks with a row count taken during the write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, order_by: list[str] | None = None
) -> int:
    """Write ``df`` and return its row count, measured by the write job itself.

    With ``order_by`` the rows are partitioned by ranges of these columns and
    sorted in each, so the files, read in the order of their names, are sorted
    as a whole and their column statistics cut scans by these columns. Enough
    columns should be named that no value of them all is a large share of the
    rows, as a range can't be cut within a value.
    """
    if order_by:
        df = df.orderBy(*order_by)
    obs = Observation("rows_written")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])


def write_feature_list(spark: SparkSession, features: list[str], path: str) -> None:
    """Save the ordered feature list as one JSON row (``{"features": [...]}``)."""
    spark.createDataFrame([(list(features),)], "features array<string>").coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    row = spark.read.schema("features array<string>").json(path).first()
    if row is None:
        raise ValueError(f"No feature list at {path}")
    return list(row["features"])
