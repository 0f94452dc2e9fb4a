"""Stage tables: write a shared intermediate once, read it back pruned.

A DataFrame used by several branches of one plan is re-optimised per branch
(each prunes different columns), so Spark cannot reuse its shuffles and
recomputes it, scan included, once per branch. Writing it as parquet under
the cluster's ``spark.checkpoint.dir`` computes it once, cuts the lineage (a
lost executor does not replay the upstream scan), and lets every branch read
only its columns.

Tables of one application live under ``<dir>/rebuy-stage/<application id>``;
``drop_stage_tables`` removes that folder when a job is done with it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from rebuy.session import application_id, ensure_checkpoint_dir


def stage_root(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/rebuy-stage/{application_id(spark)}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to ``<stage root>/<name>-<id>`` and read it back."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_stage_tables(spark: SparkSession) -> bool:
    """Delete this application's stage folder (frames read from it become
    unusable). Returns whether it was there; False on a remote session, which
    has no file system to ask."""
    return drop_path(spark, stage_root(spark))


def drop_path(spark: SparkSession, name: str) -> bool:
    """Delete a folder in whatever store it is; as ``drop_stage_tables``."""
    try:
        sc = spark.sparkContext
    except PySparkException:
        return False
    path = sc._jvm.org.apache.hadoop.fs.Path(name)
    return bool(path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True))


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """For library callers: the stage tables written inside are dropped at the end, whatever happened."""
    try:
        yield
    finally:
        drop_stage_tables(spark)
