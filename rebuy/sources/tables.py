"""Transactions from the TPC-H-style parquet tables.

Mapping: ``customer_id = o_custkey``, ``order_date = date(o_orderdate)``,
``quantity = l_quantity`` (truncated), ``article_id = p_brand`` (or any
lineitem column such as ``l_partkey``, which skips the ``part`` join).
Only the needed columns are read, so the scans prune to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.config import COLS


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions_from_tables(spark: SparkSession, sf_dir: str, article: str = "p_brand") -> DataFrame:
    """``lineitem ⋈ orders (⋈ part)`` as a ``transactions`` frame.

    Inner joins on the keys; Spark picks broadcast or sort-merge from the
    measured sizes (AQE), so nothing here assumes a side is small.
    """
    lineitem = load_table(spark, sf_dir, "lineitem")
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if article.startswith("p_"):
        li = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
        part = load_table(spark, sf_dir, "part").select("p_partkey", article)
        li = li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "l_quantity", F.col(article).alias("_article"))
    else:
        li = lineitem.select("l_orderkey", "l_quantity", F.col(article).alias("_article"))
    tx = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return tx.select(
        F.col("o_custkey").cast("string").alias(COLS.customer_id),
        F.col("_article").cast("string").alias(COLS.article_id),
        F.to_date("o_orderdate").alias(COLS.order_date),
        F.coalesce(F.col("l_quantity").try_cast("bigint"), F.lit(0).cast("bigint")).alias(COLS.quantity),
    )
