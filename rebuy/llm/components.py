"""Connected components over an edge table, by alternating large-star and small-star steps.

No vertex's neighbours are ever gathered in one row: a step takes the least
neighbour of each vertex by a partial aggregate and joins it back, and the
rows of a hub are split by AQE like any skewed join side. Each step is staged,
which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.common import stage_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every vertex of ``edges`` (columns ``u, v``, longs); the root is the component's least vertex."""
    now = stage_table(edges.filter("u <> v").select("u", "v").distinct(), name)
    mark = None
    while True:
        now = stage_table(_small_star(_large_star(now)).filter("u <> v").distinct(), name)
        seen = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
