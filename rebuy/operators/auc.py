"""Exact ROC AUC (A16) as a DataFrame job.

AUC = sum over distinct scores s of pos(s) * (neg_below(s) + neg(s) / 2) / (P * N),
which gives tied scores half credit (the rank-average rule).

``neg_below`` is a prefix sum in score order. Instead of a single-partition
window over all distinct scores, the scores are cut into slices of about
``SLICE`` distinct scores, as many as the data need up to ``MOST_SLICES``
(beyond, slices grow and their sorts spill): each slice takes a prefix sum of
its own, and one small table of per-slice totals (one row per slice) supplies
the offset of everything in earlier ones.

The bounds are quantiles of the distinct scores. Any bounds give the same
result, as a slice is a range of scores; good ones give slices of like size.
The distinct scores are written once as a stage table, for the bounds, the
totals and the prefix sums, and shuffled once more, by slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebuy.sources.stage import stage_table

#: Distinct scores of a slice: what one task sorts.
SLICE = 200_000
MOST_SLICES = 4_096


def _slice_of(score: Column, bounds: list[float]) -> Column:
    """How many bounds lie below the score, looked up in two steps."""
    step = max(1, int(len(bounds) ** 0.5))
    whole = F.lit(bounds[step - 1 :: step]).cast("array<double>")
    every = F.lit(bounds).cast("array<double>")
    below = lambda of: F.size(F.filter(of, lambda b: b < score))
    first = below(whole) * step
    return first + below(F.slice(every, first + 1, step))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", partitions: int | None = None) -> DataFrame:
    """One row: ``auc`` DOUBLE (null when a class is missing), ``n_pos``, ``n_neg``."""
    pos = F.col(label).cast("int") == 1
    per_score = df.where(F.col(score).isNotNull()).groupBy(score).agg(
        F.count_if(pos).alias("pos"), F.count_if(~pos).alias("neg")
    )
    per_score = stage_table(per_score, "auc_scores")
    in_order = F.col(score).cast("double")
    n = per_score.count()
    slices = min(partitions or max(2, -(-n // SLICE)), MOST_SLICES)
    shares = [i / slices for i in range(1, slices)] or [1.0]
    found = per_score.agg(F.percentile_approx(in_order, shares, 20 * slices).alias("bounds")).first()["bounds"]
    ranged = per_score.withColumn("_pid", _slice_of(in_order, sorted(set(found or [0.0]))))

    totals = ranged.groupBy("_pid").agg(F.sum("neg").alias("part_neg"))
    offsets = totals.select(
        "_pid",
        F.coalesce(
            F.sum("part_neg").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("neg_offset"),
    )
    w_local = Window.partitionBy("_pid").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("_pid", "pos", "neg", F.coalesce(F.sum("neg").over(w_local), F.lit(0)).alias("neg_local"))
    joined = local.join(F.broadcast(offsets), "_pid")
    credit = F.col("pos").cast("double") * (
        F.col("neg_offset") + F.col("neg_local") + F.col("neg").cast("double") / 2.0
    )
    agg = joined.agg(
        F.sum(credit).alias("credit"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")
    )
    return agg.select(
        F.try_divide(F.col("credit"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double")).alias("auc"),
        F.coalesce(F.col("n_pos"), F.lit(0)).cast("bigint").alias("n_pos"),
        F.coalesce(F.col("n_neg"), F.lit(0)).cast("bigint").alias("n_neg"),
    )
