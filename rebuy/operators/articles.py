"""Article operators (P6): popularity curve, repurchase cycle, peak month.

Popularity is a grouped count plus a running sum; the median cycle and the
peak month come out of one aggregation. All aggregates combine map-side, and
the only window (popularity) runs per article over at most one row per
calendar day, so a best-selling article never puts its raw lines into one
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.config import COLS
from rebuy.operators.interactions import daily_lines, pair_history, valid_rows

C, A, D, Q = COLS.customer_id, COLS.article_id, COLS.order_date, COLS.quantity


def popularity_from_firsts(firsts: DataFrame, first_col: str) -> DataFrame:
    """(a, d, article_popularity): running count of distinct customers,
    with rows only on days that bring a new customer."""
    new = firsts.groupBy(A, F.col(first_col).alias(D)).agg(F.count(F.lit(1)).alias("new_unique_customers"))
    w = Window.partitionBy(A).orderBy(D).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return new.select(A, D, F.sum("new_unique_customers").over(w).alias("article_popularity"))


def article_popularity(tx: DataFrame) -> DataFrame:
    """A5, A6, W8 on raw transactions."""
    firsts = valid_rows(tx).groupBy(A, C).agg(F.min(D).alias("first_buy_date"))
    return popularity_from_firsts(firsts, "first_buy_date")


def article_static_from_pairs(pairs: DataFrame) -> DataFrame:
    """J8, A7, A8 in one aggregation: (a, article_median_repurchase_days,
    article_peak_month INT) for every article.

    * Median day gap between consecutive lines of a (customer, article),
      exact and weighted: over raw lines in date order a pair's gaps are one
      ``d - prev_day`` per later day and a 0 for each extra line on a day. Rows
      are counted by gap first, so ``percentile`` meets a weighted value per
      distinct gap. Null when the article was never rebought.
    * Peak month: the month with most lines; a tie goes to the month met first
      in date order. Lines and first day per month, then the smallest
      (-lines, first day).

    Both counts are one hash aggregate by (article, what is counted, its value)
    with map-side combine, in one pass over the pairs.
    """
    n_lines, day = F.col("n_lines"), F.col(D)
    gap, month = F.datediff(day, F.col("prev_day")), F.month(day)
    parts = F.array(
        F.struct(F.lit(False).alias("by_month"), gap.alias("value"), F.lit(1).cast("bigint").alias("n"),
                 (n_lines - 1).alias("again"), F.lit(None).cast("date").alias("day")),
        F.struct(F.lit(True).alias("by_month"), month.alias("value"), n_lines.alias("n"),
                 F.lit(0).cast("bigint").alias("again"), day.alias("day")),
    )
    counted = pairs.select(A, F.inline(parts)).groupBy(A, "by_month", "value").agg(
        F.sum("n").alias("n"), F.sum("again").alias("again"), F.min("day").alias("day")
    )
    of_month = F.when(F.col("by_month"), F.struct((-F.col("n")).alias("neg_n"), F.col("day"), F.col("value").alias("month")))
    weighted = F.array(
        F.struct(F.when(~F.col("by_month"), F.col("value").cast("double")).alias("gap"), F.col("n").alias("w"), of_month.alias("peak")),
        F.struct(F.lit(0.0).alias("gap"), F.col("again").alias("w"), F.lit(None).cast("struct<neg_n:bigint,day:date,month:int>").alias("peak")),
    )
    return (
        counted.select(A, F.inline(weighted))
        .groupBy(A)
        .agg(
            F.percentile(F.col("gap"), F.lit(0.5), F.col("w")).alias("article_median_repurchase_days"),
            F.min("peak")["month"].cast("int").alias("article_peak_month"),
        )
    )


def repurchase_cycle(tx: DataFrame) -> DataFrame:
    """A7 + W10: (a, article_median_repurchase_days); never-rebought articles absent."""
    static = article_static_from_pairs(pair_history(daily_lines(tx)))
    return static.where(F.col("article_median_repurchase_days").isNotNull()).select(
        A, "article_median_repurchase_days"
    )


def peak_month(tx: DataFrame) -> DataFrame:
    """A8 + X5: (a, article_peak_month)."""
    return article_static_from_pairs(pair_history(daily_lines(tx))).select(A, "article_peak_month")


def article_curve(popularity: DataFrame, static: DataFrame) -> DataFrame:
    """J9: time-varying popularity with the static attributes attached.

    Attached to the curve (at most one row per article-day), not to the
    candidates, so a best-selling article does not skew this join.
    """
    return popularity.join(static, A, "left")


def article_features(tx: DataFrame) -> DataFrame:
    """P6: (a, d, article_popularity, article_median_repurchase_days, article_peak_month)."""
    pairs = pair_history(daily_lines(tx))
    firsts = pairs.where(F.col("days_with_article") == 1)
    return article_curve(popularity_from_firsts(firsts, D), article_static_from_pairs(pairs))
