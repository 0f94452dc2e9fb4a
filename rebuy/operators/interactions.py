"""Customer-article history (P7 and the shared ``daily`` / ``pair_history`` steps).

Everything starts from ``daily``: one row per (customer, article, day) with
the number of transaction lines and their quantity. It is a map-side
combined aggregate, so a hot (customer, article, day) collapses to one row
before the shuffle, and every later window over (customer, article) holds at
most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.config import COLS
from rebuy.functions import safe_divide

C, A, D, Q = COLS.customer_id, COLS.article_id, COLS.order_date, COLS.quantity


def valid_rows(tx: DataFrame) -> DataFrame:
    """Rows with a customer, an article and a day; the filter reaches the scan.

    The reference's grouped tables never see a row without a date or key, so
    every operator starts here.
    """
    return tx.where(F.col(C).isNotNull() & F.col(A).isNotNull() & F.col(D).isNotNull())


def daily_lines(tx: DataFrame) -> DataFrame:
    """(c, a, d, n_lines, qty): transaction lines and quantity per article-day
    (a missing quantity counts as 0)."""
    return valid_rows(tx).groupBy(C, A, D).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.coalesce(F.col(Q), F.lit(0))).cast("bigint").alias("qty"),
    )


def pair_history(daily: DataFrame) -> DataFrame:
    """Adds, per (c, a) in date order, in one window pass:

    ``days_with_article`` (running count of days, the reference's
    ``contains_cum``), ``bought_before`` (lines on earlier days),
    ``first_day``, ``prev_day``, ``next_day`` and ``next_n_lines``.
    """
    w = Window.partitionBy(C, A).orderBy(D)
    # Running values share one frame.
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "*",
        F.row_number().over(w).alias("days_with_article"),
        (F.sum("n_lines").over(running) - F.col("n_lines")).alias("bought_before"),
        F.first(D).over(running).alias("first_day"),
        F.lag(D).over(w).alias("prev_day"),
        F.lead(D).over(w).alias("next_day"),
        F.lead("n_lines").over(w).alias("next_n_lines"),
    )


def interaction_columns(pairs: DataFrame) -> list:
    """Closed forms of the row-level interaction features over ``pair_history``.

    * ``times_bought_so_far``: lines up to and including the day.
    * ``avg_gap_days``: the expanding mean of row gaps, maximised over the
      day's rows. Gaps telescope, so it is ``(d - first_day) / bought_before``;
      on the first day it is 0 when the article was bought twice that day and
      null otherwise.
    * ``last_purchase_date``: the latest previous row's date; a same-day
      repeat makes it the day itself.
    """
    days_since_first = F.datediff(F.col(D), F.col("first_day"))
    return [
        (F.col("bought_before") + F.col("n_lines")).alias("times_bought_so_far"),
        F.when(F.col("bought_before") > 0, safe_divide(days_since_first, F.col("bought_before")))
        .when(F.col("n_lines") > 1, F.lit(0.0))
        .otherwise(F.lit(None).cast("double"))
        .alias("avg_gap_days"),
        F.when(F.col("n_lines") > 1, F.col(D)).otherwise(F.col("prev_day")).alias("last_purchase_date"),
    ]


def interaction_features(tx: DataFrame) -> DataFrame:
    """P7: (c, a, d, times_bought_so_far, avg_gap_days, last_purchase_date,
    fraction_orders_with_article) on each day the customer bought the article.

    ``fraction_orders_with_article`` = days with the article so far / the
    customer's order number on that day.
    """
    from rebuy.operators.orders import order_numbers

    pairs = pair_history(daily_lines(tx))
    numbers = order_numbers(valid_rows(tx).select(C, D))
    return pairs.join(numbers, [C, D]).select(
        C,
        A,
        D,
        *interaction_columns(pairs),
        safe_divide(F.col("days_with_article"), F.col("order_index")).alias("fraction_orders_with_article"),
    )
