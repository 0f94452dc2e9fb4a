"""Order-level and customer timeline operators (P2-P5, A15, W16).

An order is (customer, day): two baskets on one day are one order. Every
window here is over the per-order table, which holds at most one row per
customer per calendar day, so a customer's window partition is bounded by
the number of days in the data, not by how many lines they bought.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.config import COLS
from rebuy.functions import days_between, first_argmax, safe_divide, weekday_monday0
from rebuy.operators.interactions import daily_lines, valid_rows

C, A, D, Q = COLS.customer_id, COLS.article_id, COLS.order_date, COLS.quantity


def _w_orders():
    return Window.partitionBy(C).orderBy(D)


def _running(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def orders_from_daily(daily: DataFrame, first_flag: str | None = None) -> DataFrame:
    """(c, d, basket_size, num_lines[, new_articles]) from ``daily`` rows.

    ``daily`` has one row per (c, a, d), so ``num_lines`` (distinct articles)
    is a plain count. ``first_flag`` names a boolean column marking the
    first day of each (c, a) pair; its count is ``new_articles``.
    """
    aggs = [F.sum("qty").alias("basket_size"), F.count(F.lit(1)).alias("num_lines")]
    if first_flag:
        aggs.append(F.count_if(F.col(first_flag)).alias("new_articles"))
    return daily.groupBy(C, D).agg(*aggs)


def order_level(tx: DataFrame) -> DataFrame:
    """P2: (c, d, basket_size = sum(quantity), num_lines = distinct articles)."""
    return orders_from_daily(daily_lines(tx))


def order_numbers(orders: DataFrame) -> DataFrame:
    """(c, d, order_index, cum_orders) over the distinct (c, d) of ``orders``."""
    keys = orders.select(C, D).distinct()
    w = _w_orders()
    return keys.select(
        C,
        D,
        F.row_number().over(w).cast("bigint").alias("order_index"),
        F.count(F.lit(1)).over(Window.partitionBy(C)).alias("cum_orders"),
    )


def customer_order_columns(w=None) -> list:
    """Window columns of P3 over W(c; d)."""
    w = w or _w_orders()
    idx = F.row_number().over(w).cast("bigint")
    first = F.first(D).over(_running(w))
    return [
        idx.alias("order_index"),
        F.lag(D).over(w).alias("prev_order_date"),
        days_between(F.lag(D).over(w), F.col(D)).alias("days_since_prev_order"),
        # expanding mean of day gaps = (d - first order) / (orders - 1): gaps telescope
        safe_divide(F.datediff(F.col(D), first), idx - 1).alias("avg_days_between_orders"),
        # whole-history count (the reference broadcasts the total to every row)
        F.count(F.lit(1)).over(Window.partitionBy(C)).alias("cum_orders"),
        F.avg("basket_size").over(_running(w)).alias("avg_basket_size"),
    ]


def customer_features(order_baskets: DataFrame) -> DataFrame:
    """P3: order_level + order_index, prev_order_date, days_since_prev_order,
    avg_days_between_orders, cum_orders (whole history), avg_basket_size
    (expanding mean including the current order)."""
    return order_baskets.select("*", *customer_order_columns())


def preferred_dow_column(w=None):
    """Weekday (Monday = 0) with the most orders so far; ties -> lowest weekday."""
    w = _running(w or _w_orders())
    dow = weekday_monday0(D)
    counts = [F.sum(F.when(dow == i, 1).otherwise(0)).over(w) for i in range(7)]
    return first_argmax(counts).alias("preferred_dow")


def dow_preference(order_baskets: DataFrame) -> DataFrame:
    """P5: (c, d, preferred_dow INT)."""
    return order_baskets.select(C, D, preferred_dow_column())


def first_purchases(tx: DataFrame) -> DataFrame:
    """(c, a, first_purchase_date): A3 / A5 / A13."""
    return valid_rows(tx).groupBy(C, A).agg(F.min(D).alias("first_purchase_date"))


def unique_articles_curve(tx: DataFrame) -> DataFrame:
    """P4: (c, d, unique_articles_so_far), only on days with a new article."""
    new = first_purchases(tx).groupBy(C, F.col("first_purchase_date").alias(D)).agg(
        F.count(F.lit(1)).alias("new_unique_count")
    )
    return new.select(C, D, F.sum("new_unique_count").over(_running(_w_orders())).alias("unique_articles_so_far"))


def unique_articles_filled(tx: DataFrame) -> DataFrame:
    """J15 + W9: the curve on every order day, carried forward, else 0.

    A customer's first order always brings a new article, so the curve is a
    running sum of new articles over the dense order table; no fill needed.
    """
    from rebuy.operators.interactions import pair_history

    pairs = pair_history(daily_lines(tx)).withColumn("_first", F.col("days_with_article") == 1)
    orders = orders_from_daily(pairs, "_first")
    return orders.select(
        C, D, F.sum("new_articles").over(_running(_w_orders())).alias("unique_articles_so_far")
    )


def order_timeline(orders: DataFrame) -> DataFrame:
    """All per-order customer features in one window pass over
    (c, d, basket_size, num_lines, new_articles)."""
    w = _w_orders()
    return orders.select(
        C,
        D,
        *customer_order_columns(w),
        F.sum("new_articles").over(_running(w)).alias("unique_articles_so_far"),
        preferred_dow_column(w),
    )


def last_order(tx: DataFrame) -> DataFrame:
    """A15: (c, order_date) of each customer's latest order."""
    return valid_rows(tx).groupBy(C).agg(F.max(D).alias(D))


def next_order(tx: DataFrame) -> DataFrame:
    """W16: (c, d, next_order_date) over distinct orders; null for the last."""
    keys = valid_rows(tx).select(C, D).distinct()
    return keys.select(C, D, F.lead(D).over(_w_orders()).alias("next_order_date"))
