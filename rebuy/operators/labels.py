"""Labels (P10): an article bought in the customer's next order is a positive
for the current order. Positives only; a repeated line in the next order
repeats the label (multiset, as the reference)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.config import COLS
from rebuy.operators.interactions import valid_rows
from rebuy.operators.orders import next_order

C, A, D = COLS.customer_id, COLS.article_id, COLS.order_date


def build_labels(tx: DataFrame) -> DataFrame:
    """(c, d, a, label=1) where d is the order before the one containing a."""
    nxt = next_order(tx).where(F.col("next_order_date").isNotNull())
    lines = valid_rows(tx).select(C, F.col(D).alias("next_order_date"), A)
    return lines.join(nxt, [C, "next_order_date"]).select(C, D, A, F.lit(1).alias("label"))
