"""Repeat-purchase ("rebuy") analytics on Spark.

Point-in-time customer, article and customer-article features, next-order
labels, a boosted-tree model and top-N recommendations, all expressed as lazy
DataFrame plans. See README.md for the layout.
"""

from rebuy.config import COLS, FEATURE_COLUMNS, TX_SCHEMA

__all__ = ["COLS", "FEATURE_COLUMNS", "TX_SCHEMA"]
