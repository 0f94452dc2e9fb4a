"""Relational operators of the rebuy pipeline, each DataFrame -> DataFrame."""

from rebuy.operators.articles import (
    article_features,
    article_popularity,
    peak_month,
    repurchase_cycle,
)
from rebuy.operators.asof import asof_join
from rebuy.operators.auc import roc_auc
from rebuy.operators.candidates import candidates
from rebuy.operators.interactions import daily_lines, interaction_features, pair_history
from rebuy.operators.labels import build_labels
from rebuy.operators.orders import (
    customer_features,
    dow_preference,
    first_purchases,
    last_order,
    next_order,
    order_level,
    unique_articles_curve,
    unique_articles_filled,
)
from rebuy.operators.topk import top_n_by_group

__all__ = [
    "article_features",
    "article_popularity",
    "asof_join",
    "build_labels",
    "candidates",
    "customer_features",
    "daily_lines",
    "dow_preference",
    "first_purchases",
    "interaction_features",
    "last_order",
    "next_order",
    "order_level",
    "pair_history",
    "peak_month",
    "repurchase_cycle",
    "roc_auc",
    "top_n_by_group",
    "unique_articles_curve",
    "unique_articles_filled",
]
