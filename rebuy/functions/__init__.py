"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from rebuy.functions.scalar import (
    date_votes,
    days_between,
    first_argmax,
    parse_date,
    parse_quantity,
    safe_divide,
    weekday_monday0,
)

__all__ = [
    "date_votes",
    "days_between",
    "first_argmax",
    "parse_date",
    "parse_quantity",
    "safe_divide",
    "weekday_monday0",
]
