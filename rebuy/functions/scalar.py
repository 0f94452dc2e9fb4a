"""Scalar helpers used by every operator.

Each returns a ``Column`` built from Spark built-ins so that it stays inside
whole-stage codegen. ANSI mode (the Spark 4 default) makes plain casts and
``/`` throw on bad input, so the parsing helpers use ``try_cast`` and the
divider uses ``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_CLOCK = r"([ T]([01]?\d|2[0-3])(:[0-5]\d){0,2}(\.\d+)?\s*(Z|[+-]\d{2}:?\d{2})?)?$"


_NUMBERS = r"^(\d{1,2})([./-])(\d{1,2})\2(\d{4}|\d{2})"
_MONTH = r"([A-Za-z]{3})[a-z]*\.?"


def _year(text: Column) -> Column:
    """Two digits are 1969 to 2068."""
    short = F.when(text >= "69", F.concat(F.lit("19"), text)).otherwise(F.concat(F.lit("20"), text))
    return F.when(F.length(text) == 2, short).otherwise(text)


def _of_numbers(text: Column, day_first: bool) -> Column:
    """``year-month-day`` of ``05/01/2024``, ``5.1.24`` and the like; null for other text."""
    whole = _NUMBERS + _CLOCK
    first, second = (F.regexp_extract(text, _NUMBERS, i) for i in (1, 3))
    month, day = (second, first) if day_first else (first, second)
    return F.when(text.rlike(whole), F.concat_ws("-", _year(F.regexp_extract(text, _NUMBERS, 4)), month, day))


def date_votes(c: Column | str) -> dict[str, Column]:
    """``day`` and ``month``: whether a text is a date if its day, or its month, comes first, and not otherwise."""
    text = F.trim(_col(c).cast("string"))
    day, month = (_of_numbers(text, first).try_cast("date").isNotNull() for first in (True, False))
    return {"day": day & ~month, "month": month & ~day}


def parse_date(c: Column | str, day_first: bool = False) -> Column:
    """Text, date or timestamp -> DATE at day precision; anything else -> null.

    Accepted whole, each with or without a time of day: ``2024-05-01``,
    ``2024/05/01``, ``20240501``; ``05/01/2024``, ``05-01-2024``, ``05.01.2024``
    and ``5/1/24``, of which ``day_first`` says the order; ``May 1, 2024``,
    ``1 May 2024`` and ``01-May-2024``. Trailing text and impossible dates such
    as ``2024-13-01`` give null, as do numbers that are no date in that order.
    """
    text = F.trim(_col(c).cast("string"))

    def iso(pattern: str, order: str) -> Column:
        whole = f"^{pattern}{_CLOCK}"
        return F.when(text.rlike(whole), F.regexp_replace(text, whole, "-".join(f"${group}" for group in order)))

    days = F.lit(None).cast("string")
    for pattern in (r"(\d{4})-(\d{1,2})-(\d{1,2})", r"(\d{4})/(\d{1,2})/(\d{1,2})", r"(\d{4})(\d{2})(\d{2})"):
        days = F.coalesce(days, iso(pattern, "123"))
    named = F.regexp_replace(F.regexp_replace(text, _CLOCK, ""), rf"^(\d{{1,2}})[ -]{_MONTH}[ -](\d{{4}})$", "$2 $1 $3")
    named = F.regexp_replace(named, rf"^{_MONTH}[ -](\d{{1,2}}),?[ -](\d{{4}})$", "$1 $2 $3")
    is_named = named.rlike(r"^[A-Za-z]{3} \d{1,2} \d{4}$")
    month = F.try_to_timestamp(F.when(is_named, F.initcap(named)), F.lit("MMM d yyyy")).cast("date")
    # The texts' first characters say which patterns can fit, and none is tried in vain: they are what costs time here.
    return (
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))
        .when(text.rlike(r"^\d{4}[-/\d]"), days.try_cast("date"))
        .when(text.rlike(r"^\d{1,2}[./-]\d"), _of_numbers(text, day_first).try_cast("date"))
        .when(text.rlike(r"^(\d{1,2}[ -])?[A-Za-z]{3}"), month)
    )


def parse_quantity(c: Column | str) -> Column:
    """Text/number -> BIGINT: bad, NaN or infinite -> 0, decimals truncate toward zero.

    A type suffix as in ``5d`` or ``5f`` is bad text.
    """
    text = F.trim(_col(c).cast("string"))
    # A failing cast throws inside Spark, at some 10 us a row; text without a digit and values beyond BIGINT aren't cast.
    as_double = F.when(text.rlike("[0-9]") & ~text.rlike("[dDfF]$"), text).try_cast("double")
    in_range = F.abs(as_double) <= float(2**63)  # false for NaN, the largest value
    return F.coalesce(F.when(in_range, as_double).try_cast("bigint"), F.lit(0).cast("bigint"))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end`` as DOUBLE; null if either is null."""
    return F.datediff(_col(end), _col(start)).cast("double")


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as DOUBLE; a zero or null divisor gives null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def weekday_monday0(c: Column | str) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6 (INT)."""
    return F.weekday(_col(c))


def first_argmax(values: list[Column]) -> Column:
    """0-based position of the largest value; ties go to the first position."""
    arr = F.array(*values)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")
