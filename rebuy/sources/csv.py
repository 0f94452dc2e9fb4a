"""CSV ingest: read as text, check the required columns, coerce types.

Bad rows never throw: an unparseable date or an empty id drops the row, and
the number of dropped rows is reported through ``DataFrame.observe`` (filled
in when the first action on the result finishes, no extra job).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rebuy.config import COLS, REQUIRED_COLUMNS, TX_SCHEMA
from rebuy.functions import date_votes, parse_date, parse_quantity
from rebuy.sources.quoted import read_quoted_csv


def check_required(columns: Sequence[str], source: str = "the table") -> None:
    missing = sorted(set(REQUIRED_COLUMNS) - set(columns))
    if missing:
        raise ValueError(f"{source} has no {', '.join(missing)}, only {', '.join(columns)}")


def _as_date(raw: DataFrame, name: str, day_first: bool):
    """Typed columns convert directly; only text goes through parsing."""
    dtype = raw.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(name)
    return parse_date(name, day_first)


def _as_quantity(raw: DataFrame, name: str):
    dtype = raw.schema[name].dataType
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint"))
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.coalesce(F.col(name).try_cast("bigint"), F.lit(0).cast("bigint"))
    return parse_quantity(name)


def vote_day_first(raw: DataFrame, name: str = COLS.order_date) -> bool:
    """Whether days like ``05/01/2024`` are read day first: if more rows can be read so only than month first only."""
    votes = date_votes(name)
    found = raw.select(votes["day"].alias("d"), votes["month"].alias("m")).agg(F.count_if("d").alias("d"), F.count_if("m").alias("m")).first()
    return found["d"] > found["m"]


def coerce_transactions(raw: DataFrame, observation: Observation | None = None, day_first: bool | None = None) -> DataFrame:
    """Text columns -> ``TX_SCHEMA``; rows with a null id or date are dropped.

    ``day_first``: the order of days in numbers, for the whole column; by
    default the column's rows vote in a pass of their own (``vote_day_first``).
    ``observation`` (optional) receives ``rows_in``, ``dropped_null_id`` and
    ``dropped_bad_date``, and the vote: ``day_first``, ``rows_day_first_only``
    and ``rows_month_first_only``.
    """
    check_required(raw.columns)
    is_text = isinstance(raw.schema[COLS.order_date].dataType, T.StringType)
    if day_first is None:
        day_first = is_text and vote_day_first(raw)
    votes = date_votes(COLS.order_date) if is_text else {"day": F.lit(False), "month": F.lit(False)}
    typed = raw.select(
        F.col(COLS.customer_id).cast("string").alias(COLS.customer_id),
        F.col(COLS.article_id).cast("string").alias(COLS.article_id),
        _as_date(raw, COLS.order_date, day_first).alias(COLS.order_date),
        _as_quantity(raw, COLS.quantity).alias(COLS.quantity),
        *(v.alias(f"_{name}") for name, v in votes.items()),
    )
    if observation is not None:
        null_id = F.col(COLS.customer_id).isNull() | F.col(COLS.article_id).isNull()
        typed = typed.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(null_id).alias("dropped_null_id"),
            F.count_if(~null_id & F.col(COLS.order_date).isNull()).alias("dropped_bad_date"),
            F.count_if("_day").alias("rows_day_first_only"),
            F.count_if("_month").alias("rows_month_first_only"),
            F.lit(day_first).alias("day_first"),
        )
    else:
        # A filter right on the parsed columns would be pushed below them and parse every text again, in each place that
        # names it; it stays above a node that counts.
        typed = typed.observe(f"coerced_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows_in"))
    return typed.drop("_day", "_month").dropna(subset=[COLS.customer_id, COLS.article_id, COLS.order_date])


def read_transactions_csv(spark: SparkSession, path: str, observation: Observation | None = None) -> DataFrame:
    """Header CSV -> transactions. Every column is read as text (no inference); quoted fields may hold commas, quotes
    and line breaks (see ``quoted``)."""
    columns = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path).columns
    columns = [c.removeprefix("\ufeff") for c in columns]
    if not columns:
        raise ValueError(f"{path} is empty; columns needed: {sorted(REQUIRED_COLUMNS)}")
    check_required(columns, path)
    out = coerce_transactions(read_quoted_csv(spark, path, columns), observation)
    assert out.schema.simpleString() == TX_SCHEMA.simpleString(), out.schema
    return out
