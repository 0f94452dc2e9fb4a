"""Pieces shared by the text operators of this subpackage.

A document row is told apart by ``(doc_id, hash of its text)``: rows that
repeat both are the same document, rows that share an id but not the text are
different documents, and a null id is a value like any other. Operators read
only the columns they name, under names of their own, so extra columns of the
input can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.sources.stage import stage_table

__all__ = ["KEY", "key_join", "keyed", "lower_ascii", "packed", "pieces", "stage_table", "table", "unpacked"]

#: The columns that name a document inside the operators.
KEY = ["_id", "_h"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read by Spark whatever store it is in."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keyed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **more: str) -> DataFrame:
    """``_id, _h, _text`` and, for each ``name=column`` of ``more``, ``_name``."""
    body = docs[text].cast("string")
    return docs.select(
        docs[doc_id].alias("_id"),
        F.xxhash64(body).alias("_h"),
        body.alias("_text"),
        *(docs[column].alias(f"_{name}") for name, column in more.items()),
    )


def key_join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on ``KEY``, null ids equal; the result keeps the left's key columns."""
    right = right.withColumnsRenamed({k: f"_r{k}" for k in KEY})
    on = left["_id"].eqNullSafe(right["_r_id"]) & (left["_h"] == right["_r_h"])
    return left.join(right, on, how).drop("_r_id", "_r_h")


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that a task's Python objects stay few."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_id, _h, _row``: every row whole, in a struct, so that none of its columns can clash; ``unpacked`` gives them back."""
    body = docs[text].cast("string")
    return docs.select(docs[doc_id].alias("_id"), F.xxhash64(body).alias("_h"), F.struct(*(docs[c] for c in docs.columns)).alias("_row"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("_row.*")


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(column, _UPPER, _LOWER)
