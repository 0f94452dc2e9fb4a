"""A training corpus from the documents table, in five stages.

Each stage is a function of the session, the documents that its predecessor
kept and the folder of the tables; its result is written as Parquet and read
again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import key_join, packed, table, unpacked
from rebuy.llm.kneser_ney import classify
from rebuy.llm.line_spread import drop_spread_lines
from rebuy.llm.pfair_mix import mixed
from rebuy.llm.queries10 import is_contaminated
from rebuy.llm.set_join import similar_sets
from rebuy.llm.winnowing import find_contamination
from rebuy.sources.stage import stage_root

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key isn't among the rejected ones."""
    return unpacked(key_join(packed(docs), rejected.select("_id", "_h").distinct(), "left_anti"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is beyond the threshold of their language go."""
    return _without(docs, classify(docs, table(spark, sf_dir, "labels")).filter("rejected"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, and with them documents that had no other line; ``n_chars`` follows the text."""
    cleaned = drop_spread_lines(docs).filter("NOT _emptied")
    changed = F.col("_n_dropped") > 0
    n_chars = F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents linked by a similarity of 0.8 in five-word shingles, one stays.

    That is the document with the smallest id, then the smallest text hash;
    of rows that repeat both, one. Documents without words are linked with
    nothing and stay.
    """
    found = similar_sets(docs, width=5, threshold=80)
    linked = found.filter("component IS NOT NULL")
    first = F.min(F.struct("_id", "_h")).alias("first")
    of = linked.groupBy("component").agg(first, F.count("*").alias("n")).filter("n > 1")
    members = linked.join(of, "component")
    keeps = F.col("_id").eqNullSafe(F.col("first._id")) & (F.col("_h") == F.col("first._h"))
    gone = members.filter(~keeps).select("_id", "_h")
    kept = key_join(packed(docs), gone.distinct(), "left_anti")
    # Repeated rows share the key that is kept, so they are told apart last.
    repeated = members.filter(keeps).groupBy("_id", "_h").agg(F.count("*").alias("_n")).filter("_n > 1")
    marked = key_join(kept, repeated, "left")
    single = marked.filter("_n IS NULL")
    return unpacked(single.unionAll(marked.filter("_n IS NOT NULL").dropDuplicates(["_id", "_h"])))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words lie in benchmark windows go."""
    return _without(docs, find_contamination(docs, table(spark, sf_dir, "benchmark")).filter(is_contaminated()))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its place in the mix of the sources; ordered by slot and place, they are the corpus."""
    return mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents table, each written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    folder = f"{stage_root(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: The string-scored first stage and the schedule of the last can't be written in SQL.
ORACLE_SQL: str | None = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
