"""The registered query of the piece tokenizer (tested against its library; SQL has none)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import table
from rebuy.llm.merge_rounds import decode_documents, encode_documents


def op11_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    coded = decode_documents(encode_documents(table(spark, sf_dir, "documents")))
    return coded.select(
        F.col("_id").alias("doc_id"),
        F.expr("octet_length(ids) DIV 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op11_merge_rounds": op11_merge_rounds}
ORACLES: dict[str, str] = {}
