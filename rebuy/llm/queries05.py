"""The registered query of the line dedup and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import table
from rebuy.llm.line_spread import MIN_SITES, drop_spread_lines


def op5_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ``MIN_SITES`` sources or more carry."""
    cleaned = drop_spread_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cleaned.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("text_sha256"),
        F.coalesce("_emptied", F.lit(False)).alias("emptied"),
    )


OP5_SQL = f"""
WITH l AS (
    SELECT doc_id, source, i, ln, trim(ln, E' \\t\\r') AS k
    FROM (SELECT doc_id, source, unnest(string_split(text, E'\\n')) AS ln,
                 unnest(range(len(string_split(text, E'\\n')))) AS i
          FROM documents WHERE text IS NOT NULL)),
b AS (SELECT k, MIN(doc_id * 1000000 + i) AS keeper FROM l WHERE k <> ''
      GROUP BY k HAVING COUNT(DISTINCT coalesce(source, '')) >= {MIN_SITES}),
m AS (SELECT l.*, b.k IS NOT NULL AND b.keeper <> l.doc_id * 1000000 + l.i AS gone FROM l LEFT JOIN b ON l.k = b.k),
c AS (SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_dropped,
             COUNT(*) FILTER (NOT gone AND k <> '') AS n_left,
             string_agg(ln, E'\\n' ORDER BY i) FILTER (NOT gone) AS t FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(c.t, '')) END AS text_sha256,
       coalesce(n_dropped > 0 AND n_left = 0, FALSE) AS emptied
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id
"""

QUERIES = {"op5_line_spread": op5_line_spread}
ORACLES = {"op5_line_spread": OP5_SQL}
