"""The registered query of the set join and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import table
from rebuy.llm.set_join import similar_sets


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    found = similar_sets(table(spark, sf_dir, "documents"), width=3, threshold=90)
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


OP2_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
s AS (
    SELECT doc_id, list_distinct(CASE
               WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
    SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) + any_value(b.n) AS n, COUNT(*) AS i
    FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY 1, 2),
l AS (SELECT x, y FROM p WHERE 100 * i >= 90 * (n - i)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM s UNION SELECT l.y, r.c FROM r JOIN l ON r.doc_id = l.x)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, MIN(r.c) AS component_id
FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id
"""

QUERIES = {"op2_ngram_jaccard_join": op2_ngram_jaccard_join}
ORACLES = {"op2_ngram_jaccard_join": OP2_SQL}
