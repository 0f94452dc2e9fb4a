"""The registered query of the decontamination operator and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import table
from rebuy.llm.winnowing import find_contamination

#: A document is contaminated when at least one word in this many is hit.
SHARE = 20


def is_contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (F.lit(SHARE) * F.col("n_hit") >= F.col("n_words"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item; see ``find_contamination``."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("_id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


OP10_SQL = r"""
WITH dw AS (
    SELECT doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM documents),
bw AS (
    SELECT item_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM benchmark),
win AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n,
           array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM bw WHERE len(w) > 0)),
occ AS (
    SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT o.doc_id, o.n, o.i, win.item_id FROM occ o JOIN win ON o.n = win.n AND o.g = win.g),
nh AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit
       FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY 1),
ni AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(nh.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(ni.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ni.items, '')) AS items_sha256,
       coalesce(nh.n_hit, 0) > 0 AND 20 * coalesce(nh.n_hit, 0) >= len(d.w) AS contaminated
FROM dw d LEFT JOIN nh ON d.doc_id = nh.doc_id LEFT JOIN ni ON d.doc_id = ni.doc_id
"""

QUERIES = {"op10_benchmark_decontamination": op10_benchmark_decontamination}
ORACLES = {"op10_benchmark_decontamination": OP10_SQL}
