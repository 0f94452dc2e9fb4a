"""The registered query of the temporal list join and its SQL.

The tables hold neither fetch days nor a filter list, so both are derived from
all pages: a page's fetch day from its id, and a list log from the hosts,
domains and first path segments that occur, by their MD5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.llm.common import table
from rebuy.llm.list_history import evaluate, url_host, url_path

FIRST_DAY = "2020-01-01"
DAYS = 1461


def _draw(seed: str, value: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), value.cast("string"))), 1, 7), 16, 10).cast("long")


def _day(offset: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), offset.cast("int"))


def captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", _day(_draw("f", F.col("page_id")) % DAYS).alias("fetched"))


def list_log(pages: DataFrame) -> DataFrame:
    """Three of four values were listed once, half of these removed, and a third of those listed again."""
    urls = pages.select(url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p")).filter("h IS NOT NULL")
    labels = F.split("h", r"\.")
    named = urls.select(
        F.explode(
            F.array(
                F.struct(F.lit("host").alias("kind"), F.col("h").alias("value")),
                F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, 2, F.size(labels)), ".").alias("value")),
                F.struct(F.lit("prefix").alias("kind"), F.concat_ws("/", "h", F.get("p", F.lit(0))).alias("value")),
            )
        ).alias("v")
    )
    values = named.select("v.*").filter("value <> ''").distinct().withColumn("x", _draw("l", F.col("value")))
    start = F.col("x") % 1000
    log = F.array(
        F.when(F.col("x") % 4 > 0, F.struct(F.lit("add").alias("action"), start.alias("at"))),
        F.when(F.col("x") % 2 == 1, F.struct(F.lit("remove").alias("action"), (start + 200).alias("at"))),
        F.when(F.col("x") % 6 == 1, F.struct(F.lit("add").alias("action"), (start + 350).alias("at"))),
    )
    return values.select("kind", "value", F.explode(log).alias("e")).filter("e IS NOT NULL").select(
        "kind", "value", "e.action", _day(F.col("e.at")).alias("day")
    )


def op9_list_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list as it was on its fetch day."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = evaluate(captures(pages), list_log(pages), capture_id="page_id", url="url", day="fetched")
    return found.select(
        F.col("capture_id").alias("page_id"), F.col("day").alias("fetched"), "blocked", "n_active", "kind", "value", "since"
    )


OP9_SQL = rf"""
WITH u AS (
    SELECT page_id, url, DATE '{FIRST_DAY}' + CAST(CAST('0x' || substr(md5('f' || page_id), 1, 7) AS BIGINT) % {DAYS} AS INTEGER) AS fetched,
           lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS h,
           list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS p
    FROM pages),
v AS (
    SELECT DISTINCT kind, value, CAST('0x' || substr(md5('l' || value), 1, 7) AS BIGINT) AS x FROM (
        SELECT 'host' AS kind, h AS value FROM u
        UNION ALL SELECT 'domain', array_to_string(list_slice(string_split(h, '.'), 2, len(string_split(h, '.'))), '.') FROM u
        UNION ALL SELECT 'prefix', CASE WHEN len(p) > 0 THEN h || '/' || p[1] ELSE h END FROM u)
    WHERE value <> ''),
e AS (
    SELECT kind, value, 'add' AS action, x % 1000 AS off FROM v WHERE x % 4 > 0
    UNION ALL SELECT kind, value, 'remove', x % 1000 + 200 FROM v WHERE x % 2 = 1
    UNION ALL SELECT kind, value, 'add', x % 1000 + 350 FROM v WHERE x % 6 = 1),
d AS (SELECT kind, value, DATE '{FIRST_DAY}' + CAST(off AS INTEGER) AS day, action FROM e),
k AS (
    SELECT page_id, fetched, 'host' AS kind, h AS value FROM u WHERE h <> ''
    UNION ALL SELECT page_id, fetched, 'domain', array_to_string(list_slice(string_split(h, '.'), i, len(string_split(h, '.'))), '.')
              FROM (SELECT *, unnest(range(1, len(string_split(h, '.')) + 1)) AS i FROM u WHERE h <> '')
    UNION ALL SELECT page_id, fetched, 'prefix', h || '/' || array_to_string(list_slice(p, 1, i), '/')
              FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM u WHERE h <> '')),
s AS (
    SELECT k.page_id, k.kind, k.value, arg_max(d.action, d.day) AS action, MAX(d.day) AS since
    FROM k JOIN d ON k.kind = d.kind AND k.value = d.value AND d.day <= k.fetched GROUP BY ALL),
a AS (
    SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY
               CASE kind WHEN 'prefix' THEN 0 WHEN 'host' THEN 1 ELSE 2 END, length(value) DESC, value) AS r,
           COUNT(*) OVER (PARTITION BY page_id) AS n_active
    FROM s WHERE action = 'add')
SELECT u.page_id, u.fetched, a.page_id IS NOT NULL AS blocked, CAST(coalesce(a.n_active, 0) AS BIGINT) AS n_active,
       a.kind, a.value, a.since
FROM u LEFT JOIN a ON u.page_id = a.page_id AND a.r = 1
"""

QUERIES = {"op9_list_history": op9_list_history}
ORACLES = {"op9_list_history": OP9_SQL}
