"""The registered query of the WARC operator and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rebuy.llm.common import table
from rebuy.llm.warc import archive_folder, page_records, read_chunks, write_archives


def op6_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page to archives and back; the figures come from the chunks read back."""
    manifest = write_archives(table(spark, sf_dir, "pages"), archive_folder(spark))
    found = page_records(read_chunks(manifest, with_data=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, MAX(page_id) OVER (PARTITION BY d, n) AS keeper FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM g
"""

QUERIES = {"op6_warc_chunks": op6_warc_chunks}
ORACLES = {"op6_warc_chunks": OP6_SQL}
