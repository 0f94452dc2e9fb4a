"""Line dedup by distinct-site spread (native DataFrame operations only).

A line that ``MIN_SITES`` sites or more carry is boilerplate, of any length and
however many sites or documents the table has: the same line gets the same
verdict in a small table as in a large one once that many sites hold it, and
with fewer sites than that in all, there is none. Every document gives its distinct
line hashes; a HyperLogLog sketch of the sites is merged per hash by one
aggregation, so a line of a third of all rows costs a sketch per task. Lines
whose estimate is within ``BAND`` of the threshold get an exact distinct count;
with ``LG_K = 12`` the standard error is 1.6 %, so the band is over twelve of
them wide and the decision is exact for all practical purposes.

Of a boilerplate line, the occurrence in the smallest document (by id, then by
text hash, the first position) stays, and all others go: nothing that the
corpus holds is lost as a whole, even where whole documents are copied across
sites.

Lines are what newlines part; they are compared without spaces, tabs and
carriage returns at their ends, by a 64-bit hash. Blank lines are never
boilerplate. Defined cases: null text has no lines and stays null; a null site
is a site of its own; a text without boilerplate stays as it is, byte for
byte; repeated rows are one document, and all its rows keep the same lines.
An empty table gives no rows. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.common import KEY, key_join, keyed, packed, stage_table

#: Sites from which on a line is boilerplate: two may share a line by one copying the other.
MIN_SITES = 3
#: Share of the threshold around it where sites are counted exactly.
BAND = 0.2
LG_K = 12
#: Columns that are added; an input column of such a name gives way.
ADDED = ("_n_lines", "_n_dropped", "_emptied")

_LINES = "split(_text, '\\n', -1)"


def site_spread(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``line`` of every boilerplate line, from rows ``line, site``."""
    sketch = lines.groupBy("line").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"))
    spread = sketch.select("line", F.hll_sketch_estimate("sketch").alias("sites"))
    low, high = min_sites * (1 - BAND), min_sites * (1 + BAND)
    spread = stage_table(spread.filter(F.col("sites") >= low), "op5_spread")
    near = spread.filter(F.col("sites") <= high).select("line")
    exact = (
        lines.join(near, "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count("*").alias("sites"))
        .filter(F.col("sites") >= min_sites)
    )
    return spread.filter(F.col("sites") > high).select("line").unionAll(exact.select("line"))


def drop_spread_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``docs`` with the text cleaned, and ``_n_lines, _n_dropped, _emptied``.

    ``_emptied`` marks documents that had a line and have none left.
    """
    base = keyed(docs, doc_id=doc_id, text=text, site=site)
    hashes = F.expr(
        rf"transform({_LINES}, l -> IF(btrim(l, ' \t\r') = '', CAST(NULL AS bigint), xxhash64(btrim(l, ' \t\r'))))"
    )
    hashed = stage_table(
        base.select(*KEY, F.coalesce(F.col("_site").cast("string"), F.lit("\0")).alias("site"), hashes.alias("hashes")),
        "op5_lines",
    )
    lines = hashed.select(F.explode(F.array_distinct("hashes")).alias("line"), "site").filter("line IS NOT NULL")
    spread = stage_table(site_spread(lines, min_sites), "op5_boilerplate")

    places = hashed.select(*KEY, F.posexplode("hashes").alias("pos", "line")).join(spread, "line", "left_semi")
    places = stage_table(places.distinct(), "op5_places")
    first = places.groupBy("line").agg(F.min(F.struct(*KEY, "pos")).alias("first"))
    joined = places.join(first, "line")
    stays = (
        F.col("_id").eqNullSafe(F.col("first._id"))
        & (F.col("_h") == F.col("first._h"))
        & (F.col("pos") == F.col("first.pos"))
    )
    dropped = joined.filter(~stays).groupBy(*KEY).agg(F.collect_list("pos").alias("_dropped"))

    both = key_join(packed(docs, doc_id, text), dropped, "left")
    # The lines are named once, so they are split once.
    both = both.withColumn("_text", F.col("_row")[text].cast("string")).withColumn("_lines", F.expr(_LINES))
    left = F.expr(
        "array_join(transform(array_except(sequence(0, size(_lines) - 1), _dropped), i -> get(_lines, i)), '\n')"
    )
    changed = both.withColumn("_new", F.when(F.col("_dropped").isNotNull(), left).otherwise(F.col("_text")))
    blank = r"btrim(_new, ' \t\r\n') = ''"
    kept = [c for c in docs.columns if c not in ADDED]
    return changed.select(
        *((F.col("_new") if c == text else F.col("_row")[c]).alias(c) for c in kept),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("_n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("_n_dropped"),
        F.coalesce(F.col("_dropped").isNotNull() & F.expr(blank), F.lit(False)).alias("_emptied"),
    )
