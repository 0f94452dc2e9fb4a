"""URL filters by a temporal list join.

A filter list is a log of dated entries that add or remove a value. Its log
becomes *validity intervals*: per value, the last word of each day holds from
that day to the day of the value's next entry. A capture is evaluated against
the entries active on the day it was fetched, so a verdict can be repeated
later whatever the list has become.

A value is a ``domain`` (matches the host and all its subdomains), a ``host``
(that host alone) or a ``prefix`` (``host/path`` up to a whole path segment).
Each capture gives one key per value that could match it, and an equi-join on
the key meets the interval that holds on its day. Intervals are cut at the
ends of ``SLICE_DAYS``, and the slice is part of the join key: a value with a
long history or a host with a third of all captures meets at most
``SLICE_DAYS`` intervals a row, and AQE may split the captures of a hot key,
since the interval side has one row per key and day.

Defined cases: on one day, a removal beats an addition of the same value.
Entries without kind, value, action or day, or with another kind or action,
are no entries. A capture without URL or day, or whose URL has no host,
matches nothing and is kept as not blocked. Hosts are compared in lower case;
user names, ports, queries and fragments of a URL are left out. Repeated
captures each get the result. Empty tables give no rows, or no match. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebuy.llm.common import stage_table

SLICE_DAYS = 366

#: From the most to the least specific.
KINDS = ("prefix", "host", "domain")


def url_host(url: Column) -> Column:
    """The host in lower case; null without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def url_path(url: Column) -> Column:
    """The path's segments, without empty ones."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.array_remove(F.split(path, "/"), "")


def url_keys(host: Column, path: Column) -> Column:
    """``kind, value`` of every list value that could match."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value")),
    )
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(path)), lambda i: i > 0),
        lambda i: F.struct(
            F.lit("prefix").alias("kind"), F.concat_ws("/", host, F.array_join(F.slice(path, 1, i), "/")).alias("value")
        ),
    )
    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("value")))
    return F.concat(domains, prefixes, own)


def intervals(entries: DataFrame) -> DataFrame:
    """``kind, value, since, until`` (until not included, null while active) of all times a value was listed."""
    said = entries.select("kind", "value", "action", F.col("day").cast("date").alias("day"))
    said = said.filter(
        F.col("kind").isin(*KINDS) & F.col("action").isin("add", "remove") & F.col("value").isNotNull() & F.col("day").isNotNull()
    )
    daily = said.groupBy("kind", "value", "day").agg(F.max("action").alias("action"))  # "remove" is the greater word
    order = Window.partitionBy("kind", "value").orderBy("day")
    held = daily.withColumn("until", F.lead("day").over(order)).filter(F.col("action") == "add")
    return held.select("kind", "value", F.col("day").alias("since"), "until")


def _slice(day: Column) -> Column:
    return F.floor(F.unix_date(day) / F.lit(SLICE_DAYS))


def evaluate(captures: DataFrame, entries: DataFrame, *, capture_id: str, url: str, day: str) -> DataFrame:
    """``capture_id, url, day`` with ``blocked, n_active, kind, value, since`` of the most specific active entry.

    The longest value decides within a kind.
    """
    rows = captures.select(
        captures[capture_id].alias("_id"), captures[url].cast("string").alias("_url"), captures[day].cast("date").alias("_day")
    )
    rows = stage_table(rows, "op9_captures")
    seen = rows.agg(F.max("_day").alias("last")).first()
    held = intervals(entries)
    # An interval goes on to the last capture at most.
    last = F.least(F.coalesce(F.date_sub("until", 1), F.lit(seen.last)), F.lit(seen.last)).cast("date")
    cut = held.filter(F.col("since") <= last).withColumn("slice", F.explode(F.sequence(_slice(F.col("since")), _slice(last))))

    wanted = rows.distinct().select("_id", "_url", "_day", url_host(F.col("_url")).alias("h"), url_path(F.col("_url")).alias("p"))
    keys = wanted.filter("h IS NOT NULL AND _day IS NOT NULL").select(
        "_id", "_url", "_day", F.explode(url_keys(F.col("h"), F.col("p"))).alias("k")
    )
    keys = keys.select("_id", "_url", "_day", "k.*", _slice(F.col("_day")).alias("slice"))
    active = keys.join(cut, ["kind", "value", "slice"]).filter(
        (F.col("since") <= F.col("_day")) & (F.col("until").isNull() | (F.col("_day") < F.col("until")))
    )
    rank = F.when(F.col("kind") == KINDS[0], 0).when(F.col("kind") == KINDS[1], 1).otherwise(2)
    first = F.min(F.struct(rank, -F.length("value"), "value", "kind", "since"))
    verdict = active.groupBy("_id", "_url", "_day").agg(F.count("*").alias("n_active"), first.alias("first"))
    verdict = verdict.toDF("_rid", "_rurl", "_rday", "n_active", "first")
    on = rows["_id"].eqNullSafe(verdict["_rid"]) & (rows["_url"] == verdict["_rurl"]) & (rows["_day"] == verdict["_rday"])
    return rows.join(verdict, on, "left").select(
        F.col("_id").alias("capture_id"),
        F.col("_url").alias("url"),
        F.col("_day").alias("day"),
        F.col("n_active").isNotNull().alias("blocked"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("first.kind").alias("kind"),
        F.col("first.value").alias("value"),
        F.col("first.since").alias("since"),
    )
