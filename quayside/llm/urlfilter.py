"""URL filter lists as of the time of each capture.

Dated list entries (add or remove a key) become validity intervals; a capture's keys meet
the intervals that cover its day in an equi-join on key and month, so even a key that
holds a third of the captures is dealt out by time, and captures of one key and day meet
the lists once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import hot_join, materialize

FOREVER = "9999-01-01"
LONGEST_HOST = 253  # characters that a host name can have


def url_host(url: Column) -> Column:
    """Lower-case host of a URL without user and port; null where there is none, or where
    it is longer than a host name can be."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.when((host != "") & (F.length(host) <= LONGEST_HOST), host)


def host_keys(host: Column) -> Column:
    """The host and every parent domain of two labels or more."""
    parts = F.split(host, r"\.")
    deep = F.greatest(F.size(parts) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), deep), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, key, since, until) from entries(list, key, action, day): from each added day
    to the next entry's, until exclusive. On one day a removal outweighs additions; a
    repeated state changes nothing; entries without key, list or day are left out."""
    days = entries.filter("list is not null and key is not null and day is not null").groupBy("list", "key", "day")
    days = days.agg(F.max((F.col("action") == "remove").cast("int")).alias("removed"))
    later = Window.partitionBy("list", "key").orderBy("day")
    held = days.withColumn("until", F.coalesce(F.lead("day").over(later), F.lit(FOREVER).cast("date")))
    return held.filter("removed = 0").select("list", "key", F.col("day").alias("since"), "until")


def filter_captures(captures: DataFrame, entries: DataFrame, horizon: str) -> DataFrame:
    """One row per row of captures(page_id, url, day): page_id, url, host, fetched_on,
    n_lists, matches ('list:key' sorted, comma-joined), blocked.

    A capture is blocked if a list held its host or a parent domain on its day. A null or
    unparsable URL, or a null day, matches nothing. ``horizon`` is a day after the last
    capture; it ends the months that an open interval is dealt to. Repeated captures give
    repeated rows; an empty list blocks nothing, no captures give no rows; other columns
    are ignored. A key's intervals of one month are one row (a day starts at most one per
    list); keys, and hosts of a day, that hold much of the captures are joined by
    broadcast, see ``hot_join``.
    """
    rows = captures.select("page_id", "url", url_host(F.col("url")).alias("host"), F.col("day").alias("fetched_on"))
    idle = F.col("host").isNull() | F.col("fetched_on").isNull()
    asked = rows.filter(~idle).groupBy("host", "fetched_on").agg(F.count(F.lit(1)).alias("rows"))
    asked = materialize(asked, "asked")
    keys = asked.select("host", "fetched_on", F.explode(F.array_distinct(host_keys(F.col("host")))).alias("key"))
    keys = keys.withColumn("month", F.trunc("fetched_on", "month"))

    spans = validity_intervals(entries).withColumn("end", F.least("until", F.lit(horizon).cast("date"))).filter("since < end")
    months = F.sequence(F.trunc("since", "month"), F.trunc(F.date_sub("end", 1), "month"), F.expr("interval 1 month"))
    spans = spans.withColumn("month", F.explode(months))
    spans = spans.groupBy("key", "month").agg(F.collect_list(F.struct("list", "since", "until")).alias("spans"))
    counts = keys.groupBy("key", "month").agg(F.count(F.lit(1)).alias("rows"))
    spans = materialize(spans.join(counts, ["key", "month"]), "spans")

    valid = F.filter("spans", lambda s: (F.col("fetched_on") >= s["since"]) & (F.col("fetched_on") < s["until"]))
    met = hot_join(keys, spans, ["key", "month"], "rows")
    met = met.select("host", "fetched_on", "key", F.explode(valid["list"]).alias("list"))
    found = met.groupBy("host", "fetched_on").agg(
        F.countDistinct("list").alias("n_lists"),
        F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "list", "key"))), ",").alias("matches"),
    )
    found = materialize(asked.join(found, ["host", "fetched_on"], "left"), "found")
    out = hot_join(rows.filter(~idle), found, ["host", "fetched_on"], "rows").unionByName(rows.filter(idle), allowMissingColumns=True)
    return out.select(
        "page_id", "url", "host", "fetched_on",
        F.coalesce("n_lists", F.lit(0)).cast("long").alias("n_lists"),
        F.coalesce("matches", F.lit("")).alias("matches"),
        F.col("n_lists").isNotNull().alias("blocked"),
    )


FIRST_DAY, HORIZON = "2023-01-01", "2025-01-01"


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures, dated by page_id over two years (the table has no dates)."""
    return pages.select("page_id", "url", F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("page_id") * 37 % 730).cast("int")).alias("day"))


def page_entries(pages: DataFrame) -> DataFrame:
    """A list entry from every page: its host (odd ids) or domain, added or, by every
    fourth page, removed, on one of four lists and some day."""
    host = url_host(F.col("url"))
    parts = F.split(host, r"\.")
    domain = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 2, F.lit(1)), 3), ".")
    p = F.col("page_id")
    return pages.select(
        F.concat(F.lit("list"), (p % 4).cast("string")).alias("list"),
        F.when(p % 2 == 1, host).otherwise(domain).alias("key"),
        F.when(F.floor(p / 4) % 4 == 3, "remove").otherwise("add").alias("action"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), (p * 101 % 700).cast("int")).alias("day"),
    )


URL_SQL = """
WITH hosts AS (SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host FROM pages),
base AS (SELECT page_id, url, CASE WHEN host <> '' AND length(host) <= 253 THEN host END AS host FROM hosts),
captures AS (SELECT page_id, url, host, (DATE '2023-01-01' + (page_id * 37 % 730)::INT)::DATE AS fetched_on FROM base),
entries AS (
  SELECT 'list' || (page_id % 4) AS list,
    CASE WHEN page_id % 2 = 1 THEN host ELSE array_to_string(string_split(host, '.')[greatest(len(string_split(host, '.')) - 2, 1):], '.') END AS key,
    (page_id // 4) % 4 = 3 AS removed, (DATE '2023-01-01' + (page_id * 101 % 700)::INT)::DATE AS day
  FROM base WHERE host IS NOT NULL),
days AS (SELECT list, key, day, bool_or(removed) AS removed FROM entries GROUP BY ALL),
spans AS (
  SELECT list, key, removed, day AS since, coalesce(lead(day) OVER (PARTITION BY list, key ORDER BY day), DATE '9999-01-01') AS until FROM days),
asked AS (
  SELECT page_id, fetched_on, array_to_string(parts[i:], '.') AS key
  FROM (SELECT page_id, fetched_on, string_split(host, '.') AS parts FROM captures WHERE host IS NOT NULL) c,
    LATERAL (SELECT unnest(range(1, greatest(len(parts), 2))) AS i) k),
met AS (
  SELECT page_id, count(DISTINCT list) AS n, string_agg(DISTINCT list || ':' || key, ',' ORDER BY list || ':' || key) AS m
  FROM asked JOIN spans USING (key) WHERE NOT removed AND fetched_on >= since AND fetched_on < until GROUP BY 1)
SELECT c.page_id, url, host, fetched_on, coalesce(n, 0)::BIGINT AS n_lists, coalesce(m, '') AS matches, n IS NOT NULL AS blocked
FROM captures c LEFT JOIN met USING (page_id)
"""
