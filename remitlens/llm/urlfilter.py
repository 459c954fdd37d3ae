"""URL filters as a temporal list join, in DataFrame functions only.

A list is dated: entries (kind ``host`` or ``prefix``, key, action ``add`` or ``drop``, day) come and go. Per entry the dated
actions become validity intervals [from, until): an addition holds until the next drop, repeated additions
and drops change nothing. Every capture then asks for all host suffixes of its URL and all path prefixes, by equality, and
a capture is blocked if one of the entries found was active on its day.

The join is on equal keys only. The intervals of a key travel as one sorted array, so a host with a third of all
captures is met by one row and no capture is multiplied by the length of a history; captures are joined
once per different (key, day), counted on the map side, and found again by the same equality.

Defined results: a null or unreadable URL has no host, asks for nothing and is not blocked; a null day is before every entry;
on one day a drop counts after an addition; repeated rows are all returned; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from remitlens.llm.common import table

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")
    return F.when(host != "", host)


def suffixes(host: Column) -> Column:
    """The host and its parent domains of two labels or more: a.b.c -> a.b.c, b.c."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.when(n < 2, F.array(host)).otherwise(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(parts, i, n), ".")))


def prefixes(host: Column, url: Column) -> Column:
    """Host plus each leading part of the path: h/a, h/a/b for h/a/b?x."""
    steps = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")
    n = F.size(steps)
    made = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")))
    return F.when(n > 0, made).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """From (kind, key, action, day): (kind, key, spans), spans sorted [from, until) pairs; an open end is null."""
    day = entries.where("key is not null and day is not null and action in ('add', 'drop')").groupBy("kind", "key", "day").agg(
        F.max("action").alias("action"))  # of both on one day the drop counts
    order = W.partitionBy("kind", "key").orderBy("day")  # dated actions of one entry
    turn = day.withColumn("_last", F.lag("action").over(order)).where("_last is null or _last <> action")
    spans = turn.withColumn("until", F.lead("day").over(order)).where("action = 'add'")
    return spans.groupBy("kind", "key").agg(F.sort_array(F.collect_list(F.struct(F.col("day").alias("from"), "until"))).alias("spans"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures (capture_id, url, day): each with host, blocked, hits (active entries that match) and rule (the longest)."""
    rows = captures.withColumn("host", host_of(F.col("url")))
    asks = F.concat(F.transform(suffixes(F.col("host")), lambda x: F.struct(F.lit("host").alias("kind"), x.alias("key"))),
                    F.transform(prefixes(F.col("host"), F.col("url")), lambda x: F.struct(F.lit("prefix").alias("kind"), x.alias("key"))))
    rows = rows.withColumn("asks", F.when(F.col("host").isNull(), F.array().cast("array<struct<kind:string,key:string>>")).otherwise(asks))
    keys = rows.select("day", F.explode("asks").alias("a")).select("day", "a.kind", "a.key").distinct()
    active = keys.join(intervals(entries), ["kind", "key"]).where(
        F.exists("spans", lambda s: (s["from"] <= F.col("day")) & (s["until"].isNull() | (F.col("day") < s["until"])))).select("kind", "key", "day")
    # one row per page-day and list of asks, so that repeated URLs are judged once
    urls = rows.select("url", "day", "asks").groupBy("url", "day").agg(F.first("asks").alias("asks"))
    found = (urls.select("url", "day", F.explode("asks").alias("a")).select("url", "day", F.col("a.kind").alias("kind"), F.col("a.key").alias("key"))
             .join(active, ["kind", "key", "day"]).groupBy("url", "day")
             .agg(F.count(F.lit(1)).alias("hits"), F.max(F.struct(F.length("key").alias("n"), "key")).alias("best")))
    return rows.join(found, ["url", "day"], "left").select(
        "capture_id", "url", "day", "host", F.coalesce("hits", F.lit(0)).cast("long").alias("hits"), F.col("best.key").alias("rule"), F.col("hits").isNotNull().alias("blocked"))


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures; their fetch day (days since a start) follows from the id, as the table has none."""
    return pages.select(F.col("page_id").alias("capture_id"), "url", F.pmod(F.col("page_id") * 37, F.lit(365)).cast("int").alias("day"))


def page_lists(pages: DataFrame) -> DataFrame:
    """A dated list derived from the hosts and first path steps of the pages: each comes and goes on days drawn from its name."""
    hosts = pages.select(host_of(F.col("url")).alias("host"), "url").where("host is not null")
    keys = hosts.select(F.lit("host").alias("kind"), F.explode(suffixes(F.col("host"))).alias("key")).unionByName(
        hosts.select(F.lit("prefix").alias("kind"), F.explode(F.slice(prefixes(F.col("host"), F.col("url")), 1, 1)).alias("key"))).distinct()
    draw = F.pmod(F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("long"), F.lit(1000)).cast("int")
    keys = keys.withColumn("draw", draw).where("draw % 5 = 0")
    dated = F.array(*[F.struct(F.lit(a).alias("action"), e.cast("int").alias("day")) for a, e in (
        ("add", F.col("draw") % 200), ("drop", F.col("draw") % 200 + 60), ("add", F.col("draw") % 200 + 60 + F.col("draw") % 90), ("drop", F.col("draw") % 200 + 200))])
    return keys.select("kind", "key", F.explode(dated).alias("e")).select("kind", "key", "e.action", "e.day")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(page_captures(pages), page_lists(pages)).withColumnRenamed("capture_id", "page_id")


SQL = r"""
WITH cap AS (
  SELECT page_id, url, CAST(((page_id * 37) % 365 + 365) % 365 AS INTEGER) AS day,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.+$', ''), '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS steps
  FROM pages),
sfx AS (
  SELECT page_id, url, day, host, steps, string_split(host, '.') AS parts FROM cap WHERE host IS NOT NULL),
asks AS (
  SELECT DISTINCT url, day, 'host' AS kind, array_to_string(list_slice(parts, i, len(parts)), '.') AS key, 0 AS i
  FROM (SELECT *, unnest(range(1, greatest(len(parts), 2))) AS i FROM sfx)
  UNION ALL
  SELECT DISTINCT url, day, 'prefix', host || '/' || array_to_string(list_slice(steps, 1, i), '/'), i
  FROM (SELECT *, unnest(range(1, len(steps) + 1)) AS i FROM sfx)),
keys AS (
  SELECT DISTINCT kind, key FROM asks WHERE kind = 'host' OR i = 1),
drawn AS (
  SELECT kind, key, CAST(CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) % 1000 AS INTEGER) AS draw FROM keys),
dated AS (
  SELECT kind, key, 'add' AS action, draw % 200 AS day FROM drawn WHERE draw % 5 = 0 UNION ALL
  SELECT kind, key, 'drop', draw % 200 + 60 FROM drawn WHERE draw % 5 = 0 UNION ALL
  SELECT kind, key, 'add', draw % 200 + 60 + draw % 90 FROM drawn WHERE draw % 5 = 0 UNION ALL
  SELECT kind, key, 'drop', draw % 200 + 200 FROM drawn WHERE draw % 5 = 0),
daily AS (SELECT kind, key, day, max(action) AS action FROM dated GROUP BY ALL),
state AS (
  SELECT a.url, a.day, a.kind, a.key, arg_max(d.action, d.day) AS action
  FROM asks a JOIN daily d ON a.kind = d.kind AND a.key = d.key AND d.day <= a.day GROUP BY ALL),
hit AS (
  SELECT url, day, count(*) AS hits, max({'n': length(key), 'key': key}) AS best FROM state WHERE action = 'add' GROUP BY ALL)
SELECT c.page_id, c.url, c.day, c.host, CAST(coalesce(h.hits, 0) AS BIGINT) AS hits, h.best.key AS rule, h.hits IS NOT NULL AS blocked
FROM cap c LEFT JOIN hit h ON c.url = h.url AND c.day = h.day
"""
