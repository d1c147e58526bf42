"""Temporal URL lists: an as-of join of captures with dated list entries.

A list is a log of dated entries (list, pattern, action ``add`` or ``remove``,
entry date). Entries become validity intervals [valid_from, valid_to): a
pattern is on a list from the date it is added until the next date it is
removed. A capture is judged by what was active on the day it was fetched.

A pattern is a domain (``example.com``, also for its sub-domains) or a host and
leading path segments (``example.com/a/b``). A capture is blocked if an active
pattern of any other list matches it and none of a list in ``allow`` does.

All steps are DataFrame functions. Captures ask for (key, date) pairs; equal
questions are merged before they are joined, so a host with a third of all
captures asks one question a day, and its history has one row a date at most.

Cases: entries on the same date for the same list and pattern: ``add`` wins;
repeated entries count once; an entry with a null field or another action has
no effect. A capture without URL or time, or whose URL has no host, matches
nothing. Repeated captures are judged each. Host names match without regard to
A-Z case, to a port, to user names and to one trailing dot; paths match
exactly by whole non-empty segments; both hold for patterns too. Columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: scheme, user part, host; and the path after them.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url):
    """Host of a URL in lower case, '' if there is none."""
    lower = F.translate(F.regexp_extract(url, HOST, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(lower, r"\.$", "")


def segments_of(url):
    """Non-empty path segments of a URL."""
    return F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")


def plain_pattern(pattern):
    """A pattern with its host and path segments as ``host_of`` and
    ``segments_of`` give them. One with a scheme, query or fragment is no
    pattern and stays as it is, so that it matches nothing."""
    host = host_of(F.concat(F.lit("http://"), F.regexp_extract(pattern, "^[^/]*", 0)))
    path = segments_of(F.concat(F.lit("http://x"), F.regexp_extract(pattern, "^[^/]*(.*)", 1)))
    other = pattern.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://|[?#]")
    return F.when(pattern.isNull() | other, pattern).otherwise(F.concat_ws("/", F.array(host), path))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) from dated entries, with plain
    patterns; ``valid_to`` is null while the pattern stays on the list. One
    window row per list, pattern and date."""
    e = (entries.select("list", plain_pattern(F.col("pattern")).alias("pattern"), "action", F.col("entry_date").cast("date").alias("entry_date"))
         .where(F.col("action").isin("add", "remove")).dropna()
         .groupBy("list", "pattern", "entry_date").agg(F.max(F.col("action") == "add").alias("on")))
    w = Window.partitionBy("list", "pattern").orderBy("entry_date")
    changes = e.withColumn("was", F.lag("on").over(w)).where(F.col("on") != F.coalesce("was", F.lit(False)))
    return (changes.withColumn("valid_to", F.lead("entry_date").over(w)).where("on")
            .select("list", "pattern", F.col("entry_date").alias("valid_from"), "valid_to"))


def judge_captures(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, time_col: str,
                   allow: tuple[str, ...] = ("allow",)) -> DataFrame:
    """One row per capture: id, url, fetch_date, blocked, allowed, lists (the
    names of the lists with an active match, in order, joined by commas)."""
    intervals = validity_intervals(entries)
    # no pattern has more path segments than this
    depth = entries.agg(F.coalesce(F.max(F.size(F.split("pattern", "/"))), F.lit(1)).alias("n")).scalar()
    rows = captures.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                           F.to_date(F.col(time_col)).alias("fetch_date"))
    labels, host = F.split("host", r"\."), F.col("host")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.transform(F.sequence(F.lit(1), F.size("segments")), lambda i: F.concat_ws("/", host, F.array_join(F.slice("segments", F.lit(1), i), "/")))
    keys = F.when((host != "") & F.col("fetch_date").isNotNull(), F.when(F.size("segments") > 0, F.concat(domains, paths)).otherwise(domains))
    asked = (rows.withColumn("host", host_of(F.col("url"))).withColumn("segments", F.slice(segments_of(F.col("url")), F.lit(1), depth))
             .select("row", "id", "url", "fetch_date", F.explode_outer(keys).alias("key")))
    # one question per key and date
    questions = asked.select("key", "fetch_date").dropna().distinct()
    active = questions.join(intervals, (F.col("key") == F.col("pattern")) & (F.col("valid_from") <= F.col("fetch_date"))
                            & (F.col("valid_to").isNull() | (F.col("fetch_date") < F.col("valid_to"))))
    answers = active.groupBy("key", "fetch_date").agg(F.collect_set("list").alias("lists"))
    judged = asked.join(answers, ["key", "fetch_date"], "left").groupBy("row", "id", "url", "fetch_date").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("lists")))).alias("lists"))
    allowed = F.arrays_overlap("lists", F.array(*map(F.lit, allow)))
    others = F.size(F.filter("lists", lambda x: ~x.isin(*allow))) > 0
    return judged.select("id", "url", "fetch_date", (others & ~allowed).alias("blocked"), allowed.alias("allowed"),
                         F.array_join("lists", ",").alias("lists"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Stand-in captures: the pages table has no fetch time, so each page gets
    an hour of the year 2024 from its number."""
    hours = F.pmod(F.col("page_id") * 7919, F.lit(8784))
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + hours * 3600).alias("fetched_at"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Stand-in list log: every page gives one entry, on its host or its host
    and first path segment, with list, action and day from its number."""
    n, host, first = F.col("page_id"), host_of(F.col("url")), F.get(segments_of(F.col("url")), F.lit(0))
    return pages.select(
        F.element_at(F.array(F.lit("ads"), F.lit("allow"), F.lit("malware")), (F.pmod(n, F.lit(3)) + 1).cast("int")).alias("list"),
        F.when((F.pmod(n, F.lit(2)) == 0) | first.isNull(), host).otherwise(F.concat_ws("/", host, first)).alias("pattern"),
        F.when(F.pmod(n, F.lit(5)) == 0, "remove").otherwise("add").alias("action"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(n * 104729, F.lit(366)).cast("int")).alias("entry_date"))


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's capture judged by the list entries active when it was fetched."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_captures(captures_of(pages), entries_of(pages), "page_id", "url", "fetched_at").withColumnRenamed("id", "page_id")


SQL = r"""
WITH p AS (
  SELECT page_id, url,
         CAST(make_timestamp((1704067200 + (page_id * 7919 % 8784) * 3600) * 1000000) AS DATE) AS fetch_date,
         regexp_replace(translate(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]*)', 1),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '\.$', '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS seg
  FROM pages),
e AS (
  SELECT ['ads', 'allow', 'malware'][page_id % 3 + 1] AS list,
         CASE WHEN page_id % 2 = 0 OR len(seg) = 0 THEN host ELSE host || '/' || seg[1] END AS pattern,
         max(page_id % 5 <> 0) AS is_on, DATE '2024-01-01' + CAST(page_id * 104729 % 366 AS INTEGER) AS entry_date
  FROM p GROUP BY ALL),
k AS (
  SELECT page_id, fetch_date, key FROM (
    SELECT page_id, fetch_date, unnest(list_concat(
      list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
      list_transform(range(1, len(seg) + 1), lambda i: host || '/' || array_to_string(seg[1:i], '/')))) AS key
    FROM p WHERE host <> '')),
a AS (  -- the last entry on or before the fetch, per list
  SELECT k.page_id, e.list, arg_max(e.is_on, e.entry_date) AS is_on
  FROM k JOIN e ON e.pattern = k.key AND e.entry_date <= k.fetch_date GROUP BY k.page_id, e.list, e.pattern),
s AS (SELECT page_id, list_sort(list(DISTINCT list)) AS lists FROM a WHERE is_on GROUP BY page_id)
SELECT p.page_id, p.url, p.fetch_date,
       coalesce(len(list_filter(s.lists, lambda x: x <> 'allow')) > 0 AND NOT list_contains(s.lists, 'allow'), false) AS blocked,
       coalesce(list_contains(s.lists, 'allow'), false) AS allowed,
       coalesce(array_to_string(s.lists, ','), '') AS lists
FROM p LEFT JOIN s USING (page_id)
"""

QUERIES = {"op5_url_lists": op5_url_lists}
ORACLE = {"op5_url_lists": SQL}
