"""URL filters by a temporal list join.

A list is a history of dated changes (pattern, action add or remove). Changes become validity intervals, and each capture
is evaluated against the entries that were active when it was fetched. A pattern is a host, which covers its subdomains,
or a host with a directory, which covers what lies below it.

The as-of join is a union of captures and of the starts and ends of intervals, in which each capture takes the last state
of its pattern up to its time. Rows are dealt by (pattern, hour), and every hour that has captures begins with the state
that the pattern had by then, found the same way by (pattern, month), so a host that holds a third of all captures is spread
over its hours; captures of one pattern at one time are one row there, however many they are. No row is listed more often
than a url has patterns, however far apart dates are. Of several active patterns the one with most characters
decides; among equally long ones, the one that sorts last.

Defined cases: a null or unparsable url and a null fetch time match nothing and are kept (not blocked). Changes with a
null in any column are ignored; of changes to one pattern at one time, remove counts as the last. Adding what is active
and removing what is not change nothing. An interval holds from its first instant up to, not including, its end. A very
long url has a pattern for each of its directories, and all count. Repeated captures each stay. Extra columns are ignored;
empty tables give an empty result or one without matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagelight.llm.common import cut, only

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def patterns(url: Column) -> Column:
    """All patterns that cover a url: its host's suffixes of two labels and more, and its host with each directory."""
    name = host(url)
    labels = F.split(name, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.split(F.regexp_extract(url, _PATH, 1), "/")
    depth = F.greatest(F.size(parts) - 2, F.lit(0))
    below = F.when(depth > 0, F.transform(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), lambda i: F.concat(name, F.array_join(F.slice(parts, 1, i + 1), "/"), F.lit("/")))).otherwise(F.array().cast("array<string>"))
    return F.when(name.isNotNull(), F.concat(suffixes, below))


def intervals(changes: DataFrame) -> DataFrame:
    """(pattern, since, until): when each pattern was active; until is null while it still is."""
    dated = only(changes, "pattern", "action", "at").where("pattern is not null and action in ('add', 'remove') and at is not null")
    dated = dated.groupBy("pattern", "at").agg(F.max("action").alias("action"))  # remove sorts after add
    order = Window.partitionBy("pattern").orderBy("at")
    turns = dated.withColumn("was", F.lag("action").over(order)).where("action <> coalesce(was, 'remove')")
    return turns.withColumn("until", F.lead("at").over(order)).where("action = 'add'").select("pattern", F.col("at").alias("since"), "until")


#: Captures are dealt by pattern and the first of these, the beginnings of the first by the second, and so on
BUCKETS = ("hour", "month")


def states(points: DataFrame, turns: DataFrame, buckets: tuple[str, ...]) -> DataFrame:
    """points (pattern, at, ...) with the last state of their pattern in turns (pattern, at, state) up to their time."""
    empty = F.lit(None).cast("struct<since:timestamp>")
    known, group = turns.withColumn("kind", F.lit(1)), [F.col("pattern")]
    if buckets:
        bucket = F.date_trunc(buckets[0], "at")
        begins = states(points.select("pattern", bucket.alias("at")).distinct(), turns, buckets[1:])
        known, group = known.unionByName(begins.where("state is not null").withColumn("kind", F.lit(0))), [*group, bucket]
    all_ = points.withColumn("state", empty).withColumn("kind", F.lit(2)).unionByName(known, allowMissingColumns=True)
    last = F.last("state", ignorenulls=True).over(Window.partitionBy(*group).orderBy("at", "kind"))
    return all_.withColumn("state", last).where("kind = 2").drop("kind")


def evaluate(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """(page_id, fetched_at, host, blocked, pattern, since) for each capture (page_id, url, fetched_at)."""
    rows = cut(only(captures, "page_id", "url", "fetched_at").withColumn("rid", F.monotonically_increasing_id()))  # row numbers stay the same from here on
    active = intervals(changes)
    state = lambda since: F.struct(since.alias("since"))
    begun = active.select("pattern", F.col("since").alias("at"), state(F.col("since")).alias("state"))
    ended = active.where("until is not null").select("pattern", F.col("until").alias("at"), state(F.lit(None).cast("timestamp")).alias("state"))
    turns = begun.unionByName(ended).groupBy("pattern", "at").agg(F.max("state").alias("state"))  # the beginning counts where another ends
    keyed = rows.where("fetched_at is not null").select("rid", F.col("fetched_at").alias("at"), F.explode(patterns(F.col("url"))).alias("pattern"))
    # a state is that of a pattern at a time, whatever number of captures there is: each is found once and joined to them
    found = states(keyed.select("pattern", "at").distinct(), turns, BUCKETS).select("pattern", "at", "state.since").where("since is not null")
    met = keyed.join(found, ["pattern", "at"]).select("rid", "pattern", "since")
    best = met.groupBy("rid").agg(F.max(F.struct(F.length("pattern").alias("n"), "pattern", "since")).alias("b"))
    out = rows.join(best, "rid", "left")
    return out.select("page_id", "fetched_at", host(F.col("url")).alias("host"), F.when(F.col("b").isNotNull(), 1).otherwise(0).alias("blocked"), F.col("b.pattern").alias("pattern"), F.col("b.since").alias("since"))


# The query derives fetch times and list changes from the pages, by fixed rules.

YEAR = 31_536_000
START = "2024-01-01 00:00:00"


def captures_of(pages: DataFrame) -> DataFrame:
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(START)) + F.col("page_id") * 7919 % YEAR)
    return pages.select("page_id", "url", at.alias("fetched_at"))


def changes_of(pages: DataFrame) -> DataFrame:
    """Every twentieth page's host is added to or removed from the list at some time, in turn with its directory."""
    n = F.expr("page_id div 20")
    directory = F.concat(host(F.col("url")), F.lit("/"), F.split_part(F.regexp_extract("url", _PATH, 1), F.lit("/"), F.lit(2)), F.lit("/"))
    some = pages.where("page_id % 20 = 0 and url is not null")
    return some.select(
        F.when(n % 2 == 0, host(F.col("url"))).otherwise(directory).alias("pattern"), F.when(n % 3 == 2, "remove").otherwise("add").alias("action"),
        F.timestamp_seconds(F.unix_timestamp(F.lit(START)) + F.col("page_id") * 104729 % YEAR).alias("at"),
    )


ORACLE = r"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_seconds(page_id * 7919 % 31536000) AS fetched_at,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)), '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), changes AS (
  SELECT CASE WHEN page_id // 20 % 2 = 0 THEN host ELSE host || '/' || split_part(path, '/', 2) || '/' END AS pattern,
         CASE WHEN page_id // 20 % 3 = 2 THEN 'remove' ELSE 'add' END AS action,
         TIMESTAMP '2024-01-01' + to_seconds(page_id * 104729 % 31536000) AS ts
  FROM captures WHERE page_id % 20 = 0 AND url IS NOT NULL
), dated AS (
  SELECT pattern, ts, max(action) AS action FROM changes WHERE pattern IS NOT NULL GROUP BY 1, 2
), turns AS (
  SELECT pattern, ts, action, lag(action) OVER (PARTITION BY pattern ORDER BY ts) AS was FROM dated
), spans AS (
  SELECT pattern, action, ts AS since, lead(ts) OVER (PARTITION BY pattern ORDER BY ts) AS until
  FROM turns WHERE action <> coalesce(was, 'remove')
), met AS (
  SELECT c.page_id, s.pattern, s.since,
         row_number() OVER (PARTITION BY c.page_id ORDER BY length(s.pattern) DESC, s.pattern DESC, s.since DESC) AS r
  FROM captures c JOIN spans s ON s.action = 'add' AND s.since <= c.fetched_at AND (s.until IS NULL OR c.fetched_at < s.until)
   AND ((s.pattern NOT LIKE '%/%' AND (c.host = s.pattern OR ends_with(c.host, '.' || s.pattern)))
     OR (s.pattern LIKE '%/%' AND starts_with(c.host || c.path, s.pattern)))
)
SELECT c.page_id, c.fetched_at, c.host, CASE WHEN m.page_id IS NULL THEN 0 ELSE 1 END AS blocked, m.pattern, m.since
FROM captures c LEFT JOIN met m ON m.page_id = c.page_id AND m.r = 1
"""
