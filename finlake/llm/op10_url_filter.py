"""URL filter against dated lists: an as-of join on validity intervals.

A list's history is a set of dated entries: from a day on, a key (a host or one
of its parent domains) is blocked, or is not. Each entry is valid until the
next one of its key. The as-of join lays a key's intervals and the days on which it is asked for
in one order by day (union, then the last interval so far, in a window), so neither a far
date nor a long interval adds a row. Equal questions (key, day) are asked
once, so a key has a row per day of its history and per day of captures at most, whatever share of
the captures it has; the answers are stored and joined back on key and day, where Spark's skew
join splits a hot one. Every capture is evaluated once per key it has (its host and all
parent domains); the longest key with a valid entry decides.

The test tables have no list and no fetch times, so ``captures`` and
``entries`` derive both from every row of ``pages`` (rules in their notes).

Defined results: a URL that is NULL or has no host matches nothing and is not
blocked; a NULL page_id stays NULL and has no fetch time, so it is not
blocked either; of several entries of a key on one day, a block wins; repeated
rows give repeated results; only ``page_id`` and ``url`` are read; an empty
table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import stored

EPOCH = "2024-01-01"
DAYS = 730
FOREVER = "9999-01-01"


def host_of(url: Column) -> Column:
    """The lower-case host, without user, port and trailing dot; NULL without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(F.length(host) > 0, host)


def day(n: Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), F.pmod(n, F.lit(DAYS)).cast("int"))


def captures(pages: DataFrame) -> DataFrame:
    """page_id, url, fetch_date: fetched on day (page_id * 389) mod 730 of the two years."""
    return pages.select("page_id", "url", day(F.col("page_id") * 389).alias("fetch_date"))


def entries(pages: DataFrame) -> DataFrame:
    """key, from_date, blocked. Every page makes one entry, dated day (page_id * 571 + 17)
    mod 730: an address with a query or a fragment is a complaint, which blocks its host; one that ends in
    ``.html`` clears the whole domain (the last three labels); any other clears its host."""
    host = host_of(F.col("url"))
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 2), 3), ".")
    found = pages.select(
        F.when(F.col("url").endswith(".html"), domain).otherwise(host).alias("key"),
        day(F.col("page_id") * 571 + 17).alias("from_date"),
        F.col("url").rlike("[?#]").alias("blocked"),
    )
    return found.where(F.col("key").isNotNull() & F.col("from_date").isNotNull())


def intervals(found: DataFrame) -> DataFrame:
    """key, valid_from, valid_to, blocked: one row per change. Entries of a key and day are
    first made one (a block wins), so a key has at most one row per day of history."""
    daily = found.groupBy("key", "from_date").agg(F.max("blocked").alias("blocked"))
    order = Window.partitionBy("key").orderBy("from_date")
    changed = daily.withColumn("before", F.lag("blocked").over(order))
    changed = changed.where(F.col("before").isNull() | (F.col("before") != F.col("blocked")))
    until = F.coalesce(F.lead("from_date").over(order), F.lit(FOREVER).cast("date"))
    return changed.select("key", F.col("from_date").alias("valid_from"), until.alias("valid_to"), "blocked")


def as_of(asked: DataFrame, valid: DataFrame) -> DataFrame:
    """key, fetch_date, valid_from, blocked: the interval that holds on each day asked for (key, fetch_date)."""
    held = F.struct("valid_from", "valid_to", "blocked").alias("held")
    none = F.lit(None).cast(valid.select(held).schema["held"].dataType)
    changes = valid.select("key", F.col("valid_from").alias("day"), F.lit(0).alias("kind"), held)
    days = asked.select("key", F.col("fetch_date").alias("day"), F.lit(1).alias("kind"), none.alias("held")).distinct()
    order = Window.partitionBy("key").orderBy("day", "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = changes.unionByName(days).withColumn("held", F.last("held", ignorenulls=True).over(order))
    met = met.where((F.col("kind") == 1) & (F.col("day") < F.col("held.valid_to")))
    return met.select("key", F.col("day").alias("fetch_date"), "held.valid_from", "held.blocked")


def suffixes(host: Column) -> Column:
    """The host and its parent domains, the longest first."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def filter_urls(fetched: DataFrame, listed: DataFrame) -> DataFrame:
    """page_id, url, host, fetch_date, list_key, valid_from, blocked of the captures
    (page_id, url, fetch_date) against the list's dated entries (key, from_date, blocked)."""
    seen = fetched.select("page_id", "url", "fetch_date", host_of(F.col("url")).alias("host"))
    # equal host and day have one answer: asked once, however many captures they have
    asked = seen.where(F.col("host").isNotNull() & F.col("fetch_date").isNotNull()).select("host", "fetch_date").distinct()
    keyed = asked.select("host", "fetch_date", F.explode(suffixes(F.col("host"))).alias("key"))
    # a table of its own, so that the join deals both sides and Spark can split a hot key
    found = stored(as_of(keyed, intervals(listed)), "url-answers").select(
        F.col("key").alias("k"), F.col("fetch_date").alias("asked"), "valid_from", "blocked"
    )
    met = keyed.join(found, (F.col("key") == F.col("k")) & (F.col("fetch_date") == F.col("asked")))
    answer = F.max_by(F.struct("key", "valid_from", "blocked"), F.struct(F.length("key"), F.col("valid_from")))
    answers = met.groupBy(F.col("host").alias("h"), F.col("fetch_date").alias("d")).agg(answer.alias("a"))
    same = (F.col("host") == F.col("h")) & (F.col("fetch_date") == F.col("d"))
    return seen.join(answers, same, "left").select(
        "page_id", "url", "host", "fetch_date",
        F.col("a.key").alias("list_key"), F.col("a.valid_from").alias("valid_from"),
        F.coalesce(F.col("a.blocked"), F.lit(False)).alias("blocked"),
    )


SQL = r"""
WITH p AS (
  SELECT page_id, url,
         regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', '') AS host0,
         DATE '2024-01-01' + CAST((page_id * 389) % 730 AS INTEGER) AS fetch_date,
         DATE '2024-01-01' + CAST((page_id * 571 + 17) % 730 AS INTEGER) AS from_date,
         row_number() OVER () AS r
  FROM pages
),
seen AS (SELECT *, CASE WHEN length(host0) > 0 THEN host0 END AS host, string_split(host0, '.') AS labels FROM p),
daily AS (
  SELECT key, from_date, max(b) AS blocked FROM (
    SELECT CASE WHEN url LIKE '%.html' THEN array_to_string(labels[greatest(1, len(labels) - 2):], '.') ELSE host END AS key,
           from_date, CASE WHEN regexp_matches(url, '[?#]') THEN 1 ELSE 0 END AS b
    FROM seen WHERE host IS NOT NULL)
  GROUP BY key, from_date
),
changes AS (
  SELECT *, lag(blocked) OVER (PARTITION BY key ORDER BY from_date) AS before FROM daily
),
valid AS (SELECT key, from_date, blocked FROM changes WHERE before IS NULL OR before <> blocked),
keys AS (
  SELECT r, fetch_date, array_to_string(labels[i:], '.') AS key
  FROM (SELECT r, fetch_date, labels, unnest(range(1, len(labels) + 1)) AS i FROM seen WHERE host IS NOT NULL)
),
met AS (
  SELECT k.r, k.key, v.from_date, v.blocked
  FROM keys k ASOF JOIN valid v ON k.key = v.key AND k.fetch_date >= v.from_date
),
best AS (
  SELECT r, key, from_date, blocked FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY length(key) DESC, from_date DESC) AS n FROM met)
  WHERE n = 1
)
SELECT page_id, url, host, fetch_date, key AS list_key, best.from_date AS valid_from, coalesce(blocked, 0) = 1 AS blocked
FROM seen LEFT JOIN best USING (r)
"""


def filter_pages(pages: DataFrame) -> DataFrame:
    return filter_urls(captures(pages), entries(pages))
