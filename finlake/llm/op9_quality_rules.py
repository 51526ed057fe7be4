"""Quality rules of a document, and verdicts on hosts shrunk towards a common rate.

Each text gets base counts and a base verdict. The base failures are summed by
host (here the ``source`` column), every host's failure rate is shrunk with a
beta prior fitted to all hosts by the method of moments, and a host that fails far more often
than the others, beyond doubt, takes its documents with it: its rate r is
above ``ratio`` times the pooled rate m even less ``doubt`` standard deviations of its posterior.

Prior: with k failures of n documents per host, m = sum(k) / sum(n) and
v = sum(n * (k / n - m)^2) / sum(n); strength s = m * (1 - m) / v - 1, held
between 1 and ``MAX_STRENGTH``; a = m * s, b = (1 - m) * s. The shrunk rate is
(k + a) / (n + a + b), its variance r * (1 - r) / (n + a + b + 1). A host of a few documents
is thus near the pooled rate and in doubt, and a host with ordinary rates is kept however many
documents make its rate certain.

Defined results: a NULL or empty text has no words and fails the base rules; a
NULL source belongs to no host and gets no host verdict; a NULL ``doc_id``
stays NULL; repeated rows give repeated results; only ``doc_id``, ``text`` and
the host column are read; an empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import by_batch, stored

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MAX_STRENGTH = 1e6
#: A host goes if its failure rate is surely (by DOUBT standard deviations) above RATIO times the pooled one.
RATIO, DOUBT = 2.0, 3.0
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words in windows of ``size`` words that are found twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(n, np.uint64)
    for k in range(size):
        window *= np.uint64(0x9E3779B97F4A7C15)
        window += codes[k : n + k]
        window ^= window >> np.uint64(29)
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    likely = np.flatnonzero(np.isin(window, twice))  # by hash; the words themselves decide
    found = Counter(tuple(words[i : i + size]) for i in likely)
    marked = np.zeros(len(words) + 1, np.int64)
    for i in likely:
        if found[tuple(words[i : i + size])] > 1:
            marked[i] += 1
            marked[i + size] -= 1
    return int((np.cumsum(marked) > 0).sum())


def text_counts(text: str) -> tuple[int, int, int, int, int]:
    words = text.encode().split()  # bytes split at ASCII white space only
    lines = [x for x in text.split("\n") if x.strip(SPACES)] if "\n" in text else []
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the base counts."""
    key, at = (docs.schema[c].dataType.simpleString() for c in ("doc_id", host))

    def work(batch: pa.RecordBatch):
        found = [text_counts(t or "") for t in batch.column("text").to_pylist()]
        columns = [pa.array(c, pa.int64()) for c in zip(*found)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), *columns], ["doc_id", "host", *COUNTS]
        )

    schema = f"doc_id {key}, host {at}, " + ", ".join(f"{c} long" for c in COUNTS)
    return by_batch(docs.select("doc_id", F.col(host).alias("host"), "text"), work, schema)


def host_rates(judged: DataFrame) -> DataFrame:
    """host, n, k, shrunk rate, its deviation, pooled rate; ``judged`` has host and base_failed."""
    hosts = (
        judged.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("k"))
    )
    total = hosts.agg((F.sum("k") / F.sum("n")).alias("m"))
    spread = hosts.crossJoin(F.broadcast(total)).agg(  # one row, beside the hosts
        F.max("m").alias("m"),
        (F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("m"), 2)) / F.sum("n")).alias("v"),
    )
    m, v = F.col("m"), F.col("v")
    strength = F.when(v > 0, F.greatest(F.lit(1.0), F.least(F.lit(MAX_STRENGTH), m * (1 - m) / v - 1)))
    prior = spread.select("m", F.coalesce(strength, F.lit(MAX_STRENGTH)).alias("s"))
    rate = (F.col("k") + F.col("m") * F.col("s")) / (F.col("n") + F.col("s"))
    rated = hosts.crossJoin(F.broadcast(prior)).withColumn("rate", rate)  # one row, beside the hosts
    spread_of = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("s") + 1))
    return rated.select("host", "n", "k", "rate", spread_of.alias("deviation"), F.col("m").alias("pooled"))


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    min_words: int = 20,
    max_repeated: int = 30,
    ratio: float = RATIO,
    doubt: float = DOUBT,
) -> DataFrame:
    """doc_id, the base counts, base_failed, host_rate, host_failed, kept."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    judged = stored(base_counts(docs, host).withColumn("base_failed", failed), "rules")
    sure = F.col("rate") - doubt * F.col("deviation") > ratio * F.col("pooled")
    rates = host_rates(judged).select(F.col("host").alias("rated"), F.col("rate").alias("host_rate"), sure.alias("sure"))
    joined = judged.join(rates, F.col("host") == F.col("rated"), "left")
    host_failed = F.coalesce(F.col("sure"), F.lit(False)).alias("host_failed")
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("sure"), F.lit(False))
    return joined.select("doc_id", *COUNTS, "base_failed", "host_rate", host_failed, kept.alias("kept"))


SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         row_number() OVER () AS r
  FROM documents
),
windows AS (
  SELECT r, i, array_to_string(list_slice(words, i, i + 7), ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM docs WHERE len(words) > 8)
),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM windows) WHERE c > 1
),
repeated AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r
),
lines AS (
  SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r
),
base AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM docs LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)
),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS k
  FROM judged WHERE source IS NOT NULL GROUP BY source
),
total AS (SELECT sum(k) / sum(n) AS m FROM hosts),
spread AS (SELECT max(m) AS m, sum(n * pow(k / n - m, 2)) / sum(n) AS v FROM hosts, total),
prior AS (
  SELECT m, CASE WHEN v > 0 THEN greatest(1, least(1e6, m * (1 - m) / v - 1)) ELSE 1e6 END AS s FROM spread
),
rates AS (SELECT source, n, m, s, (k + m * s) / (n + s) AS rate FROM hosts, prior),
verdicts AS (SELECT source, rate - 3 * sqrt(rate * (1 - rate) / (n + s + 1)) > 2 * m AS host_failed FROM rates)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_failed, FALSE) AS kept
FROM judged LEFT JOIN verdicts USING (source)
"""
