"""Left join of a fact table to a dimension that stays balanced under key skew.

Why not just AQE: the dimensions are de-duplicated on the join key, so their
output is already hash-partitioned on it and Spark reuses that partitioning
for the join. AQE's skew-join split then cannot apply (it needs a plain
shuffle on both sides), and every row of a hot key would meet in one task.

How: one partial-aggregated count per key finds the hot keys, those with more
rows than one task should take (``hot_rows``). Their fact rows are spread over
``ceil(rows / hot_rows)`` salt buckets by a hash of the row (deterministic, so
a retried task salts the same way); the dimension rows of a hot key are
repeated once per bucket; every other key has salt 0. The join then runs on
(key, salt), each bucket in its own task.

``left_join`` needs none of this where the dimension is small: it measures the dimension's
bytes (one aggregated row) and broadcasts it up to ``BROADCAST_BYTES``, so that the facts are neither
shuffled nor counted; a larger dimension takes the salted join.

Fact rows with a NULL key can match nothing, so they get a salt spread over
``NULL_SPREAD`` values instead of all meeting in the task of salt 0.

Bounds: a key is hot only if it also has more than one in ``MOST_HOT_KEYS`` of
all rows, so there are fewer than ``MOST_HOT_KEYS`` hot keys however large the
facts are; that proven bound (a few megabytes) is what allows their table to be
broadcast. The repeated dimension rows add up to at most ``rows / hot_rows`` plus
one per hot key. No row is dropped or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that one task should take at most (about one 128 MB
# partition of narrow rows).
HOT_ROWS = 1_000_000

# Hot keys there can be at most: what bounds the broadcast.
MOST_HOT_KEYS = 100_000

# Facts with a NULL key match nothing, whatever their salt; they are spread
# over this many salts so that a NULL-heavy key does not meet in one task.
NULL_SPREAD = 1 << 16

# A dimension of at most so many bytes is broadcast.
BROADCAST_BYTES = 32 << 20

_SALT, _BUCKETS, ROWS = "_salt", "_buckets", "_n"


def measured_bytes(df: DataFrame) -> int:
    """About how many bytes the rows of ``df`` take in memory: its text, and 16 bytes a value."""
    size = F.lit(0).cast("long")
    for c in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16
    return df.agg(F.sum(size)).first()[0] or 0


def left_join(facts: DataFrame, dim: DataFrame, keys: list[str], hot_rows: int | None = None) -> DataFrame:
    """``facts LEFT JOIN dim USING (keys)`` for a dimension unique on ``keys``: broadcast where its
    measured size allows, salted otherwise."""
    if measured_bytes(dim) <= BROADCAST_BYTES:
        return facts.join(F.broadcast(dim), keys, "left")
    return salted_left_join(facts, dim, keys, hot_rows or HOT_ROWS)


def hot_keys(facts: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and the number of buckets each needs."""
    return hot_of_counts(facts.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS)), keys, hot_rows)


def hot_of_counts(counts: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``hot_keys`` from the number of rows (``ROWS``) of each key."""
    total = counts.agg(F.sum(ROWS).alias("_all"))  # one row
    least = F.greatest(F.lit(hot_rows), F.col("_all") / F.lit(MOST_HOT_KEYS))
    large = counts.where(F.col(ROWS) > hot_rows).crossJoin(F.broadcast(total))
    return large.where(F.col(ROWS) > least).select(
        *keys, F.ceil(F.col(ROWS) / least).cast("int").alias(_BUCKETS)
    )


def salted_left_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``facts LEFT JOIN dim USING (keys)``, with hot keys split over several tasks.

    ``hot`` may be given when the hot keys were counted on an earlier form of
    the facts with the same rows (for example before another left join on a
    unique key), so the facts are not evaluated once more just to count them.
    """
    # Fewer than MOST_HOT_KEYS entries: a proven bound, so it is broadcast.
    hot = F.broadcast(hot if hot is not None else hot_keys(facts, keys, hot_rows))
    row_hash = F.xxhash64(*[F.col(c) for c in facts.columns])
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    salted_facts = facts.join(hot, keys, "left").withColumn(
        _SALT,
        F.when(F.col(_BUCKETS).isNotNull(), F.pmod(row_hash, F.col(_BUCKETS)))
        .when(any_null, F.pmod(row_hash, F.lit(NULL_SPREAD)))
        .otherwise(F.lit(0)),
    ).drop(_BUCKETS)
    buckets = F.when(
        F.col(_BUCKETS).isNotNull(), F.sequence(F.lit(0), F.col(_BUCKETS) - 1)
    ).otherwise(F.array(F.lit(0)))
    salted_dim = (
        dim.join(hot, keys, "left")
        .withColumn(_SALT, F.explode(buckets.cast("array<bigint>")))
        .drop(_BUCKETS)
    )
    joined = salted_facts.join(salted_dim, keys + [_SALT], "left").drop(_SALT)
    return joined
