"""De-duplication with a deterministic survivor.

All forms are aggregations, so Spark combines copies map-side before the
shuffle: a key holding a third of all rows leaves each task as one row, and
no task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Different hashes that ``few_copies`` broadcasts at most (about 100 MB in memory).
MOST_REPEATED = 2_000_000
_HASH, _MET_AGAIN = "_hash", "_met_again"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (hash aggregate on every column)."""
    return df.dropDuplicates()


def dedup_by_key(
    df: DataFrame,
    keys: list[str],
    order_by: list[str] | None = None,
    keep_null_keys: bool = True,
) -> DataFrame:
    """One row per key; the survivor is the smallest row in a total order.

    The order is ``order_by`` first, then every other column, so the result is
    the same on every run and layout (``dropDuplicates`` keeps an arbitrary
    row). Rows with a NULL in a key are not copies of one another: with
    ``keep_null_keys`` they are all kept, otherwise dropped.
    """
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by or []) + [c for c in rest if c not in (order_by or [])]
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    with_keys = df.where(~any_null)
    if rest:
        packed = F.min(F.struct(*[F.col(c) for c in order])).alias("_keep")
        unique = with_keys.groupBy(*keys).agg(packed).select(
            *keys, *[F.col(f"_keep.{c}").alias(c) for c in order]
        )
    else:
        unique = with_keys.dropDuplicates()
    unique = unique.select(*df.columns)
    if not keep_null_keys:
        return unique
    return unique.unionByName(df.where(any_null))


def few_copies(df: DataFrame, keys: list[str], unique: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``unique(df)`` for a ``unique`` that only ever merges rows with equal ``keys``.

    First only the 64-bit hashes of the keys are shuffled and counted. A row whose hash no other row has is
    no copy and stays where it is; the others (among them rows whose hashes are equal by chance) go through ``unique``
    whole. With more than ``MOST_REPEATED`` hashes of several rows, all rows do. ``df`` is read
    three times, so it should be stored. The repeated hashes stay cached, as the result reads them.
    """
    hashed = df.withColumn(_HASH, F.xxhash64(*[F.col(k) for k in keys]))
    repeated = hashed.groupBy(_HASH).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = repeated.select(_HASH, F.lit(True).alias(_MET_AGAIN)).persist(StorageLevel.MEMORY_AND_DISK)
    if repeated.count() > MOST_REPEATED:
        repeated.unpersist()
        return unique(df)
    told = hashed.join(F.broadcast(repeated), _HASH, "left")
    alone = told.where(F.col(_MET_AGAIN).isNull()).select(*df.columns)
    return alone.unionByName(unique(told.where(F.col(_MET_AGAIN)).select(*df.columns)))
