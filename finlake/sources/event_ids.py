"""The id index of the event stream: which ids have arrived, and on which usage day.

One row per kept event (``event_id``, ``usage_date``) and micro-batch, in folders
``bucket=<hash of the id>/batch_id=<n>``. A look-up names the buckets of the ids it asks
for, so a run with a few new events reads a few buckets, never the events' history.
The number of buckets is part of the path and fixed for an index's life; choose it so that a
bucket of the whole index is some files of 128 MB (``LakePaths.id_buckets``: thousands for 100 TB of
events). A replayed micro-batch replaces its own folders.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.sources.marks import is_missing

#: Buckets of an index, where the caller names no other number.
ID_BUCKETS = 8
SCHEMA = "event_id string, usage_date date, bucket int, batch_id long"


def index_path(good_path: str, buckets: int = ID_BUCKETS) -> str:
    return f"{good_path.rstrip('/')}_ids/of={buckets}"


def bucket_of(event_id: Column, buckets: int = ID_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(event_id), F.lit(buckets)).cast("int")


def asked_buckets(ids: DataFrame, buckets: int = ID_BUCKETS) -> list[int]:
    """The buckets of ``ids``: ``buckets`` small numbers at most."""
    rows = ids.where(F.col("event_id").isNotNull()).select(bucket_of(F.col("event_id"), buckets).alias("b"))
    return sorted(r.b for r in rows.distinct().collect())


def known(spark: SparkSession, good_path: str, ids: DataFrame, buckets: int = ID_BUCKETS) -> DataFrame | None:
    """The index rows in the buckets of ``ids``; None without an index, or where these buckets hold nothing."""
    named = asked_buckets(ids, buckets)
    if not named:
        return None
    path = index_path(good_path, buckets)
    folders = ",".join(str(b) for b in named)
    try:
        return spark.read.schema(SCHEMA).option("basePath", path).parquet(f"{path}/bucket={{{folders}}}")
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise


def has_index(spark: SparkSession, good_path: str, buckets: int = ID_BUCKETS) -> bool:
    try:
        spark.read.schema(SCHEMA).parquet(index_path(good_path, buckets))
        return True
    except AnalysisException as error:
        if is_missing(error):
            return False
        raise


def add(kept: DataFrame, good_path: str, batch_id: int, buckets: int = ID_BUCKETS) -> None:
    """The ids of a micro-batch's kept rows (those with an id and a time). Each task of ``kept`` writes
    a file per bucket that it has."""
    keyed = kept.where(F.col("event_id").isNotNull() & F.col("timestamp").isNotNull())
    rows = keyed.select(
        "event_id", F.to_date("timestamp").alias("usage_date"),
        bucket_of(F.col("event_id"), buckets).alias("bucket"), F.lit(batch_id).cast("long").alias("batch_id"),
    )
    writer = rows.write.mode("overwrite").partitionBy("bucket", "batch_id")
    writer.option("partitionOverwriteMode", "dynamic").parquet(index_path(good_path, buckets))
