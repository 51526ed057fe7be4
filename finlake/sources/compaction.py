"""Compaction of the stream's tables: folders of finished micro-batches merged into segments.

The stream writes a folder per micro-batch and ingest day. A stream that runs every
minute therefore makes 1,440 folders a day, each with a small file, and a full read lists all of
them. ``compact`` merges the batches that are finished into segments:
``<table>_compacted/segment=<low>-<high>/date=<day>``, rows ordered by ``batch_id``, which the files keep as
a column, so that a reader who wants the batches after some id skips row groups. A segment takes
further batches, by being written anew together with them under another name, until it has
``SEGMENT_ROWS`` rows; from then on it is left alone, so a row is rewritten
only while its segment is small.

What counts is the mark (``finlake.sources.marks``): the list of segments and the last batch
in them. It is advanced after a segment is written, so a run that stops has changed nothing for
readers, and the next one writes the same segment again. Readers (``read``) take the segments of
the mark and the loose folders of later batches, named by a few glob patterns; the loose
folders of merged batches are neither listed nor read again. They are left in
place for readers that have already planned on them; the storage's own expiry rule removes them.

The newest micro-batch is never merged: until the next one starts, the stream may replay it.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finlake.sources import lake, marks

#: Rows from which on a segment is left alone.
SEGMENT_ROWS = 50_000_000
MARK = "upto long, segments string"


def segments_path(table: str) -> str:
    return table.rstrip("/") + "_compacted"


def _mark_path(table: str) -> str:
    return table.rstrip("/") + "_compacted_mark"


def segments(spark: SparkSession, table: str) -> tuple[int, list[list[int]]]:
    """The last merged batch (-1: none) and the segments in use: first batch, last batch, rows."""
    mark = marks.newest(spark, _mark_path(table), MARK)
    return (-1, []) if mark is None else (mark.upto, json.loads(mark.segments))


def _segment(table: str, low: int, high: int) -> str:
    return f"{segments_path(table)}/segment={low}-{high}"


def _loose(spark: SparkSession, table: str, schema: StructType, low: int, high: int) -> DataFrame | None:
    """The folders of the batches ``low`` to ``high``, or None if none of them exists."""
    globs = ",".join(lake.range_globs(low, high))
    if not globs:
        return None
    try:
        reader = spark.read.schema(schema).option("basePath", table)
        return reader.parquet(f"{table.rstrip('/')}/batch_id={{{globs}}}")
    except AnalysisException as error:  # these batches wrote no folder
        if marks.is_missing(error):
            return None
        raise


def read(spark: SparkSession, table: str, schema: StructType, after: int, upto: int) -> DataFrame:
    """The rows of the batches ``after`` (exclusive) to ``upto``, wherever they are stored now."""
    merged, listed = segments(spark, table)
    parts = []
    for low, high, rows in listed:
        if rows and high > after and low <= upto:
            # a segment's folder is the base, so that ``date`` is its only partition column
            part = spark.read.schema(schema).parquet(_segment(table, low, high))
            inside = after < low and high <= upto
            parts.append(part if inside else part.where(F.col("batch_id").between(after + 1, upto)))
    loose = _loose(spark, table, schema, max(after, merged) + 1, upto)
    if loose is not None:
        parts.append(loose)
    names = schema.fieldNames()
    empty = spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [p.select(*names) for p in parts]) if parts else empty


def compact(
    spark: SparkSession, table: str, schema: StructType, last_batch: int, segment_rows: int = SEGMENT_ROWS
) -> tuple[int, int] | None:
    """Merge the batches before ``last_batch`` (the newest, which may be replayed) that are not merged yet.

    The last segment is written anew with them while it has fewer than ``segment_rows`` rows. Returns the first and
    last batch of the segment written, or None if there was nothing to merge.
    """
    merged, listed = segments(spark, table)
    high = last_batch - 1
    if high <= merged:
        return None
    low, kept = merged + 1, listed
    if listed and listed[-1][2] < segment_rows:
        low, kept = listed[-1][0], listed[:-1]
    rows = read(spark, table, schema, low - 1, high)
    path = _segment(table, low, high)
    # dealt by day; a day of many rows goes to many tasks, each with a range of batches
    dealt = rows.hint("rebalance", "date").sortWithinPartitions("date", "batch_id")
    lake.write_table(dealt, path, ["date"], replace_all=True, dealt=True)
    # a segment without rows has no folder of a day, and is not read
    n = spark.read.schema(schema).parquet(path).count()
    marks.advance(spark, _mark_path(table), MARK, high, json.dumps([*kept, [low, high, n]]))
    return low, high
