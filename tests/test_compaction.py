"""Bronze folders merged into segments: the same rows for every reader, few files, safe to stop."""

import datetime as dt

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from finlake.operators.quality import with_quality_flags
from finlake.plans import jobs
from finlake.plans import pipeline as P
from finlake.session import run_dir
from finlake.sources import compaction, fixtures, lake, marks
from finlake.streaming import ingest

BATCHES = 7


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def _batch(spark, sf_dir, paths, n):
    """Micro-batch ``n``, of two ingest days."""
    rows = fixtures.usage_events_raw(spark, sf_dir).where(F.pmod(F.xxhash64("event_id"), F.lit(BATCHES)) == n)
    day = F.when(F.col("org_id").cast("long") % 2 == 0, "20240201").otherwise("20240202")
    stamps = {"ingest_ts": F.lit(dt.datetime(2024, 2, 1)), "date": day, "source_file": F.lit("x"),
              lake.RAW_LINE: F.lit(None).cast("string")}
    batch = with_quality_flags(rows.dropDuplicates(["event_id"]).withColumns(stamps))
    ingest.write_split_batch(batch, n, paths.bronze_events, paths.quarantine, "drop")


def _compact(spark, paths, rows=10**9):
    last = ingest.last_batch(spark, paths.bronze_events).last_batch_id
    return compaction.compact(spark, paths.bronze_events, lake.BRONZE_EVENT, last, rows)


def _read(spark, paths, after=-1, upto=BATCHES - 1):
    return compaction.read(spark, paths.bronze_events, lake.BRONZE_EVENT, after, upto)


@pytest.fixture(scope="module")
def paths(spark, sf_dir):
    paths = P.LakePaths(run_dir(spark, "t-compaction"))
    for n in range(BATCHES):
        _batch(spark, sf_dir, paths, n)
    return paths


def test_ranges_are_the_same_before_and_after(spark, sf_dir, paths):
    ranges = [(-1, BATCHES - 1), (0, 5), (2, 3), (4, 6), (BATCHES - 2, BATCHES - 1), (BATCHES - 1, BATCHES - 1)]
    before = {r: _rows(_read(spark, paths, *r)) for r in ranges}
    assert before[-1, BATCHES - 1] and not before[BATCHES - 1, BATCHES - 1]
    assert _compact(spark, paths) == (0, BATCHES - 2)  # the newest can be replayed
    assert {r: _rows(_read(spark, paths, *r)) for r in ranges} == before
    assert _compact(spark, paths) is None  # nothing is finished since
    files = _read(spark, paths, -1, BATCHES - 2).select(F.input_file_name().alias("f"), "date").distinct()
    assert {r.n for r in files.groupBy("date").agg(F.count("f").alias("n")).collect()} == {1}
    stored = spark.read.schema(lake.BRONZE_EVENT).parquet(paths.bronze_events)
    assert files.join(stored.select(F.input_file_name().alias("f")), "f", "left_semi").isEmpty()


def test_a_small_segment_takes_further_batches_and_a_full_one_does_not(spark, sf_dir):
    paths = P.LakePaths(run_dir(spark, "t-segments"))
    for n in range(3):
        _batch(spark, sf_dir, paths, n)
    assert _compact(spark, paths) == (0, 1)
    _batch(spark, sf_dir, paths, 3)
    assert _compact(spark, paths) == (0, 2)
    rows = compaction.segments(spark, paths.bronze_events)[1][0][2]
    assert rows == _read(spark, paths, -1, 2).count()
    _batch(spark, sf_dir, paths, 4)
    assert _compact(spark, paths, rows) == (3, 3)
    assert [s[:2] for s in compaction.segments(spark, paths.bronze_events)[1]] == [[0, 2], [3, 3]]
    # the batches after 2 are read from the second segment and a loose folder alone
    plan = plan_text(_read(spark, paths, 2, 4))
    assert "segment=3-3" in plan and "segment=0-2" not in plan


def test_a_compaction_that_stops_changes_nothing(spark, sf_dir, monkeypatch):
    paths = P.LakePaths(run_dir(spark, "t-stopped"))
    for n in range(3):
        _batch(spark, sf_dir, paths, n)
    before = _rows(_read(spark, paths, -1, 2))
    with jobs.stopped_after(1), pytest.raises(jobs.Stopped):  # the segment is written, the mark is not
        _compact(spark, paths)
    assert compaction.segments(spark, paths.bronze_events) == (-1, [])
    assert _rows(_read(spark, paths, -1, 2)) == before
    assert _compact(spark, paths) == (0, 1)
    assert _rows(_read(spark, paths, -1, 2)) == before
    # the newest batch is replayed with other rows: they count, as it was not merged
    _batch(spark, sf_dir, paths, 2)
    assert _rows(_read(spark, paths, -1, 2)) == before


def test_batches_without_rows_and_tables_without_batches(spark):
    table = run_dir(spark, "t-none") + "/t"
    assert compaction.read(spark, table, lake.BRONZE_EVENT, -1, 5).isEmpty()
    assert compaction.compact(spark, table, lake.BRONZE_EVENT, 0) is None
    assert compaction.compact(spark, table, lake.BRONZE_EVENT, 3) == (0, 2)  # three batches that wrote no folder
    assert compaction.segments(spark, table) == (2, [[0, 2, 0]])
    assert compaction.read(spark, table, lake.BRONZE_EVENT, -1, 5).isEmpty()
    assert marks.newest(spark, compaction._mark_path(table), compaction.MARK).upto == 2
