"""The event stream: reruns, new files, replays, and equality with the batch form."""

from pyspark.sql import functions as F

from finlake.operators import quality
from finlake.plans.pipeline import LakePaths, ingest_events
from finlake.session import run_dir
from finlake.sources import fixtures, lake, landing

COLS = ["event_id", "timestamp", "metric", "value", "unit", "is_quarantine"]


def _rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.select(*COLS).collect())


def test_stream_equals_batch_and_rerun_adds_nothing(spark, sf_dir):
    paths = LakePaths(run_dir(spark, "t-stream"))
    raw = fixtures.usage_events_raw(spark, sf_dir)
    landing.write_jsonl(raw, paths.landing_stream)
    ingest_events(spark, paths)
    good = lake.read_bronze_events(spark, paths.bronze_events)
    bad = lake.read_bronze_events(spark, paths.quarantine)
    b_good, b_bad = quality.ingest_events_split(raw)
    assert _rows(good) == _rows(b_good)
    assert _rows(bad) == _rows(b_bad)
    n = good.count() + bad.count()
    ingest_events(spark, paths)  # same files, same checkpoint
    assert lake.read_bronze_events(spark, paths.bronze_events).count() + \
        lake.read_bronze_events(spark, paths.quarantine).count() == n


def test_new_file_adds_only_new_ids(spark, sf_dir):
    paths = LakePaths(run_dir(spark, "t-stream2"))
    raw = fixtures.usage_events_raw(spark, sf_dir).where(F.col("event_id").isNotNull()
                                                         & F.col("timestamp").isNotNull())
    first = raw.where(F.col("event_id").cast("long") < 500)
    landing.write_jsonl(first, paths.landing_stream + "/part1")
    ingest_events(spark, paths)
    n1 = lake.read_bronze_events(spark, paths.bronze_events).count()
    # second drop: everything (old ids replayed plus new ones)
    landing.write_jsonl(raw, paths.landing_stream + "/part2")
    ingest_events(spark, paths)
    good = lake.read_bronze_events(spark, paths.bronze_events)
    assert good.count() > n1
    assert good.count() == good.select("event_id").distinct().count()
    expected = quality.ingest_events_split(raw)[0].count()
    assert good.count() == expected
    assert good.select("batch_id").distinct().count() == 2


def test_bounded_mode_runs(spark, sf_dir):
    paths = LakePaths(run_dir(spark, "t-stream3"))
    landing.write_jsonl(fixtures.usage_events_raw(spark, sf_dir), paths.landing_stream)
    ingest_events(spark, paths, late="drop")
    good = lake.read_bronze_events(spark, paths.bronze_events)
    assert good.count() == good.select("event_id").distinct().count() > 0


def test_dropped_by_watermark_and_rocksdb(spark, sf_dir):
    from finlake.session import ROCKSDB_PROVIDER
    from finlake.streaming.ingest import dropped_by_watermark, run_ingest_once

    paths = LakePaths(run_dir(spark, "t-stream4"))
    landing.write_jsonl(fixtures.usage_events_raw(spark, sf_dir), paths.landing_stream)
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        q = run_ingest_once(spark, paths.landing_stream, paths.bronze_events, paths.quarantine,
                            paths.stream_checkpoint)
    finally:
        if old:
            spark.conf.set(key, old)
        else:
            spark.conf.unset(key)
    assert dropped_by_watermark(q) == 0
    assert lake.read_bronze_events(spark, paths.bronze_events).count() > 0


def test_archive_processed_files(spark, sf_dir):
    import glob

    from finlake.streaming.ingest import run_ingest_once

    paths = LakePaths(run_dir(spark, "t-archive"))
    raw = fixtures.usage_events_raw(spark, sf_dir)
    landing.write_jsonl(raw.where("metric = 'requests'"), paths.landing_stream + "/drop1")
    archive = paths.root + "/archive"
    args = (paths.landing_stream, paths.bronze_events, paths.quarantine, paths.stream_checkpoint)
    run_ingest_once(spark, *args, archive_dir=archive)
    drop1 = glob.glob(paths.landing_stream + "/drop1/*.json")
    assert drop1
    # files of a batch are moved once a later batch commits
    landing.write_jsonl(raw.where("metric <> 'requests'"), paths.landing_stream + "/drop2")
    run_ingest_once(spark, *args, archive_dir=archive)
    assert not glob.glob(paths.landing_stream + "/drop1/*.json")
    assert len(glob.glob(archive + "/**/drop1/*.json", recursive=True)) == len(drop1)
    assert lake.read_bronze_events(spark, paths.bronze_events).count() > 0


def test_late_rows_kept_by_default_dropped_and_counted_when_bounded(spark, sf_dir):
    import datetime as dt

    from finlake.streaming.ingest import dropped_by_watermark, run_ingest_once

    raw = fixtures.usage_events_raw(spark, sf_dir).where(
        F.col("event_id").isNotNull() & F.col("timestamp").isNotNull())
    recent = raw.where(F.col("timestamp") >= F.lit(dt.datetime(2024, 1, 20)))
    late = raw.where(F.col("timestamp") < F.lit(dt.datetime(2024, 1, 5)))  # other ids, much older
    n_late = late.count()  # rows, replayed copies included
    n_late_ids = late.select("event_id").distinct().count()
    counts = {}
    for bounded in (False, True):
        late_rows = "drop" if bounded else "keep"
        paths = LakePaths(run_dir(spark, f"t-late-{bounded}"))
        landing.write_jsonl(recent, paths.landing_stream + "/drop1")
        args = (paths.landing_stream, paths.bronze_events, paths.quarantine, paths.stream_checkpoint)
        run_ingest_once(spark, *args, late=late_rows)
        landing.write_jsonl(late, paths.landing_stream + "/drop2")
        q = run_ingest_once(spark, *args, late=late_rows)
        out = lake.read_bronze_events(spark, paths.bronze_events).unionByName(
            lake.read_bronze_events(spark, paths.quarantine))
        counts[bounded] = (out.count(), dropped_by_watermark(q))
    exact_rows, exact_dropped = counts[False]
    bounded_rows, bounded_dropped = counts[True]
    assert exact_dropped == 0
    assert bounded_dropped == n_late  # every late row, copies included, is dropped
    assert exact_rows - bounded_rows == n_late_ids  # exact mode keeps one row per late id
