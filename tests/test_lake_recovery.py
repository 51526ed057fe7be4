"""Runs that stop anywhere, marks that are lost, and what an increment reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from finlake.operators import joins, quality, silver
from finlake.plans import jobs
from finlake.plans import pipeline as P
from finlake.session import run_dir
from finlake.sources import event_ids, fixtures, lake, landing, marks, serving
from finlake.streaming import ingest

RUN = dt.datetime(2024, 2, 1)


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def _add_batch(spark, paths, rows):
    """Further rows in bronze, as a micro-batch of their own."""
    stamps = {"ingest_ts": F.lit(RUN), "date": F.lit("20240201"), "source_file": F.lit("x"),
              lake.RAW_LINE: F.lit(None).cast("string")}
    last = ingest.last_batch(spark, paths.bronze_events).last_batch_id
    batch = quality.with_quality_flags(rows.withColumns(stamps))
    ingest.write_split_batch(batch, last + 1, paths.bronze_events, paths.quarantine, "drop")


def _assert_equals_rebuild(spark, paths):
    """Events, rollup, gold and serving equal what all of bronze gives."""
    events = spark.read.parquet(paths.silver("usage_events_clean"))
    daily = spark.read.parquet(paths.silver("daily_usage"))
    base = silver.usage_events_base(lake.read_bronze_events(spark, paths.bronze_events).drop("batch_id", "date"))
    want = silver.daily_usage(base)
    assert _rows(events.select("event_id", "usage_date")) == _rows(base.select("event_id", "usage_date"))
    assert _rows(daily.drop("last_updated")) == _rows(want)


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    paths = P.LakePaths(run_dir(spark, "t-recovery"))
    P.run_all(spark, paths, RUN, sf_dir=sf_dir)
    return paths


def test_a_run_stopped_after_any_write_is_finished_by_the_next(spark, sf_dir, built):
    good = quality.ingest_events_split(fixtures.usage_events_raw(spark, sf_dir))[0].select(*jobs.C.EVENT_COLUMNS)
    for writes in (0, 3, 5, 6, 7, 8):
        moved = good.where(F.col("event_id").cast("long") % 11 == writes)
        moved = moved.withColumn("timestamp", F.col("timestamp") - F.expr(f"interval {writes + 1} days"))
        _add_batch(spark, built, moved)
        with pytest.raises(jobs.Stopped), jobs.stopped_after(writes):
            P.update_events(spark, built, RUN)
        P.update_events(spark, built, RUN)
        _assert_equals_rebuild(spark, built)
    P.build_marts(spark, built)
    P.publish_all(spark, built)
    daily = spark.read.parquet(built.silver("daily_usage"))
    published = serving.read_published(spark, built.serving, "genai_tokens_cost_daily")
    assert published.agg(F.sum("total_genai_tokens")).first()[0] == daily.where("service = 'genai'").agg(
        F.sum("total_genai_tokens")).first()[0]


def test_a_full_build_that_stops_is_done_again(spark, built):
    with pytest.raises(jobs.Stopped), jobs.stopped_after(4):  # the events are replaced, the rollup is not
        P.update_events(spark, built, RUN, incremental=False)
    P.update_events(spark, built, RUN)
    _assert_equals_rebuild(spark, built)


def test_a_lost_mark_makes_every_consumer_start_anew(spark, built):
    P.build_marts(spark, built)
    P.publish_all(spark, built)
    before = _rows(serving.read_published(spark, built.serving, "org_daily_usage_by_service").drop("last_updated"))
    gold = spark.read.parquet(built.gold("genai_tokens_cost_daily"))
    lake.write_table(gold.where("false"), built.gold("genai_tokens_cost_daily"), ["usage_date"], replace_all=True)
    for slot in (0, 1):
        nothing = spark.createDataFrame([], f"mark_no long, {P.PROGRESS}")
        nothing.write.mode("overwrite").parquet(built.silver(f"_progress/slot={slot}"))
    assert marks.newest(spark, built.silver("_progress"), P.PROGRESS) is None
    P.update_events(spark, built, RUN)
    assert "genai_tokens_cost_daily" in P.build_marts(spark, built)
    P.publish_all(spark, built)
    after = _rows(serving.read_published(spark, built.serving, "org_daily_usage_by_service").drop("last_updated"))
    assert before == after and spark.read.parquet(built.gold("genai_tokens_cost_daily")).count() > 0


def test_marks_alternate_and_survive_a_stopped_write(spark):
    path = run_dir(spark, "t-marks")
    assert marks.newest(spark, path, "n int") is None
    for n in (7, 8, 9):
        marks.advance(spark, path, "n int", n)
    assert marks.newest(spark, path, "n int").n == 9
    assert marks.newest(spark, path, "n int", before=2).n == 8
    spark.createDataFrame([], "mark_no long, n int").write.mode("overwrite").parquet(path + "/slot=0")
    assert marks.newest(spark, path, "n int").n == 8  # the one before is still there


def test_an_increment_reads_only_its_buckets_and_days(spark, sf_dir, built):
    some = spark.createDataFrame([("3",)], "event_id string")
    found = event_ids.known(spark, built.bronze_events, some)
    bucket = event_ids.asked_buckets(some)
    assert len(bucket) == 1 and all(f"/bucket={bucket[0]}/" in f for f in found.inputFiles())
    days = spark.sql("SELECT date'2024-01-07' AS usage_date")
    rows = P.stored_days(spark, built.silver("usage_events_clean"), days)
    assert rows.inputFiles() and all("usage_date=2024-01-07" in f for f in rows.inputFiles())
    none = spark.sql("SELECT date'1999-01-07' AS usage_date")
    assert P.stored_days(spark, built.silver("usage_events_clean"), none) is None
    assert P.update_events(spark, built, RUN) == 0  # nothing new, no dimension changed


def test_old_replays_meet_the_index_and_the_state_stays_small(spark, sf_dir):
    paths = P.LakePaths(run_dir(spark, "t-index"))
    raw = fixtures.usage_events_raw(spark, sf_dir).where("event_id IS NOT NULL AND timestamp IS NOT NULL")
    args = (paths.landing_stream, paths.bronze_events, paths.quarantine, paths.stream_checkpoint)
    n = {}
    for name, rows in (("a", raw), ("b", raw.where("event_id = '1'")), ("c", raw.where("event_id IN ('1', '2')")), ("d", raw)):
        landing.write_jsonl(rows, f"{paths.landing_stream}/{name}")
        q = ingest.run_ingest_once(spark, *args, state_kept="0 seconds")
        n[name] = q.lastProgress.stateOperators[0].numRowsTotal
        good = lake.read_bronze_events(spark, paths.bronze_events)
        ids = good.unionByName(lake.read_bronze_events(spark, paths.quarantine)).select("event_id")
        assert ids.count() == ids.distinct().count() == raw.select("event_id").distinct().count()
    assert n["a"] > 100 and n["c"] <= 3  # ids of earlier micro-batches have left the state


def test_late_rows_go_aside_only_where_asked(spark, sf_dir):
    with pytest.raises(ValueError, match="late_path"):
        ingest.start_ingest(spark, "a", "b", "c", "d", late="aside")
    with pytest.raises(ValueError):
        ingest.start_ingest(spark, "a", "b", "c", "d", late="lose")


def test_measured_joins_are_equal_either_way(spark, sf_dir, monkeypatch):
    good = quality.ingest_events_split(fixtures.usage_events_raw(spark, sf_dir))[0]
    dims = fixtures.customers_orgs(spark, sf_dir), fixtures.resources(spark, sf_dir)
    small = _rows(silver.usage_events_clean(good, *dims, unique=True))
    monkeypatch.setattr(silver, "BROADCAST_BYTES", 0)
    assert _rows(silver.usage_events_clean(good, *dims, unique=True)) == small
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    orgs = silver.orgs_clean(dims[0])
    assert _rows(joins.left_join(good, orgs, ["org_id"])) == _rows(good.join(orgs, "org_id", "left"))


def test_measures_that_cannot_be_summed_fail_a_rule(spark):
    values = [1.5, None, 0.0, -9e14, 1e15, 2e20, float("nan"), float("inf"), float("-inf")]
    rows = [(str(i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "event_id string, value double").withColumns({
        "timestamp": F.lit(RUN), "unit": F.lit("u"), "metric": F.lit("m"), "schema_version": F.lit(1),
        "cost_usd_increment": F.lit(0.0), "carbon_kg": F.lit(None).cast("double")})
    got = [r.is_measure_summable for r in quality.with_quality_flags(df).orderBy("event_id").collect()]
    assert got == [True] * 4 + [False] * 5


def test_unchanged_landing_tables_are_not_read_again(spark, sf_dir):
    paths = P.LakePaths(run_dir(spark, "t-manifest"))
    P.stage_batch_landing(spark, sf_dir, paths)
    everything = sorted(f"{n}.csv" for n in P.BATCH_INPUTS)
    assert P.ingest_batch(spark, paths, RUN) == everything
    P.build_silver(spark, paths, RUN)
    first = P.bronze_versions(spark, paths)
    assert P.ingest_batch(spark, paths, RUN + dt.timedelta(days=1)) == []
    bills = fixtures.billing_monthly(spark, sf_dir)
    landing.write_csv_table(bills.withColumn("subtotal", F.col("subtotal") + 1), paths.landing, "billing_monthly.csv")
    later = RUN + dt.timedelta(days=2)
    assert P.ingest_batch(spark, paths, later) == ["billing_monthly.csv"]
    assert P.bronze_table(spark, paths, "billing_monthly.csv").select("ingest_ts").distinct().first()[0] == later
    assert P.bronze_table(spark, paths, "users.csv").select("ingest_ts").distinct().first()[0] == RUN
    second = P.bronze_versions(spark, paths)
    assert {n for n in second if second[n] != first[n]} == {"billing_monthly.csv"}
    clean = lambda name: spark.read.parquet(paths.silver(name)).inputFiles()
    tickets, bill = clean("support_tickets_clean"), clean("billing_monthly_clean")
    P.build_silver(spark, paths, later)
    assert clean("support_tickets_clean") == tickets and clean("billing_monthly_clean") != bill
    assert P.build_marts(spark, paths).keys() >= {"revenue_by_org_month_usd"}
    assert P.build_marts(spark, paths) == {}  # nothing new
    assert P.ingest_batch(spark, paths, later, incremental=False) == everything


def test_published_rows_are_ordered_by_organisation(spark, sf_dir):
    import pyarrow.parquet as pq

    mart = jobs.C.mart_frames(spark, sf_dir)["org_daily_usage_by_service"]
    root = run_dir(spark, "t-layout")
    serving.publish(mart, root, "org_daily_usage_by_service")
    files = serving.read_published(spark, root, "org_daily_usage_by_service").inputFiles()
    for f in files[:10]:
        ids = pq.ParquetFile(f.removeprefix("file://")).read(columns=["org_id"]).column(0).to_pylist()
        assert ids == sorted(ids)
    days = {f.split("usage_date=")[1].split("/")[0] for f in files}
    assert len(files) < 2 * len(days)  # a file a day, not one per task


def test_new_ids_are_joined_before_the_files_are_written(spark, sf_dir, monkeypatch):
    paths = P.LakePaths(run_dir(spark, "t-joined"))
    landing.write_jsonl(fixtures.usage_events_raw(spark, sf_dir).where("event_id % 2 = 0"), paths.landing_stream)
    P.ingest_events(spark, paths)
    stored = []
    write = ingest.event_ids.add
    memory = spark.sparkContext._jsc.sc()

    def add(rows, *args):
        stored.append([(i.numPartitions(), i.numCachedPartitions()) for i in memory.getRDDStorageInfo()])
        write(rows, *args)

    monkeypatch.setattr(ingest.event_ids, "add", add)
    new = fixtures.usage_events_raw(spark, sf_dir).where("event_id IS NOT NULL AND timestamp IS NOT NULL")
    last = ingest.last_batch(spark, paths.bronze_events).last_batch_id
    stamps = {"ingest_ts": F.lit(RUN), "date": F.lit("20240201"), "source_file": F.lit("x"),
              lake.RAW_LINE: F.lit(None).cast("string")}
    batch = quality.with_quality_flags(quality.dedup_arrivals(new).withColumns(stamps))
    ingest.write_split_batch(batch, last + 1, paths.bronze_events, paths.quarantine)
    assert len(stored[0]) >= 2 and all(n == cached for n, cached in stored[0])  # the batch, and what the index left of it


def test_stored_days_are_not_dealt_again(spark, sf_dir, built, monkeypatch):
    import glob

    good = quality.ingest_events_split(fixtures.usage_events_raw(spark, sf_dir))[0].select(*jobs.C.EVENT_COLUMNS)
    moved = good.where(F.col("event_id").cast("long") % 13 == 4)
    _add_batch(spark, built, moved.withColumn("timestamp", F.col("timestamp") - F.expr("interval 2 days")))
    asked, replaced = [], lake.replace_days
    monkeypatch.setattr(lake, "replace_days", lambda df, path, *a, **kw: asked.append((path, kw.get("dealt", False))) or replaced(df, path, *a, **kw))
    P.update_events(spark, built, RUN)
    assert glob.glob(built.silver("_staging/slot=*/events/usage_date=*"))
    _assert_equals_rebuild(spark, built)
    P.build_marts(spark, built)
    assert {path for path, dealt in asked if dealt} >= {built.silver("usage_events_clean"), built.gold("org_daily_usage_by_service")}
    mart = spark.read.parquet(built.gold("org_daily_usage_by_service"))
    assert "Exchange" not in serving.clustered(mart, ["usage_date"], dealt=True)._jdf.queryExecution().toString()
    P.publish_all(spark, built)
    published = serving.read_published(spark, built.serving, "org_daily_usage_by_service")
    assert _rows(published.select("org_id", "daily_cost_usd", "usage_date")) == _rows(mart.select("org_id", "daily_cost_usd", "usage_date"))
    assert len(published.inputFiles()) <= len(mart.inputFiles()) + 8  # a file is read by one task, or split among few


def test_changed_rows_are_those_of_except_all_and_shuffled_once(spark):
    cols = "org_id string, org_name string, quota double"
    before = spark.createDataFrame([("a", "A", 1.0), ("a", "A", 1.0), ("b", None, float("nan")), (None, "C", 0.0), ("d", "D", 2.0)], cols)
    now = spark.createDataFrame([("a", "A", 1.0), ("b", None, float("nan")), (None, "C", 0.0), ("d", "D", 3.0), ("e", None, None)], cols)
    found = P._changed_rows(before, now)
    both = now.exceptAll(before).unionByName(before.exceptAll(now)).distinct()
    assert sorted(map(repr, found.collect())) == sorted(map(repr, both.collect())) and found.count() == 4
    assert plan_text(P._changed_rows(before, now), "formatted").count(") Exchange\n") == 1


def test_events_are_merged_for_the_write_alone(spark, sf_dir, built, monkeypatch):
    """The dimension rows that an increment asks for are found from the keys of the stored rows, before they are merged."""
    monkeypatch.setattr(silver, "BROADCAST_BYTES", 0)
    counted, enrich = [], silver.enrich_events

    def seen(events, *args, **kwargs):
        out = enrich(events, *args, **kwargs)
        counted.append(plan_text(kwargs["kept"][2], "extended"))
        return out

    monkeypatch.setattr(silver, "enrich_events", seen)
    good = quality.ingest_events_split(fixtures.usage_events_raw(spark, sf_dir))[0].select(*jobs.C.EVENT_COLUMNS)
    again = good.where(F.col("event_id").cast("long") % 13 == 2).withColumn("timestamp", F.col("timestamp") - F.expr("interval 9 days"))
    _add_batch(spark, built, again)
    P.update_events(spark, built, RUN)
    assert len(counted) == 1 and "min(struct" not in counted[0]
    _assert_equals_rebuild(spark, built)
