"""The whole lake from files: invariants between the layers, and reruns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from finlake.functions.constants import MART_ORG_DAILY_USAGE
from finlake.operators import quality
from finlake.plans.pipeline import LakePaths, run_all
from finlake.session import run_dir
from finlake.sources import fixtures, lake, serving

RUN = dt.datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def lake_paths(spark, sf_dir):
    paths = LakePaths(run_dir(spark, "t-lake"))
    run_all(spark, paths, RUN, sf_dir=sf_dir)
    return paths


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_good_plus_quarantine_is_deduplicated_input(spark, sf_dir, lake_paths):
    good = lake.read_bronze_events(spark, lake_paths.bronze_events)
    bad = lake.read_bronze_events(spark, lake_paths.quarantine)
    expected = quality.dedup_arrivals(fixtures.usage_events_raw(spark, sf_dir)).count()
    assert good.count() + bad.count() == expected
    assert good.where("is_quarantine").count() == 0 and bad.where("NOT is_quarantine").count() == 0


def test_joins_keep_rows_and_rollup_adds_up(spark, lake_paths):
    good = lake.read_bronze_events(spark, lake_paths.bronze_events)
    clean = spark.read.parquet(lake_paths.silver("usage_events_clean"))
    daily = spark.read.parquet(lake_paths.silver("daily_usage"))
    assert clean.count() == good.select("event_id").distinct().count()
    assert daily.agg(F.sum("event_count")).first()[0] == clean.count()
    exact = clean.agg(F.sum(F.col("cost_usd_increment").cast("decimal(38,18)"))).first()[0]
    total = daily.agg(F.sum("daily_cost_usd")).first()[0]
    assert exact == total
    assert daily.select("last_updated").distinct().collect()[0][0] == RUN


def test_published_equals_gold(spark, lake_paths):
    for name in ("org_daily_usage_by_service", "revenue_by_org_month_usd",
                 "critical_tickets_evolution_sla_rate_daily", "genai_tokens_cost_daily_by_org"):
        gold = spark.read.parquet(lake_paths.gold(name))
        pub = serving.read_published(spark, lake_paths.serving, name)
        cast = serving.coerce(gold, serving.schemas.SERVING[name])
        assert _rows(pub) == _rows(cast), name


def test_rerun_changes_nothing(spark, sf_dir, lake_paths):
    before = _rows(serving.read_published(spark, lake_paths.serving, MART_ORG_DAILY_USAGE))
    n_bronze = lake.read_bronze_events(spark, lake_paths.bronze_events).count()
    run_all(spark, lake_paths, RUN)  # same landing files, same checkpoint
    assert lake.read_bronze_events(spark, lake_paths.bronze_events).count() == n_bronze
    after = _rows(serving.read_published(spark, lake_paths.serving, MART_ORG_DAILY_USAGE))
    assert before == after


def test_incremental_silver_equals_one_batch(spark, sf_dir):
    from finlake.operators import silver
    from finlake.plans import pipeline as P
    from finlake.sources import landing

    paths = LakePaths(run_dir(spark, "t-incr"))
    P.stage_batch_landing(spark, sf_dir, paths)
    raw = fixtures.usage_events_raw(spark, sf_dir)
    early = raw.where(F.col("timestamp") < F.lit(dt.datetime(2024, 1, 15)))
    landing.write_jsonl(early, paths.landing_stream + "/drop1")
    run_all(spark, paths, RUN)
    n1 = spark.read.parquet(paths.silver("usage_events_clean")).count()
    landing.write_jsonl(raw, paths.landing_stream + "/drop2")  # replays drop 1, adds the rest
    run_all(spark, paths, RUN)
    clean = spark.read.parquet(paths.silver("usage_events_clean"))
    assert clean.count() > n1

    good = quality.ingest_events_split(raw)[0]
    expected = silver.usage_events_clean(
        good, fixtures.customers_orgs(spark, sf_dir), fixtures.resources(spark, sf_dir))
    cols = ["event_id", "org_id", "service", "usage_date", "cost_usd_increment", "org_name", "quota"]
    assert _rows(clean.select(*cols)) == _rows(expected.select(*cols))
    daily = spark.read.parquet(paths.silver("daily_usage")).drop("last_updated")
    assert _rows(daily) == _rows(silver.daily_usage(silver.usage_events_base(good)))


def test_incremental_gold_and_serving_equal_full_build(spark, sf_dir):
    from finlake.operators import marts, silver
    from finlake.plans import pipeline as P
    from finlake.sources import landing

    paths = LakePaths(run_dir(spark, "t-incr-gold"))
    P.stage_batch_landing(spark, sf_dir, paths)
    raw = fixtures.usage_events_raw(spark, sf_dir)
    landing.write_jsonl(raw.where(F.col("timestamp") < F.lit(dt.datetime(2024, 1, 15))),
                        paths.landing_stream + "/drop1")
    run_all(spark, paths, RUN)
    landing.write_jsonl(raw, paths.landing_stream + "/drop2")
    run_all(spark, paths, RUN)
    touched = {r.usage_date for r in P.touched_days(spark, paths).collect()}
    assert touched and min(touched) >= dt.date(2024, 1, 14)  # only days the second drop changed

    daily = silver.daily_usage(silver.usage_events_base(quality.ingest_events_split(raw)[0]))
    expected = {
        "org_daily_usage_by_service": marts.org_daily_usage_by_service(daily),
        "genai_tokens_cost_daily": marts.genai_tokens_cost_daily(daily),
        "genai_tokens_cost_daily_by_org": marts.genai_tokens_cost_daily_by_org(daily),
    }
    for name, exp in expected.items():
        pub = serving.read_published(spark, paths.serving, name)
        pub = pub.drop("last_updated") if "last_updated" in pub.columns else pub
        want = serving.coerce(exp, serving.schemas.SERVING[name])
        want = want.drop("last_updated") if "last_updated" in want.columns else want
        assert _rows(pub) == _rows(want), name


def test_silver_reads_only_new_batch_folders(spark, sf_dir):
    from finlake.plans import pipeline as P
    from finlake.sources import landing

    paths = LakePaths(run_dir(spark, "t-folders"))
    raw = fixtures.usage_events_raw(spark, sf_dir)
    landing.write_jsonl(raw.where("metric = 'requests'"), paths.landing_stream + "/drop1")
    P.ingest_events(spark, paths)
    landing.write_jsonl(raw.where("metric <> 'requests'"), paths.landing_stream + "/drop2")
    P.ingest_events(spark, paths)
    files = P.new_bronze_events(spark, paths, done=0).inputFiles()
    assert files and all("/batch_id=1/" in f for f in files)
    assert P.new_bronze_events(spark, paths, done=1).count() == 0


def test_full_refresh_drops_days_that_are_gone(spark, sf_dir):
    from finlake.plans import pipeline as P
    from finlake.sources import landing

    paths = LakePaths(run_dir(spark, "t-full"))
    P.stage_batch_landing(spark, sf_dir, paths)
    raw = fixtures.usage_events_raw(spark, sf_dir)
    landing.write_jsonl(raw, paths.landing_stream)
    run_all(spark, paths, RUN)
    good = lake.read_bronze_events(spark, paths.bronze_events)
    kept = good.where("dayofmonth(timestamp) > 5")
    kept.drop("batch_id", "date").write.parquet(paths.root + "/kept")
    body = spark.read.parquet(paths.root + "/kept")
    rewritten = body.withColumn("date", F.lit("20240201")).write.mode("overwrite").partitionBy("date")
    rewritten.option("partitionOverwriteMode", "static").parquet(paths.bronze_events + "/batch_id=0")
    P.build_silver(spark, paths, RUN, incremental=False)
    P.build_marts(spark, paths, incremental=False)
    P.publish_all(spark, paths, incremental=False)
    published = serving.read_published(spark, paths.serving, MART_ORG_DAILY_USAGE)
    assert published.agg(F.min(F.dayofmonth("usage_date"))).first()[0] == 6
    assert spark.read.parquet(paths.silver("usage_events_clean")).count() == body.select("event_id").distinct().count()


def test_gold_failure_loses_no_day(spark, sf_dir, monkeypatch):
    """Silver ran, gold failed, the run is redone with nothing new: all days arrive."""
    from finlake.operators import marts
    from finlake.plans import pipeline as P
    from finlake.sources import landing

    paths = LakePaths(run_dir(spark, "t-redo"))
    P.stage_batch_landing(spark, sf_dir, paths)
    raw = fixtures.usage_events_raw(spark, sf_dir)
    landing.write_jsonl(raw.where("dayofmonth(timestamp) <= 15"), paths.landing_stream + "/drop1")
    run_all(spark, paths, RUN)
    landing.write_jsonl(raw.where("dayofmonth(timestamp) > 15"), paths.landing_stream + "/drop2")

    def fails(*_):
        raise RuntimeError("gold failed")

    with monkeypatch.context() as m:
        m.setattr(marts, "genai_tokens_cost_daily", fails)
        with pytest.raises(RuntimeError, match="gold failed"):
            run_all(spark, paths, RUN)
    run_all(spark, paths, RUN)
    daily = spark.read.parquet(paths.silver("daily_usage"))
    want = marts.org_daily_usage_by_service(daily)
    published = serving.read_published(spark, paths.serving, MART_ORG_DAILY_USAGE)
    assert published.count() == want.count() and published.agg(F.max("usage_date")).first()[0].day > 15
