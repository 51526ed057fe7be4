"""Catalogue entries that run a job (stream, landing, lake, publication).

Each call works in a fresh folder under the shared folder
(``spark.checkpoint.dir``): it stages the inputs derived from the driver's
tables into a landing zone, runs the job, and returns what the job wrote,
read back as a DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finlake.functions import rules
from finlake.operators import lookups, silver
from finlake.operators.quality import dedup_arrivals, with_quality_flags
from finlake.plans import catalog as C
from finlake.plans import pipeline as P
from finlake.plans.parallel import run_parallel
from finlake.plans.pipeline import (
    LakePaths,
    build_marts,
    build_silver,
    compact_bronze,
    ingest_all,
    ingest_batch,
    publish_all,
    quarantined_events,
    run_all,
    stage_batch_landing,
    stage_event_landing,
    update_events,
)
from finlake.plans.pipeline import ingest_events as run_event_ingest
from finlake.session import run_dir
from finlake.sources import fixtures, landing, lake, marks, serving
from finlake.streaming import ingest

RUN_TS = dt.datetime(2024, 2, 1, 0, 0, 0)


def _paths(spark: SparkSession, label: str) -> LakePaths:
    return LakePaths(run_dir(spark, label))


def _side_by_side(*tasks: Callable[[], None]) -> None:
    """Landing files of different tables, staged at the same time."""
    run_parallel(dict(enumerate(tasks)))


def _streamed(spark: SparkSession, sf_dir: str) -> LakePaths:
    paths = _paths(spark, "stream")
    stage_event_landing(spark, sf_dir, paths)
    run_event_ingest(spark, paths)
    return paths


def q_stream_events_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _streamed(spark, sf_dir)
    good = lake.read_bronze_events(spark, paths.bronze_events)
    return good.select(*C.EVENT_COLUMNS, *C.FLAG_COLUMNS)


def q_stream_events_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _streamed(spark, sf_dir)
    bad = lake.read_bronze_events(spark, paths.quarantine)
    return bad.select(*C.EVENT_COLUMNS, *C.FLAG_COLUMNS)


def q_stream_rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per output after two runs over the same files on one checkpoint."""
    paths = _streamed(spark, sf_dir)
    run_event_ingest(spark, paths)
    good = lake.read_bronze_events(spark, paths.bronze_events)
    bad = lake.read_bronze_events(spark, paths.quarantine)
    return (
        good.unionByName(bad)
        .groupBy(rules.QUARANTINE)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("event_id").alias("n_event_ids"),
        )
    )


def q_src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support tickets staged as CSV, found in the landing zone and read back."""
    paths = _paths(spark, "landing")
    stage_batch_landing(spark, sf_dir, paths)
    tables = landing.read_landing(spark, paths.landing, RUN_TS)
    return tables["support_tickets.csv"].drop("ingest_ts")


def q_src_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices read back from their ``source_file`` partition of bronze."""
    paths = _paths(spark, "bronze")
    stage_batch_landing(spark, sf_dir, paths)
    ingest_batch(spark, paths, RUN_TS)
    return lake.read_source_partition(spark, paths.bronze_batch, "billing_monthly.csv").drop(
        "ingest_ts"
    )


def q_serve_publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usage mart after the whole lake ran from files (landing -> serving)."""
    paths = _paths(spark, "lake")
    run_all(spark, paths, RUN_TS, sf_dir=sf_dir)
    out = serving.read_published(spark, paths.serving, "org_daily_usage_by_service")
    return out.drop("last_updated")


def q_silver_written(name: str):
    """A batch table through landing, bronze and silver, read back as stored."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = _paths(spark, "silver")
        file_name, clean, table = {
            "billing": ("billing_monthly.csv", silver.billing_usd, "billing_monthly_clean"),
            "tickets": ("support_tickets.csv", silver.tickets_clean, "support_tickets_clean"),
        }[name]
        builder = fixtures.BUILDERS[file_name.removesuffix(".csv")]
        landing.write_csv_table(builder(spark, sf_dir), paths.landing, file_name)
        ingest_batch(spark, paths, RUN_TS)
        bronze = lake.read_source_partition(spark, paths.bronze_batch, file_name)
        lake.write_table(clean(bronze), paths.silver(table))
        return spark.read.parquet(paths.silver(table))

    return run


def q_stream_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both stream outputs whose stamps hold: the ingest day is that of the
    ingest time, the file is one of the drop folder."""
    paths = _streamed(spark, sf_dir)
    good = lake.read_bronze_events(spark, paths.bronze_events)
    rows = good.unionByName(lake.read_bronze_events(spark, paths.quarantine))
    drop = paths.landing_stream.rsplit("/", 1)[-1]
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("date") == F.date_format("ingest_ts", "yyyyMMdd")).alias("n_day_matches"),
        F.count_if(F.col("source_file").rlike(f"/{drop}/[^/]+[.]json([.]gz)?$")).alias("n_file_matches"),
    )


LATE_BEFORE = dt.datetime(2024, 1, 10)


def q_stream_bounded_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded state: the events from ``LATE_BEFORE`` on arrive first, the earlier ones
    with the next files; the watermark has passed these, so only rows that
    do not go through it (no id, or no time) are kept of them."""
    paths = _paths(spark, "bounded")
    raw = fixtures.usage_events_raw(spark, sf_dir)
    late = F.coalesce(F.col("timestamp") < F.lit(LATE_BEFORE), F.lit(False))
    landing.write_jsonl(raw.where(~late), paths.landing_stream + "/first", compressed=True)
    run_event_ingest(spark, paths, late="drop")
    landing.write_jsonl(raw.where(late), paths.landing_stream + "/second", compressed=True)
    run_event_ingest(spark, paths, late="drop")
    good = lake.read_bronze_events(spark, paths.bronze_events)
    rows = good.unionByName(lake.read_bronze_events(spark, paths.quarantine))
    return rows.select(*C.EVENT_COLUMNS, *C.FLAG_COLUMNS)


def q_lake_incremental_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published usage mart after drops that reach silver by different ways: a run
    of everything, a drop taken by a plainly started stream, silver run twice
    before gold, and a drop after which gold is left out once."""
    paths = _paths(spark, "increments")
    raw = fixtures.usage_events_raw(spark, sf_dir)
    day = F.dayofmonth("timestamp")
    stage_batch_landing(spark, sf_dir, paths)
    landing.write_jsonl(raw.where(F.coalesce(day <= 10, F.lit(True))), paths.landing_stream + "/first", compressed=True)
    run_all(spark, paths, RUN_TS)
    landing.write_jsonl(raw.where(day.between(11, 20)), paths.landing_stream + "/second", compressed=True)
    stream = (paths.landing_stream, paths.bronze_events, paths.quarantine, paths.stream_checkpoint)
    ingest.start_ingest(spark, *stream).awaitTermination()
    build_silver(spark, paths, RUN_TS)
    build_silver(spark, paths, RUN_TS)
    landing.write_jsonl(raw.where(day > 20), paths.landing_stream + "/third", compressed=True)
    run_event_ingest(spark, paths)
    build_silver(spark, paths, RUN_TS)
    build_marts(spark, paths)
    publish_all(spark, paths)
    return serving.read_published(spark, paths.serving, "org_daily_usage_by_service").drop("last_updated")


def q_lake_replay_and_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver events after replays that carry a later day, and an organisation table in
    which some names changed: one row per id, with the names as they are now."""
    paths = _paths(spark, "replays")
    raw = fixtures.usage_events_raw(spark, sf_dir)
    first = f"{paths.landing_stream}/first"
    _side_by_side(lambda: stage_batch_landing(spark, sf_dir, paths), lambda: landing.write_jsonl(raw, first, compressed=True))
    ingest_all(spark, paths, RUN_TS, late="drop")
    build_silver(spark, paths, RUN_TS)
    replay = raw.where("CAST(event_id AS BIGINT) % 7 = 0").withColumn(
        "timestamp", F.col("timestamp") + F.expr("interval 40 days")
    )
    orgs = fixtures.customers_orgs(spark, sf_dir)
    renamed = F.when(F.col("org_id").cast("long") % 10 == 3, F.concat("org_name", F.lit(" Ltd")))
    orgs = orgs.withColumn("org_name", F.coalesce(renamed, F.col("org_name")))
    _side_by_side(
        lambda: landing.write_jsonl(replay, f"{paths.landing_stream}/second", compressed=True),
        lambda: landing.write_csv_table(orgs, paths.landing, "customers_orgs.csv"),
    )
    ingest_all(spark, paths, RUN_TS, late="drop")
    build_silver(spark, paths, RUN_TS)
    clean = spark.read.parquet(paths.silver("usage_events_clean"))
    return clean.select("event_id", "timestamp", "usage_date", "org_id", "org_name", "quota")


def q_lake_compacted_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usage rollup, and the quarantine beside it, after five micro-batches that were compacted three
    times: when silver had read a part of them, when it had read none of the new ones, and after all."""
    paths = _paths(spark, "compacted")
    raw = fixtures.usage_events_raw(spark, sf_dir)
    stage_batch_landing(spark, sf_dir, paths)
    ingest_batch(spark, paths, RUN_TS)
    part = F.pmod(F.xxhash64(F.coalesce("event_id", F.lit(""))), F.lit(5))
    for i in range(5):
        landing.write_jsonl(raw.where(part == i), f"{paths.landing_stream}/part{i}", compressed=True)
        run_event_ingest(spark, paths)
        if i == 1:
            build_silver(spark, paths, RUN_TS)
        if i in (2, 3, 4):
            compact_bronze(spark, paths)
        if i in (3, 4):
            build_silver(spark, paths, RUN_TS)
    usage = spark.read.parquet(paths.silver("daily_usage"))
    day, cost = F.col("usage_date").cast("string"), F.col("daily_cost_usd").cast("double")
    bad = quarantined_events(spark, paths)
    no_day, bad_cost = F.lit(None).cast("string"), F.col("cost_usd_increment")
    return usage.select(
        F.lit("usage").alias("kind"), "org_id", "service", day.alias("usage_date"), cost.alias("daily_cost_usd")
    ).unionByName(
        bad.select(
            F.lit("quarantine").alias("kind"), "org_id", "service", no_day.alias("usage_date"), bad_cost.alias("daily_cost_usd")
        )
    )


class Stopped(RuntimeError):
    """What stands for a lost driver in ``lake_failed_and_redone``."""


@contextmanager
def stopped_after(writes: int):
    """Every run of the lake in this block stops once it has made so many writes."""
    left = [writes]
    patched = [(lake, "write_table"), (marks, "put"), (P, "_staged")]
    before = [getattr(module, name) for module, name in patched]

    def counted(call):
        def run(*args, **kwargs):
            if not left[0]:
                raise Stopped(f"after {writes} writes")
            left[0] -= 1
            return call(*args, **kwargs)

        return run

    for (module, name), call in zip(patched, before):
        setattr(module, name, counted(call))
    try:
        yield
    finally:
        for (module, name), call in zip(patched, before):
            setattr(module, name, call)


def moved_to_earlier_days(spark: SparkSession, sf_dir: str, paths: LakePaths) -> None:
    """A further micro-batch with copies of a seventh of the events that carry a time three days earlier."""
    moved = fixtures.usage_events_raw(spark, sf_dir).where("CAST(event_id AS BIGINT) % 7 = 0")
    moved = moved.withColumn("timestamp", F.col("timestamp") - F.expr("interval 3 days"))
    stamps = {"ingest_ts": F.lit(RUN_TS), "date": F.lit("20240201"), "source_file": F.lit("moved"), lake.RAW_LINE: F.lit(None).cast("string")}
    batch = with_quality_flags(dedup_arrivals(moved).withColumns(stamps))
    last = ingest.last_batch(spark, paths.bronze_events).last_batch_id
    ingest.write_split_batch(batch, last + 1, paths.bronze_events, paths.quarantine, "drop", id_buckets=paths.id_buckets)


#: Writes after which the runs of the entry below stop, one after the other: days staged; intent recorded; then, in
#: runs that finish the one before, events replaced, but not the rollup; both replaced, but no progress recorded.
STOPS = (4, 6, 1, 2)


def q_lake_failed_and_redone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published usage mart after a run that moves events to earlier days was stopped at
    several places, each time redone only as far as the next one."""
    paths = _paths(spark, "redone")
    run_all(spark, paths, RUN_TS, sf_dir=sf_dir)
    moved_to_earlier_days(spark, sf_dir, paths)
    for writes in STOPS:
        try:
            with stopped_after(writes):
                update_events(spark, paths, RUN_TS)
        except Stopped:
            continue
    update_events(spark, paths, RUN_TS)
    build_marts(spark, paths)
    publish_all(spark, paths)
    return serving.read_published(spark, paths.serving, "org_daily_usage_by_service").drop("last_updated")


def q_lake_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published usage mart, with its stamp, after the landing files were corrected and everything was
    built from them again."""
    paths = _paths(spark, "refresh")
    raw = fixtures.usage_events_raw(spark, sf_dir)
    wrong = raw.withColumn("cost_usd_increment", F.col("cost_usd_increment") * 2)
    _side_by_side(
        lambda: stage_batch_landing(spark, sf_dir, paths),
        lambda: landing.write_jsonl(wrong, paths.landing_stream, compressed=True),
    )
    run_all(spark, paths, RUN_TS - dt.timedelta(days=1))
    landing.write_jsonl(raw, paths.landing_stream, compressed=True)
    run_all(spark, LakePaths.of(spark, paths.root), RUN_TS, full_refresh=True)
    return serving.read_published(spark, paths.serving, "org_daily_usage_by_service")


def q_lake_gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every gold table as stored, in one shape: its name, its keys as text, its measures in order."""
    paths = _paths(spark, "gold")
    run_all(spark, paths, RUN_TS, sf_dir=sf_dir)
    return _in_one_shape(spark, paths, list(GOLD_TABLES))


def _in_one_shape(spark: SparkSession, paths: LakePaths, names: list[str]) -> DataFrame:
    parts = []
    for name in names:
        keys, measures = GOLD_TABLES[name]
        gold = spark.read.parquet(paths.gold(name))
        cols = [F.col(k).cast("string") for k in keys] + [F.lit(None).cast("string")] * (3 - len(keys))
        nums = [F.col(m).cast("double") for m in measures] + [F.lit(None).cast("double")] * (6 - len(measures))
        named = [c.alias(f"key_{i}") for i, c in enumerate(cols, 1)] + [c.alias(f"measure_{i}") for i, c in enumerate(nums, 1)]
        parts.append(gold.select(F.lit(name).alias("table_name"), *named))
    return reduce(DataFrame.unionByName, parts)


REVENUE_TABLES = ["services_by_cum_cost_by_org", "revenue_by_org_month_usd"]


def other_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The billing table before its corrections: other amounts in two months, without a third, and with a month
    that the corrections empty."""
    bill = fixtures.billing_monthly(spark, sf_dir)
    wrong = F.col("month").isin(dt.date(1995, 1, 1), dt.date(1995, 2, 1)) & (F.col("org_id").cast("long") % 3 == 0)
    bill = bill.withColumn("subtotal", F.when(wrong, F.col("subtotal") + 100.0).otherwise(F.col("subtotal")))
    gone = bill.where(F.col("month") == dt.date(1996, 5, 1)).withColumn("month", F.lit(dt.date(2031, 1, 1)))
    return bill.where(F.col("month") != dt.date(1998, 7, 1)).unionByName(gone)


def q_lake_corrected_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold revenue tables after invoices were corrected: a run that stops while it replaces months, billing
    corrected once more, and a run that finishes both."""
    paths = _paths(spark, "corrected")
    name = "billing_monthly.csv"
    wrong = other_billing(spark, sf_dir)
    stage_batch_landing(spark, sf_dir, paths)
    landing.write_csv_table(wrong, paths.landing, name)

    def built() -> None:
        ingest_batch(spark, paths, RUN_TS)
        build_silver(spark, paths, RUN_TS)

    built()
    build_marts(spark, paths)
    half = wrong.withColumn("taxes", F.when(F.col("month") == dt.date(1997, 3, 1), 0.0).otherwise(F.col("taxes")))
    landing.write_csv_table(half, paths.landing, name)
    built()
    try:
        with stopped_after(4):  # the digests, the periods, the mark and one mart are written
            build_marts(spark, paths)
    except Stopped:
        pass
    landing.write_csv_table(fixtures.billing_monthly(spark, sf_dir), paths.landing, name)
    built()
    build_marts(spark, paths)
    return _in_one_shape(spark, paths, REVENUE_TABLES)


GOLD_TABLES = {
    "org_daily_usage_by_service": (["org_id", "service", "usage_date"], [
        "daily_cost_usd", "total_requests", "total_cpu_hours", "total_storage_gb_hours", "total_genai_tokens", "total_carbon_kg"]),
    "services_by_cum_cost_by_org": (["org_id", "month_and_year"], ["revenue_usd", "credits_usd", "tax_usd", "fx_applied"]),
    "critical_tickets_evolution_sla_rate_daily": (["date"], [
        "breach_count", "solved_count", "critical_ticket_count", "breach_rate"]),
    "revenue_by_org_month_usd": (["org_id", "month"], ["revenue_usd", "credits_usd", "tax_usd", "fx_applied"]),
    "genai_tokens_cost_daily": (["usage_date"], ["total_genai_tokens", "total_genai_cost_usd"]),
    "genai_tokens_cost_daily_by_org": (["org_id", "usage_date"], ["total_genai_tokens", "total_genai_cost_usd"]),
}


def q_lake_silver_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of every batch table's pass-through copy in the silver layer."""
    paths = _paths(spark, "copies")
    stage_batch_landing(spark, sf_dir, paths)
    ingest_batch(spark, paths, RUN_TS)
    build_silver(spark, paths, RUN_TS)
    keys = {"customers_orgs": "org_name", "resources": "resource_id", "billing_monthly": "invoice_id",
            "support_tickets": "ticket_id", "users": "user_id"}
    parts = []
    for name, key in keys.items():
        copy = lake.read_source_partition(spark, paths.silver("batch_data"), f"{name}.csv")
        parts.append(copy.select("source_file", F.col(key).alias("key"), "org_id"))
    return reduce(DataFrame.unionByName, parts)


def q_stream_old_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs after replays that are older than the state: three drops, the last one of them everything
    once more, with a state that keeps an id no longer than its own micro-batch."""
    paths = _paths(spark, "old-replays")
    raw = fixtures.usage_events_raw(spark, sf_dir)
    keyed = raw.where(F.col("event_id").isNotNull() & F.col("timestamp").isNotNull())
    day = F.dayofmonth("timestamp")
    for name, rows in (("a", keyed.where(day <= 15)), ("b", keyed.where(day.between(16, 20))), ("c", raw)):
        landing.write_jsonl(rows, f"{paths.landing_stream}/{name}", compressed=True)
        args = (paths.landing_stream, paths.bronze_events, paths.quarantine, paths.stream_checkpoint)
        ingest.run_ingest_once(spark, *args, state_kept="0 seconds")
    return _both_outputs(spark, paths)


def _both_outputs(spark: SparkSession, paths: LakePaths) -> DataFrame:
    good = lake.read_bronze_events(spark, paths.bronze_events)
    rows = good.unionByName(lake.read_bronze_events(spark, paths.quarantine))
    return rows.select(*C.EVENT_COLUMNS, *C.FLAG_COLUMNS)


def q_stream_late_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every event landed when the earlier ones arrive after the later ones, and late rows are put aside."""
    paths = _paths(spark, "aside")
    raw = fixtures.usage_events_raw(spark, sf_dir)
    late = F.coalesce(F.col("timestamp") < F.lit(LATE_BEFORE), F.lit(False))
    for name, rows in (("first", raw.where(~late)), ("second", raw.where(late))):
        landing.write_jsonl(rows, f"{paths.landing_stream}/{name}", compressed=True)
        run_event_ingest(spark, paths, late="aside")
    places = {"good": paths.bronze_events, "quarantine": paths.quarantine, "late": paths.late_events}
    found = [lake.read_bronze_events(spark, p).withColumn("landed", F.lit(n)) for n, p in places.items()]
    return reduce(DataFrame.unionByName, found).select(*C.EVENT_COLUMNS, "landed")


def q_stream_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine after lines that break off, and measures that are no finite or no plausible number."""
    paths = _paths(spark, "refused")
    raw = fixtures.usage_events_raw(spark, sf_dir).dropDuplicates(["event_id"])
    n = F.col("event_id").cast("long") % 50
    odd = F.when(n == 7, F.lit(2e20)).when(n == 9, F.lit(float("nan"))).when(n == 11, F.lit(float("-inf"))).otherwise(F.col("value"))
    landing.write_jsonl(raw.withColumn("value", odd), f"{paths.landing_stream}/events", compressed=True)
    broken = raw.where(n == 13).select(F.concat(F.lit('{"event_id": "'), "event_id", F.lit('", "value": ')))
    broken.write.text(f"{paths.landing_stream}/broken")
    run_event_ingest(spark, paths)
    bad = lake.read_quarantine(spark, paths.quarantine)
    kept = bad.where(F.col(lake.RAW_LINE).isNotNull() | ~F.col(rules.MEASURES_SUMMABLE))
    return kept.select("event_id", lake.RAW_LINE, rules.MEASURES_SUMMABLE, rules.QUARANTINE)


def _in_order(df: DataFrame) -> DataFrame:
    """A lookup's rows with their place in the order that it returns them in."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


def q_ordered_sla_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(spark, sf_dir, "critical_tickets_evolution_sla_rate_daily")
    return _in_order(lookups.lookup_sla_evolution(table, None, None)).select("place", "date")


def q_ordered_genai_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(spark, sf_dir, "genai_tokens_cost_daily_by_org")
    found = lookups.lookup_genai_tokens(table, C.LOOKUP_ORG, None, None)
    return _in_order(found).select("place", "usage_date", "org_id")


def _published(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A mart written as its serving table and read back as a reader does."""
    root = run_dir(spark, "serving")
    frames = C.mart_frames(spark, sf_dir)
    serving.publish(frames[name], root, name)
    return serving.read_published(spark, root, name)


def q_published(name: str):
    return lambda spark, sf_dir: _published(spark, sf_dir, name)


def q_published_costs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(spark, sf_dir, "org_daily_usage_by_service").drop("last_updated")
    return lookups.lookup_costs_daily(table, C.LOOKUP_ORG, C.LOOKUP_SERVICES, C.LOOKUP_START, C.LOOKUP_END)


def q_published_top_revenue_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(spark, sf_dir, "services_by_cum_cost_by_org")
    return lookups.lookup_top_revenue_months(table, C.LOOKUP_ORG, C.TOP_N_MONTHS)


def q_published_sla_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(spark, sf_dir, "critical_tickets_evolution_sla_rate_daily")
    return lookups.lookup_sla_evolution(table, C.SLA_START, C.SLA_END)


def q_published_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of every year: a month without a year is a filter, too."""
    table = _published(spark, sf_dir, "revenue_by_org_month_usd")
    return lookups.lookup_monthly_revenue(table, C.LOOKUP_ORG, None, C.MONTHLY_MONTH)


def q_published_genai_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(spark, sf_dir, "genai_tokens_cost_daily_by_org")
    return lookups.lookup_genai_tokens(table, C.LOOKUP_ORG, C.LOOKUP_START, C.LOOKUP_END)


PUBLISHED = (
    "services_by_cum_cost_by_org",
    "critical_tickets_evolution_sla_rate_daily",
    "revenue_by_org_month_usd",
    "genai_tokens_cost_daily",
    "genai_tokens_cost_daily_by_org",
)

JOB_QUERIES = {
    "stream_events_good": q_stream_events_good,
    "stream_events_quarantine": q_stream_events_quarantine,
    "stream_rerun_idempotent": q_stream_rerun_idempotent,
    "stream_stamps": q_stream_stamps,
    "stream_bounded_late": q_stream_bounded_late,
    "src_csv_roundtrip": q_src_csv_roundtrip,
    "src_partition_scan": q_src_partition_scan,
    "silver_billing_written": q_silver_written("billing"),
    "silver_tickets_written": q_silver_written("tickets"),
    "lake_incremental_marts": q_lake_incremental_marts,
    "lake_replay_and_rename": q_lake_replay_and_rename,
    "lake_failed_and_redone": q_lake_failed_and_redone,
    "lake_compacted_bronze": q_lake_compacted_bronze,
    "lake_full_refresh": q_lake_full_refresh,
    "lake_gold_tables": q_lake_gold_tables,
    "lake_corrected_billing": q_lake_corrected_billing,
    "lake_silver_copies": q_lake_silver_copies,
    "stream_old_replays": q_stream_old_replays,
    "stream_late_aside": q_stream_late_aside,
    "stream_refused": q_stream_refused,
    "ordered_sla_evolution": q_ordered_sla_evolution,
    "ordered_genai_tokens": q_ordered_genai_tokens,
    "serve_publish_roundtrip": q_serve_publish_roundtrip,
    **{f"published_{name}": q_published(name) for name in PUBLISHED},
    "published_lookup_costs_daily": q_published_costs_daily,
    "published_lookup_top_revenue_months": q_published_top_revenue_months,
    "published_lookup_sla_evolution": q_published_sla_evolution,
    "published_lookup_monthly_revenue": q_published_monthly_revenue,
    "published_lookup_genai_tokens": q_published_genai_tokens,
}
