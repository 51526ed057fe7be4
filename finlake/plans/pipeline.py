"""The lake, end to end: landing -> bronze -> silver -> gold -> serving.

Each stage reads what the previous stage wrote, so a stage can be re-run on
its own, and every write is idempotent (dynamic partition overwrite, or
overwrite of a whole derived table). A full refresh replaces every table after
bronze whole.

A run of silver that stops anywhere is finished by the next one: its rows and days are
staged, and the intent to apply them is recorded, before any table changes
(``update_events``). Progress marks are never lost while they are replaced
(``finlake.sources.marks``), and each names the full build that it goes on from, so that a
consumer whose mark names another one starts anew.

All paths are under one root, which on a cluster is shared storage (for the
tests, a folder under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from finlake.functions.constants import (
    MART_CRITICAL_TICKETS,
    MART_GENAI_DAILY,
    MART_GENAI_DAILY_BY_ORG,
    MART_ORG_DAILY_USAGE,
    MART_REVENUE_MONTH,
    MART_REVENUE_MONTH_LABEL,
)
from finlake.operators import changes, dedup, marts, silver
from finlake.operators.dedup import dedup_by_key
from finlake.plans.parallel import run_parallel
from finlake.sources import compaction, event_ids, fixtures, landing, lake, marks, serving
from finlake.streaming import ingest


GENERATION = "generation int"


@dataclass(frozen=True)
class LakePaths:
    """Where a lake's tables are; ``id_buckets`` is fixed for a lake's life (``finlake.sources.event_ids``).

    A full refresh from landing starts a new ``generation`` of what the stream writes, its checkpoint
    included, beside the old one; ``LakePaths.of`` finds the one in use."""

    root: str
    id_buckets: int = event_ids.ID_BUCKETS
    generation: int = 0

    @staticmethod
    def of(spark: SparkSession, root: str, id_buckets: int = event_ids.ID_BUCKETS) -> LakePaths:
        mark = marks.newest(spark, f"{root.rstrip('/')}/_generation", GENERATION)
        return LakePaths(root, id_buckets, 0 if mark is None else mark.generation)

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _streamed(self, *parts: str) -> str:
        return self._p(*parts) + (f"_generation_{self.generation}" if self.generation else "")

    @property
    def landing(self) -> str:
        return self._p("landing")

    @property
    def landing_stream(self) -> str:
        return self._p("landing", "usage_events_stream")

    @property
    def bronze_batch(self) -> str:
        return self._p("bronze", "batch_data")

    @property
    def manifest(self) -> str:
        return self._p("bronze", "_manifest")

    @property
    def bronze_events(self) -> str:
        return self._streamed("bronze", "usage_events")

    @property
    def quarantine(self) -> str:
        return self._streamed("quarantine", "usage_events_errors")

    @property
    def late_events(self) -> str:
        return self._streamed("late", "usage_events")

    @property
    def stream_checkpoint(self) -> str:
        return self._streamed("checkpoints", "usage_events")

    def silver(self, name: str) -> str:
        return self._p("silver", name)

    def gold(self, name: str) -> str:
        return self._p("gold", "finops", name)

    @property
    def serving(self) -> str:
        return self._p("serving")


# ------------------------------------------------------------------ landing


BATCH_INPUTS = ("customers_orgs", "resources", "billing_monthly", "support_tickets", "users")
ORDER_INPUTS = ("billing_monthly", "support_tickets")


def stage_batch_landing(spark: SparkSession, sf_dir: str, paths: LakePaths) -> None:
    """One CSV table per batch input, derived from the driver's tables. Invoices and tickets read the same
    orders, whose lines are added up once."""
    def stage(name: str, *shared: DataFrame) -> None:
        landing.write_csv_table(fixtures.BUILDERS[name](spark, sf_dir, *shared), paths.landing, f"{name}.csv")

    def of_orders() -> None:
        orders = fixtures.orders_with_lines(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name in ORDER_INPUTS:
                stage(name, orders)
        finally:
            orders.unpersist()

    others = [name for name in BATCH_INPUTS if name not in ORDER_INPUTS]
    run_parallel({"orders": of_orders, **{name: lambda name=name: stage(name) for name in others}})


def stage_event_landing(spark: SparkSession, sf_dir: str, paths: LakePaths) -> None:
    """The usage events as JSON-lines files in the stream's drop folder."""
    landing.write_jsonl(fixtures.usage_events_raw(spark, sf_dir), paths.landing_stream, compressed=True)


def stage_landing(spark: SparkSession, sf_dir: str, paths: LakePaths) -> None:
    """Write every input of the pipeline into the landing zone."""
    run_parallel(
        {
            "batch": lambda: stage_batch_landing(spark, sf_dir, paths),
            "events": lambda: stage_event_landing(spark, sf_dir, paths),
        }
    )


# ------------------------------------------------------------------ bronze


#: Which version of each batch table a layer holds, as JSON: file name -> version. A version is a new name given
#: at each ingest of the table, so a lost mark makes everything new, never something old current.
VERSIONS = "tables string"


def _versions(spark: SparkSession, path: str) -> dict:
    mark = marks.newest(spark, path, VERSIONS)
    return {} if mark is None else json.loads(mark.tables)


def _put_versions(spark: SparkSession, path: str, tables: dict) -> None:
    marks.advance(spark, path, VERSIONS, json.dumps(tables, sort_keys=True))


def bronze_versions(spark: SparkSession, paths: LakePaths) -> dict[str, str]:
    return {name: version for name, (_, version) in _versions(spark, paths.manifest).items()}


def ingest_batch(spark: SparkSession, paths: LakePaths, run_ts: dt.datetime, incremental: bool = True) -> list[str]:
    """The landing CSVs into bronze, one ``source_file`` partition each; returns the tables read.

    A manifest keeps the files' paths, lengths and times of the last ingest: a table none of
    whose files changed since is not read again (all are with ``incremental=False``).
    """
    found = landing.manifest(spark, paths.landing)
    before = _versions(spark, paths.manifest)
    changed = [n for n in sorted(found) if not incremental or before.get(n, [None])[0] != found[n]]
    if not changed:
        return []
    tables = landing.read_landing(spark, paths.landing, run_ts, changed)
    run_parallel(
        {
            name: lambda name=name, df=df: lake.write_bronze_batch(df, paths.bronze_batch, name)
            for name, df in tables.items()
        }
    )
    _put_versions(spark, paths.manifest, before | {n: [found[n], uuid.uuid4().hex] for n in changed})
    return changed


def ingest_events(
    spark: SparkSession,
    paths: LakePaths,
    late: str = "keep",
    max_files_per_trigger: int = ingest.FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Process the event files present now (the checkpoint remembers them)."""
    return ingest.run_ingest_once(
        spark,
        paths.landing_stream,
        paths.bronze_events,
        paths.quarantine,
        paths.stream_checkpoint,
        late=late,
        late_path=paths.late_events,
        id_buckets=paths.id_buckets,
        max_files_per_trigger=max_files_per_trigger,
    )


def new_bronze_events(spark: SparkSession, paths: LakePaths, done: int) -> DataFrame:
    """Bronze good events of the micro-batches after ``done``.

    The stream itself records its last complete micro-batch (whichever way it
    was started), so the batches to read are a range of ids: compacted segments that
    hold any of them, and the folders of the rest, named by a few glob patterns
    (``finlake.sources.compaction``).
    """
    root = paths.bronze_events
    mark = ingest.last_batch(spark, root)
    if mark is not None:
        return compaction.read(spark, root, lake.BRONZE_EVENT, max(done, -1), mark.last_batch_id)
    try:
        return lake.read_bronze_events(spark, root).where(F.col("batch_id") > F.lit(done))
    except AnalysisException as error:  # nothing was ingested
        if not marks.is_missing(error):
            raise
        return spark.createDataFrame([], lake.BRONZE_EVENT)


def compact_bronze(spark: SparkSession, paths: LakePaths, segment_rows: int = compaction.SEGMENT_ROWS) -> None:
    """Merge the folders of finished micro-batches of the good and of the quarantined events. Not to be run beside
    another ``compact_bronze``; the stream and silver can run meanwhile."""
    mark = ingest.last_batch(spark, paths.bronze_events)
    if mark is None:
        return
    tables = {paths.bronze_events: lake.BRONZE_EVENT, paths.quarantine: lake.QUARANTINED_EVENT}
    run_parallel(
        {
            table: lambda table=table, schema=schema: compaction.compact(
                spark, table, schema, mark.last_batch_id, segment_rows
            )
            for table, schema in tables.items()
        }
    )


def quarantined_events(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Every quarantined event, compacted or not."""
    mark = ingest.last_batch(spark, paths.bronze_events)
    last = -1 if mark is None else mark.last_batch_id
    return compaction.read(spark, paths.quarantine, lake.QUARANTINED_EVENT, -1, last)


# ------------------------------------------------------------------ silver


def bronze_table(spark: SparkSession, paths: LakePaths, file_name: str) -> DataFrame:
    return lake.read_source_partition(spark, paths.bronze_batch, file_name)


def build_silver(
    spark: SparkSession, paths: LakePaths, run_ts: dt.datetime, incremental: bool = True
) -> None:
    """Billing, tickets, clean events (by usage day) and the daily rollup.

    Events: with ``incremental`` only the stream's micro-batches not processed
    yet are read, and only the usage days they concern are rewritten
    (``update_events``); otherwise every day is rebuilt from all of bronze.
    The rollup is built from the events just written, so both tables agree on
    which copy of an event survived. A batch table is cleaned again only if it was ingested
    again. Independent tables are written side by side.
    """

    current = bronze_versions(spark, paths)
    taken = _versions(spark, paths.silver("_batch")) if incremental else {}
    # without a manifest (bronze was written by other means) every table counts as changed
    names = list(current) or landing.discover_batch_files(spark, paths.landing)
    changed = [n for n in names if n not in current or taken.get(n) != current[n]]

    def billing() -> None:
        bill = silver.billing_usd(bronze_table(spark, paths, "billing_monthly.csv"), few=True)
        lake.write_table(bill, paths.silver("billing_monthly_clean"))

    def tickets() -> None:
        t = silver.tickets_clean(bronze_table(spark, paths, "support_tickets.csv"), few=True)
        lake.write_table(t, paths.silver("support_tickets_clean"))

    def events() -> None:
        dimensions = any(file_name in changed for file_name, _, _ in DIMENSIONS.values())
        update_events(spark, paths, run_ts, incremental, dimensions)

    # Pass-through copy of every batch table, for readers of the silver layer.
    tasks = {
        f"copy:{name}": lambda name=name: lake.write_source_partition(
            bronze_table(spark, paths, name), paths.silver("batch_data"), name
        )
        for name in changed
    }
    if "billing_monthly.csv" in changed:
        tasks["billing"] = billing
    if "support_tickets.csv" in changed:
        tasks["tickets"] = tickets
    run_parallel({"events": events, **tasks})
    if changed:
        _put_versions(spark, paths.silver("_batch"), current)


#: What silver has taken from bronze: the run, the full build it goes on from, its last micro-batch.
PROGRESS = "run_no long, base string, last_batch_id long, run_ts timestamp"
#: A run that is staged and about to be applied; ``full`` is a build from all of bronze.
INTENT = f"{PROGRESS}, full boolean"
#: What gold or serving has taken: the run of silver, and the full build that one goes on from.
TAKEN = "run_no long, base string"
BY_DAY = ["usage_date"]
#: Days that are read by their folders' names; more of them are read with a semi-join.
MOST_DAYS = 10_000
DIMENSIONS = {
    "orgs": ("customers_orgs.csv", silver.orgs_clean, ["org_id"]),
    "resources": ("resources.csv", silver.resources_clean, silver.RESOURCE_KEY),
}


def _staging(paths: LakePaths, run_no: int, name: str) -> str:
    """A staged table of a run. Runs alternate between two areas, so that the run before, whose dimensions
    the stored events were enriched with, is still there."""
    return paths.silver(f"_staging/slot={run_no % 2}/{name}")


def _staged(df: DataFrame, path: str, by: list[str] | None = None) -> DataFrame:
    """Written beside the tables and read back: the tables it was read from can be overwritten. ``by`` are the
    partitions of the table that it will replace, by which the rows are dealt: once, however often they are applied."""
    w = df.write.mode("overwrite").option("compression", lake.CODEC)
    w.partitionBy(*by or []).option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stage_dimensions(spark: SparkSession, paths: LakePaths, run_no: int) -> dict[str, DataFrame]:
    """The cleaned dimensions as this run uses them."""
    return run_parallel(
        {
            name: lambda name=name, f=file_name, clean=clean: _staged(
                clean(bronze_table(spark, paths, f)), _staging(paths, run_no, name)
            )
            for name, (file_name, clean, _) in DIMENSIONS.items()
        }
    )


def _changed_rows(before: DataFrame, now: DataFrame) -> DataFrame:
    """The different rows that two tables do not hold equally often: every row is shuffled once."""
    sides = [df.select(*now.columns, F.lit(n).alias("_side")) for df, n in ((before, -1), (now, 1))]
    left = sides[0].unionByName(sides[1]).groupBy(*now.columns).agg(F.sum("_side").alias("_left"))
    return left.where("_left <> 0").drop("_left")


def _days_of_changed_dimensions(spark: SparkSession, paths: LakePaths, run_no: int, dims: dict[str, DataFrame]) -> list[DataFrame]:
    """The days with events of an organisation or a resource whose row is not the one they were enriched
    with. The rollup knows them (org, service, day), so the events are not read; where nothing
    changed, nothing is."""
    found = []
    for name, dim in dims.items():
        before = spark.read.schema(dim.schema).parquet(_staging(paths, run_no - 1, name))
        keys = [k for k in DIMENSIONS[name][2] if k in silver.USAGE_KEY]
        changed = _changed_rows(before, dim).select(*keys).distinct()
        if not changed.isEmpty():
            daily = spark.read.parquet(paths.silver("daily_usage"))
            found.append(daily.join(changed, keys, "left_semi").select("usage_date"))
    return found


def _days_of_copies(spark: SparkSession, paths: LakePaths, base: DataFrame) -> DataFrame:
    """The days that hold a copy of an id of ``base``, from the stream's id index: only the buckets of
    these ids are read. Without an index (bronze was written by other means) the stored ids are."""
    if event_ids.has_index(spark, paths.bronze_events, paths.id_buckets):
        seen = event_ids.known(spark, paths.bronze_events, base, paths.id_buckets)
    else:
        seen = spark.read.parquet(paths.silver("usage_events_clean"))
    if seen is None:
        return base.select("usage_date").where(F.lit(False))
    return seen.join(base.select("event_id"), "event_id", "left_semi").select("usage_date")


def stored_days(spark: SparkSession, path: str, days: DataFrame, schema=None) -> DataFrame | None:
    """The rows of a table partitioned by ``usage_date`` on the given days, read from these days' folders
    alone (None: there are none). More than ``MOST_DAYS`` days are not named to the driver: the table is
    joined with them."""
    named = [r.usage_date for r in days.select("usage_date").distinct().limit(MOST_DAYS + 1).collect()]
    if len(named) > MOST_DAYS:
        return spark.read.parquet(path).join(days, "usage_date", "left_semi")
    return lake.read_partitions(spark, path, "usage_date", named, schema)


def update_events(
    spark: SparkSession,
    paths: LakePaths,
    run_ts: dt.datetime,
    incremental: bool = True,
    dimensions_changed: bool = True,
) -> int:
    """Bring silver events and the daily rollup up to date with bronze and the dimensions.

    1. Finish the run before, if it stopped after it had recorded its intent.
    2. Read the micro-batches after the recorded one.
    3. Find the usage days to rewrite: those of the new rows, those that hold
       another copy of a new id (a replay can carry another time), and those
       with events whose organisation or resource row changed.
    4. Merge the days' stored events with the new ones, one row per id, and
       enrich them again. Days, rows and dimensions are staged under the lake root.
    5. Record the intent: from here on the run is finished by whoever comes next.
    6. Replace those days of the events, then of the rollup; add the days to
       the list that gold and serving consume, each with its own mark; record the progress.

    A run that stops before 5 has changed nothing and is done anew; one that stops later
    is applied again from what it staged, with the same result. A full build
    (``incremental=False``, the first one, or without a mark) replaces both tables whole, under
    a new name, so that every consumer takes all of it. Either way the result
    equals a rebuild from all of bronze. ``dimensions_changed=False`` says that neither dimension was
    ingested anew since the last run, so they need not be compared. Returns the number of new bronze rows.
    """
    progress = marks.newest(spark, paths.silver("_progress"), PROGRESS)
    intent = marks.newest(spark, paths.silver("_intent"), INTENT)
    last_no = max((m.run_no for m in (progress, intent) if m is not None), default=0)
    stopped = intent is not None and (progress is None or (intent.run_no, intent.base) != (progress.run_no, progress.base))
    if stopped and not intent.full and progress is not None and incremental:
        _apply(spark, paths, intent)
        progress = intent
    full = not incremental or progress is None or (stopped and intent.full)
    new = new_bronze_events(spark, paths, -1 if full else progress.last_batch_id)
    top = new.agg(F.max("batch_id").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if full and top.b is None:
        return 0
    if not full and not top.n and not dimensions_changed:
        return 0
    run_no = last_no + 1
    last = int(top.b) if top.b is not None else progress.last_batch_id
    base_name = uuid.uuid4().hex if full else progress.base
    dims = _stage_dimensions(spark, paths, run_no)
    base = silver.derive_event_columns(new.drop("batch_id", "date"))
    base = dedup.few_copies(base.where(F.col("event_id").isNotNull()), ["event_id"], _one_an_id)

    def write_enriched(events: DataFrame, write: Callable[[DataFrame], object], keys_of: DataFrame | None = None) -> None:
        kept: list[DataFrame] = []
        try:
            write(silver.enrich_events(events, dims["orgs"], dims["resources"], deal=BY_DAY, kept=kept, keys_of=keys_of))
        finally:
            for df in kept:
                df.unpersist()

    if full:
        marks.advance(spark, paths.silver("_intent"), INTENT, run_no, base_name, last, run_ts, True)
        events_path = paths.silver("usage_events_clean")
        write_enriched(base, lambda df: lake.write_table(df, events_path, BY_DAY, replace_all=True, dealt=True))
        daily = silver.daily_usage(spark.read.parquet(events_path), run_ts)
        lake.write_table(daily, paths.silver("daily_usage"), BY_DAY, replace_all=True)
        every = spark.createDataFrame([(None,)], "usage_date date")  # NULL: every day
        _record(spark, paths, marks.newest(spark, paths.silver("_intent"), INTENT), every)
        return int(top.n)

    found = _days_of_changed_dimensions(spark, paths, run_no, dims) if dimensions_changed else []
    if top.n:
        base = _staged(base, _staging(paths, run_no, "new"))
        found += [base.select("usage_date"), _days_of_copies(spark, paths, base)]
    if not found:
        return 0
    days = _staged(reduce(DataFrame.unionByName, found).distinct().coalesce(1), _staging(paths, run_no, "days"))
    old = stored_days(spark, paths.silver("usage_events_clean"), days)
    stored = base if old is None else old.select(*base.columns).unionByName(base)
    merged = dedup.few_copies(stored, ["event_id"], _one_an_id)
    # the dimension rows that are asked for are found from the keys of the stored rows: merging is for the write alone
    write_enriched(merged, lambda df: _staged(df, _staging(paths, run_no, "events"), BY_DAY), keys_of=stored)
    marks.advance(spark, paths.silver("_intent"), INTENT, run_no, base_name, last, run_ts, False)
    _apply(spark, paths, marks.newest(spark, paths.silver("_intent"), INTENT))
    return int(top.n)


def _one_an_id(events: DataFrame) -> DataFrame:
    return dedup_by_key(events, ["event_id"], order_by=["timestamp"], keep_null_keys=False)


def _apply(spark: SparkSession, paths: LakePaths, intent: Row) -> None:
    """Put a staged run's rows in place (again, with the same result, if it was stopped here)."""
    days = spark.read.parquet(_staging(paths, intent.run_no, "days"))
    stored = spark.read.parquet(paths.silver("usage_events_clean")).schema
    rows = spark.read.schema(stored).parquet(_staging(paths, intent.run_no, "events"))
    lake.replace_days(rows, paths.silver("usage_events_clean"), days, dealt=True)
    lake.replace_days(silver.daily_usage(rows, intent.run_ts), paths.silver("daily_usage"), days)
    _record(spark, paths, intent, days)


def _record(spark: SparkSession, paths: LakePaths, intent: Row, days: DataFrame) -> None:
    """The run's days for its consumers, then its progress."""
    days.coalesce(1).write.mode("overwrite").parquet(_touched(paths, intent.base) + f"/run_no={intent.run_no}")
    done = (intent.run_no, intent.base, intent.last_batch_id, intent.run_ts)
    marks.advance(spark, paths.silver("_progress"), PROGRESS, *done)


def _touched(paths: LakePaths, base: str) -> str:
    return paths.silver(f"_touched/base={base}")


def touched_between(spark: SparkSession, paths: LakePaths, base: str, after: int, upto: int) -> DataFrame | None:
    """The days that the silver runs ``after`` (exclusive) to ``upto`` rewrote; None: every day."""
    runs = ",".join(lake.range_globs(after + 1, upto))
    days = spark.read.schema("usage_date date").parquet(f"{_touched(paths, base)}/run_no={{{runs}}}").distinct()
    return None if days.where(F.col("usage_date").isNull()).count() else days


def touched_days(spark: SparkSession, paths: LakePaths) -> DataFrame | None:
    """The days that the last silver run with new data rewrote; None: every day."""
    run = marks.newest(spark, paths.silver("_progress"), PROGRESS)
    return touched_between(spark, paths, run.base, run.run_no - 1, run.run_no)


# ------------------------------------------------------------------ gold


#: The marts that are built from a batch table, and which.
BATCH_MARTS = {
    MART_REVENUE_MONTH_LABEL: "billing_monthly.csv",
    MART_CRITICAL_TICKETS: "support_tickets.csv",
    MART_REVENUE_MONTH: "billing_monthly.csv",
}


def _changed(name: str, current: dict, taken: dict) -> bool:
    """Whether a layer has not taken the current version of a batch table (unknown versions are new)."""
    return name not in current or taken.get(name) != current[name]


DAY_MARTS = (MART_ORG_DAILY_USAGE, MART_GENAI_DAILY, MART_GENAI_DAILY_BY_ORG)


def _days_to_do(spark: SparkSession, paths: LakePaths, seen: Row | None, source: Row, incremental: bool) -> tuple[bool, DataFrame | None]:
    """Whether a consumer that has taken ``seen`` has anything to take from ``source``, and which days (None:
    every day). Another full build than the one it knows, or a run number that went back, is taken whole."""
    if not incremental or seen is None or seen.base != source.base or seen.run_no > source.run_no:
        return True, None
    if seen.run_no == source.run_no:
        return False, None
    return True, touched_between(spark, paths, source.base, seen.run_no, source.run_no)


def _on_days(spark: SparkSession, path: str, table: DataFrame, days: DataFrame) -> DataFrame:
    """The table's rows on these days, from their folders alone."""
    rows = stored_days(spark, path, days, table.schema)
    return table.where(F.lit(False)) if rows is None else rows


#: What the revenue marts were built from: the table of digests, and the runs whose months may be half written.
REVENUE = "digests string, unfinished string"


def _revenue_periods(spark: SparkSession, paths: LakePaths, bill: DataFrame, incremental: bool) -> tuple[str, DataFrame | None]:
    """A name for this run's digests of billing, and the periods to rewrite (None: all).

    The periods are recorded before anything is replaced, and stay recorded until both marts are written: a run that
    stops in between leaves them to the next one, whatever billing holds by then.
    """
    mark, name = paths.gold("_revenue"), uuid.uuid4().hex
    seen = marks.newest(spark, mark, REVENUE) if incremental else None
    now = _staged(changes.group_digests(bill), _digests(paths, name))
    if seen is None or not seen.digests:
        marks.advance(spark, mark, REVENUE, "", "")
        return name, None
    before = spark.read.schema(now.schema).parquet(_digests(paths, seen.digests))
    periods = _staged(changes.changed_periods(before, now), _digests(paths, name, "periods"))
    unfinished = [n for n in seen.unfinished.split(",") if n]
    marks.advance(spark, mark, REVENUE, seen.digests, ",".join([*unfinished, name]))
    for other in unfinished:
        periods = periods.union(spark.read.schema(periods.schema).parquet(_digests(paths, other, "periods")))
    return name, periods.distinct()


def _digests(paths: LakePaths, name: str, what: str = "groups") -> str:
    return paths.gold(f"_revenue_digests/{name}/{what}")


def build_marts(
    spark: SparkSession, paths: LakePaths, incremental: bool = True
) -> dict[str, str]:
    """The five marts (and GenAI per org) from the silver tables.

    The marts keyed by day are partitioned by ``usage_date``; with
    ``incremental`` the days of all silver runs since gold's own mark are
    recomputed and replaced, and the mark is advanced last. The marts built
    from a batch table are rebuilt when that table was ingested anew: of the revenue marts, which are
    partitioned by month, only the months with an (organisation, month) group that changed.
    """
    mark = paths.gold("_progress")
    progress = marks.newest(spark, paths.silver("_progress"), PROGRESS)
    bill = spark.read.parquet(paths.silver("billing_monthly_clean"))
    tickets = spark.read.parquet(paths.silver("support_tickets_clean"))
    cleaned = _versions(spark, paths.silver("_batch"))
    taken = _versions(spark, paths.gold("_batch")) if incremental else {}
    todo = [n for n, table in BATCH_MARTS.items() if _changed(table, cleaned, taken)]
    tasks, digests, totals = {}, None, None
    if MART_CRITICAL_TICKETS in todo:
        tasks[MART_CRITICAL_TICKETS] = lambda: lake.write_table(
            marts.critical_tickets_sla_daily(tickets), paths.gold(MART_CRITICAL_TICKETS)
        )
    if MART_REVENUE_MONTH in todo:
        digests, periods = _revenue_periods(spark, paths, bill, incremental)
        if periods is not None:
            bill = changes.with_period(bill).join(periods, changes.PERIOD, "left_semi").drop(changes.PERIOD)
        # rolled up, and dealt by month, once for both marts, whose groups differ only where a month has several dates
        totals = changes.with_period(marts.revenue_totals(bill), "month_and_year").hint("rebalance", changes.PERIOD)
        totals = totals.persist(StorageLevel.MEMORY_AND_DISK)
        same = marts.one_date_a_label(totals)
        by_month = marts.revenue_by_org_month(bill, totals) if same else changes.with_period(marts.revenue_by_org_month(bill))
        revenue = {
            MART_REVENUE_MONTH_LABEL: (marts.revenue_by_org_month_label(bill, totals), True),
            MART_REVENUE_MONTH: (by_month, same),
        }
        for n, (df, dealt) in revenue.items():
            tasks[n] = lambda n=n, df=df, dealt=dealt: lake.replace_days(
                df, paths.gold(n), periods, changes.PERIOD, dealt=dealt
            )
    due, days = False, None
    if progress is not None:
        due, days = _days_to_do(spark, paths, marks.newest(spark, mark, TAKEN), progress, incremental)
    if due:
        daily = spark.read.parquet(paths.silver("daily_usage"))
        if days is not None:
            daily = _on_days(spark, paths.silver("daily_usage"), daily, days)
        by_day = {
            MART_ORG_DAILY_USAGE: marts.org_daily_usage_by_service(daily),
            MART_GENAI_DAILY: marts.genai_tokens_cost_daily(daily),
            MART_GENAI_DAILY_BY_ORG: marts.genai_tokens_cost_daily_by_org(daily),
        }
        for n, df in by_day.items():
            # the rollup is stored by day, and the first mart is its rows
            tasks[n] = lambda n=n, df=df: lake.replace_days(df, paths.gold(n), days, dealt=n == MART_ORG_DAILY_USAGE)
    try:
        run_parallel(tasks)
    finally:
        if totals is not None:
            totals.unpersist()
    if due:
        marks.advance(spark, mark, TAKEN, progress.run_no, progress.base)
    if digests:
        marks.advance(spark, paths.gold("_revenue"), REVENUE, digests, "")
    if todo:
        _put_versions(spark, paths.gold("_batch"), cleaned)
    return {name: paths.gold(name) for name in tasks}


# ------------------------------------------------------------------ serving


def publish_all(spark: SparkSession, paths: LakePaths, incremental: bool = True) -> list[str]:
    """Every gold mart as a typed serving table (day-keyed ones: the days since serving's own mark)."""
    mark = f"{paths.serving}/_progress"
    gold = marks.newest(spark, paths.gold("_progress"), TAKEN)
    due, days = False, None
    if gold is not None:
        due, days = _days_to_do(spark, paths, marks.newest(spark, mark, TAKEN), gold, incremental)
    built = _versions(spark, paths.gold("_batch"))
    taken = _versions(spark, f"{paths.serving}/_batch") if incremental else {}
    whole = [n for n, table in BATCH_MARTS.items() if _changed(table, built, taken)]
    names = [*(DAY_MARTS if due else ()), *whole]

    def one(name: str) -> None:
        df = spark.read.parquet(paths.gold(name))
        if name in DAY_MARTS and days is not None:
            df = _on_days(spark, paths.gold(name), df, days)
        serving.publish(df, paths.serving, name, days if name in DAY_MARTS else None, dealt=name in DAY_MARTS)

    run_parallel({name: lambda name=name: one(name) for name in names})
    if due:
        marks.advance(spark, mark, TAKEN, gold.run_no, gold.base)
    if whole:
        _put_versions(spark, f"{paths.serving}/_batch", built)
    return names


def ingest_all(
    spark: SparkSession, paths: LakePaths, run_ts: dt.datetime, late: str = "keep", incremental: bool = True
) -> None:
    """Batch tables and the event stream into bronze, side by side."""
    run_parallel(
        {
            "batch": lambda: ingest_batch(spark, paths, run_ts, incremental),
            "events": lambda: ingest_events(spark, paths, late=late),
        }
    )


def run_all(
    spark: SparkSession,
    paths: LakePaths,
    run_ts: dt.datetime | None = None,
    sf_dir: str | None = None,
    full_refresh: bool = False,
) -> LakePaths:
    """Stage (when ``sf_dir`` is given), ingest, build silver and gold, publish.

    ``full_refresh`` starts from the landing files again: the stream writes a new generation of bronze
    with a new checkpoint, and every table after bronze is rebuilt from it and replaced
    whole. The new generation comes into use once silver has been built from it; nothing of the
    old one is deleted. Returns the paths that are in use now.
    """
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if full_refresh:
        paths = replace(paths, generation=paths.generation + 1)
    if sf_dir is not None:
        stage_landing(spark, sf_dir, paths)
    ingest_all(spark, paths, run_ts, incremental=not full_refresh)
    build_silver(spark, paths, run_ts, incremental=not full_refresh)
    if full_refresh:
        marks.advance(spark, f"{paths.root.rstrip('/')}/_generation", GENERATION, paths.generation)
    build_marts(spark, paths, incremental=not full_refresh)
    publish_all(spark, paths, incremental=not full_refresh)
    return paths
