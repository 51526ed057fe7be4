"""The usage-event stream: JSON lines -> quality rules -> good and quarantine tables.

One streaming query, one split: every micro-batch is flagged once and written
inside ``foreachBatch``, so an event is in exactly one table.

De-duplication (on ``event_id``) has two levels, so that no row is lost and the state stays
bounded:

* the state: ``dropDuplicatesWithinWatermark`` behind a watermark on the time of *arrival*. Arrival
  never runs backwards, so nothing is ever late for it, and an id leaves the state
  ``STATE_KEPT`` after it was last seen;
* the index (``finlake.sources.event_ids``): inside ``foreachBatch``, rows whose id arrived in an earlier
  micro-batch go, however long ago that was. Only the buckets of the batch's ids are read.

Rows without an id or a time never enter either level (they fail a rule and are all
quarantined). A line that is no JSON has neither; its text is kept in the
quarantine table's ``raw_line``.

Late rows (``late``): an event is late when its time is more than ``EVENT_WATERMARK`` behind the latest
one of the micro-batches before. ``"keep"`` (default) treats it like any other;
``"aside"`` writes it, flagged, to a table of its own; ``"drop"`` is what the original declared, a watermark
on event time in the state: late rows are dropped by Spark and counted
(``dropped_by_watermark``), and copies further apart than it pass (silver de-duplicates
again). A watermark in front of plain ``dropDuplicates`` would drop them, too, although
the event time is not part of the key; ``tests/test_stream.py`` measures this.

Output is idempotent: micro-batch N is written to ``<table>/batch_id=N``
with overwrite, so a batch replayed after a failure replaces its own output.
After all writes the batch records itself, with the latest event time so far, as the last
complete one (``mark_path``), whichever way the query was started.

A trigger takes at most ``FILES_PER_TRIGGER`` files, so a first run over a large
drop folder is many bounded micro-batches. State belongs in RocksDB
(``finlake.session`` sets it): on local disk, not in the heap.
"""

from __future__ import annotations

import time
from contextlib import contextmanager, nullcontext

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from finlake import schemas
from finlake.functions.constants import EVENT_WATERMARK, INGEST_DATE_FORMAT
from finlake.operators.quality import split, with_quality_flags
from finlake.plans.parallel import run_parallel
from finlake.sources import event_ids, marks
from finlake.sources.lake import CODEC, RAW_LINE


#: Files of a micro-batch, at most.
FILES_PER_TRIGGER = 1000
#: Rows of an output file, about: a small micro-batch is written as one file, not as one per state partition.
ROWS_PER_FILE = 250_000
#: How long after its arrival an id stays in the state (older copies meet the index).
STATE_KEPT = "24 hours"
LATE = ("keep", "aside", "drop")
#: Progress reports that a query keeps (Spark's default).
RECENT_REPORTS = 100
MARK = "last_batch_id long, latest timestamp"
_ARRIVED = "_arrived"


def mark_path(good_path: str) -> str:
    """Where the last complete micro-batch is recorded."""
    return good_path.rstrip("/") + "_mark"


def last_batch(spark: SparkSession, good_path: str, before: int | None = None) -> Row | None:
    """The mark of the last complete micro-batch (``before``: of the last one before that batch)."""
    return marks.newest(spark, mark_path(good_path), MARK, before)


class DroppedRows(StreamingQueryListener):
    """Counts the rows that the watermark dropped, over every progress report of a query."""

    def __init__(self) -> None:
        self.total: dict[str, int] = {}  # by the run of a query
        self.last_batch: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802  (Spark's names)
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        run = str(event.progress.runId)
        self.total[run] = self.total.get(run, 0) + dropped_rows(event.progress)
        self.last_batch[run] = max(self.last_batch.get(run, -1), event.progress.batchId)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def dropped_rows(progress) -> int:
    operators = progress.stateOperators or []
    return sum(int(getattr(op, "numRowsDroppedByWatermark", 0) or 0) for op in operators)


def read_event_stream(
    spark: SparkSession,
    source: str,
    schema: StructType = schemas.USAGE_EVENT,
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Files arriving in ``source`` (sub-folders included), read with a fixed
    schema, plus the path of the file each row came from.

    ``archive_dir`` moves processed files there (Spark's ``cleanSource``):
    a batch's files are moved when a later batch commits, so a long-running
    stream does not list an ever-growing drop folder on every trigger.
    """
    if fmt == "json":  # the text of a line that is no JSON
        schema = StructType([*schema.fields, StructField(RAW_LINE, StringType())])
        options = {"columnNameOfCorruptRecord": RAW_LINE, **(options or {})}
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(source).withColumn("source_file", F.col("_metadata.file_path"))


def dedup_stream(
    events: DataFrame, watermark: str = EVENT_WATERMARK, late: str = "keep", state_kept: str = STATE_KEPT
) -> DataFrame:
    """Stateful de-duplication on event_id; id-less or time-less rows bypass it (see the module notes)."""
    keyed_cond = F.col("event_id").isNotNull() & F.col("timestamp").isNotNull()
    keyed = events.where(keyed_cond)
    if late == "drop":
        return keyed.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["event_id"]).unionByName(
            events.where(~keyed_cond)
        )
    arrived = keyed.withColumn(_ARRIVED, F.current_timestamp()).withWatermark(_ARRIVED, state_kept)
    unique = arrived.dropDuplicatesWithinWatermark(["event_id"]).drop(_ARRIVED)
    return unique.unionByName(events.where(~keyed_cond))


def prepare(
    events: DataFrame, watermark: str = EVENT_WATERMARK, late: str = "keep", state_kept: str = STATE_KEPT
) -> DataFrame:
    """De-duplicated, stamped (ingest time and day) and flagged events."""
    unique = dedup_stream(events, watermark, late, state_kept)
    stamped = unique.withColumn("ingest_ts", F.current_timestamp()).withColumn(
        "date", F.date_format(F.col("ingest_ts"), INGEST_DATE_FORMAT)
    )
    return with_quality_flags(stamped)


def new_ids_only(batch: DataFrame, batch_id: int, good_path: str, buckets: int) -> DataFrame:
    """The rows whose id did not arrive in an earlier micro-batch (and all without an id or a time)."""
    keyed = F.col("event_id").isNotNull() & F.col("timestamp").isNotNull()
    seen = event_ids.known(batch.sparkSession, good_path, batch.where(keyed), buckets)
    if seen is None:
        return batch
    earlier = seen.where(F.col("batch_id") < batch_id).select("event_id")
    return batch.where(keyed).join(earlier, "event_id", "left_anti").unionByName(batch.where(~keyed))


def write_split_batch(
    batch: DataFrame,
    batch_id: int,
    good_path: str,
    quarantine_path: str,
    late: str = "keep",
    late_path: str | None = None,
    watermark: str = EVENT_WATERMARK,
    id_buckets: int = event_ids.ID_BUCKETS,
) -> None:
    """Write one flagged micro-batch to its tables (idempotent per batch id)."""
    spark = batch.sparkSession
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    rows = batch
    try:
        found = batch.agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("latest")).first()
        kept = found.n
        before = last_batch(spark, good_path, batch_id) if batch_id else None
        if late != "drop" and before is not None:
            rows = new_ids_only(batch, batch_id, good_path, id_buckets).persist(StorageLevel.MEMORY_AND_DISK)
            # joined here, by a task per partition: a task that writes a file only reads what is stored, instead of
            # joining all partitions of its file, with the memory of every one of these sorts
            kept = rows.count()
        latest = None if before is None else before.latest
        on_time, behind = rows, None
        if late == "aside":
            oldest = F.lit(latest).cast("timestamp") - F.expr(f"interval {watermark}")
            is_late = F.coalesce(F.col("event_id").isNotNull() & (F.col("timestamp") < oldest), F.lit(False))
            on_time, behind = rows.where(~is_late), rows.where(is_late)
        good, bad = split(on_time)
        files = kept // ROWS_PER_FILE + 1

        def write(df: DataFrame, root: str) -> None:
            (
                df.coalesce(files)
                .write.mode("overwrite")
                .option("compression", CODEC)
                .option("partitionOverwriteMode", "static")
                .partitionBy("date")
                .parquet(f"{root.rstrip('/')}/batch_id={batch_id}")
            )

        # Folders of their own, one persisted input: the writes run side by side.
        tasks = {
            "good": lambda: write(good.drop(RAW_LINE), good_path),
            "quarantine": lambda: write(bad, quarantine_path),
            "ids": lambda: event_ids.add(rows.coalesce(files), good_path, batch_id, id_buckets),
        }
        if behind is not None:
            tasks["late"] = lambda: write(behind, late_path)
        run_parallel(tasks)
        newest = max((t for t in (latest, found.latest) if t is not None), default=None)
        marks.put(spark, mark_path(good_path), MARK, batch_id, batch_id, newest)
    finally:
        batch.unpersist()
        if rows is not batch:
            rows.unpersist()


def start_ingest(
    spark: SparkSession,
    source: str,
    good_path: str,
    quarantine_path: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    late: str = "keep",
    late_path: str | None = None,
    watermark: str = EVENT_WATERMARK,
    max_files_per_trigger: int | None = FILES_PER_TRIGGER,
    source_format: str = "json",
    archive_dir: str | None = None,
    id_buckets: int = event_ids.ID_BUCKETS,
    state_kept: str = STATE_KEPT,
) -> StreamingQuery:
    """Start the ingestion query (``available_now``: process what is there, then stop).

    The checkpoint keeps the processed files and the de-duplication state
    between runs, so a second run over the same files adds nothing.
    """
    if late not in LATE or (late == "aside" and not late_path):
        raise ValueError(f"late is one of {LATE}, and 'aside' needs late_path")
    flagged = prepare(
        read_event_stream(
            spark,
            source,
            fmt=source_format,
            max_files_per_trigger=max_files_per_trigger,
            archive_dir=archive_dir,
        ),
        watermark,
        late,
        state_kept,
    )
    writer = (
        flagged.writeStream.foreachBatch(
            lambda df, bid: write_split_batch(df, bid, good_path, quarantine_path, late, late_path, watermark, id_buckets)
        ).option("checkpointLocation", checkpoint)
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    with nullcontext() if late == "drop" else _without_empty_batches(spark):
        return writer.start()


@contextmanager
def _without_empty_batches(spark: SparkSession):
    """A query that starts here (it keeps the settings of its start) runs no micro-batch without rows only to drop
    old state: the next one with rows does that. (Late rows are dropped by the watermark of the micro-batch before,
    so ``late="drop"`` needs the empty one between two runs.)"""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def run_ingest_once(spark: SparkSession, *args, **kwargs) -> StreamingQuery:
    """Run the ingestion until the files present now are processed. Where the watermark can drop rows, they are
    counted by a listener."""
    if kwargs.get("late", "keep") != "drop":
        q = _finished(start_ingest(spark, *args, **kwargs))
        q.dropped_rows = 0
        return q
    counter = DroppedRows()
    spark.streams.addListener(counter)
    try:
        q = _finished(start_ingest(spark, *args, **kwargs))
        recent = q.recentProgress
        if len(recent) < RECENT_REPORTS:  # a short run: the query itself still has every report
            q.dropped_rows = sum(dropped_rows(p) for p in recent)
            return q
        last, run, waited = q.lastProgress, str(q.runId), 0.0
        while last is not None and counter.last_batch.get(run, -1) < last.batchId and waited < 10:
            time.sleep(0.05)  # reports reach a listener a little later
            waited += 0.05
        q.dropped_rows = counter.total.get(run, 0) if waited < 10 else None
    finally:
        spark.streams.removeListener(counter)
    return q


def _finished(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows the stateful operator dropped as later than the watermark, in the whole
    run of ``run_ingest_once`` (always zero unless ``late="drop"``)."""
    if query.dropped_rows is None:
        raise RuntimeError("the query's progress reports did not all arrive")
    return query.dropped_rows
