"""Lake tables: partitioned parquet writes and typed reads.

Writes are idempotent: a partitioned write replaces only the partitions the
new data holds (dynamic partition overwrite), so a re-run or a retried job
leaves one copy. Before a partitioned write the rows are rebalanced on the
partition column (AQE splits a hot partition value over several tasks and
merges small ones), so a day holding a third of the data is written by many
tasks in parallel and a quiet day does not produce a swarm of tiny files.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from finlake import schemas
from finlake.functions import rules
from finlake.sources.marks import is_missing

SOURCE_FILE = "source_file"
#: How the lake's parquet files are compressed.
CODEC = "zstd"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    replace_all: bool = False,
    dealt: bool = False,
    options: dict[str, str] | None = None,
) -> None:
    """Write parquet; with ``partition_by``, replace only the partitions written.

    ``replace_all`` replaces the whole table (a full refresh of that table); ``dealt`` says
    that the rows are dealt and ordered by partition already.
    """
    writer_df = df.hint("rebalance", *partition_by) if partition_by and not dealt else df
    w = writer_df.write.mode("overwrite").option("compression", CODEC).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "static" if replace_all else "dynamic"
        )
    w.parquet(path)


def replace_days(
    df: DataFrame,
    path: str,
    days: DataFrame | None,
    column: str = "usage_date",
    options: dict[str, str] | None = None,
    dealt: bool = False,
) -> None:
    """Replace the given days of a table by ``df``; None replaces the whole table.

    ``dealt`` says that ``df`` is read from files that each hold one day: its tasks write as many files as
    they read, so the rows are neither dealt again nor kept.

    Dynamic overwrite leaves a partition alone that the new rows do not hold,
    so a day that has no row any more is overwritten with an empty file. Such
    days are few (all their events moved to another day); their names reach the
    driver one after the other, never as a list.
    """
    if days is None:
        write_table(df, path, [column], replace_all=True, dealt=dealt)
        return
    if not dealt:
        df.persist(StorageLevel.MEMORY_AND_DISK)  # written, and asked for the days that it holds
    try:
        write_table(df, path, [column], dealt=dealt, options=options)
        nothing = df.where(F.lit(False)).drop(column).coalesce(1)
        for row in days.join(df.select(column).distinct(), column, "left_anti").toLocalIterator():
            nothing.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={row[column]}")
    finally:
        if not dealt:
            df.unpersist()


def range_globs(low: int, high: int) -> list[str]:
    """Glob patterns that name exactly the integers ``low`` to ``high``: a few per digit,
    however long the range."""
    out = []
    while low <= high:
        width = 0
        while (
            (low > 0 or width == 0)
            and low % 10 ** (width + 1) == 0
            and low + 10 ** (width + 1) - 1 <= high
        ):
            width += 1
        out.append((str(low // 10**width) if low else "0" * (width == 0)) + "[0-9]" * width)
        low += 10**width
    return out


def read_partitions(
    spark: SparkSession, root: str, column: str, values: list, schema: StructType | None = None
) -> DataFrame | None:
    """The given partitions of a table, or None if none of them exists.

    Naming the folders in a brace glob (``basePath`` keeps the partition
    column) lists one directory level plus the named folders.
    """
    if not values:
        return None
    try:
        names = ",".join(str(v) for v in values)
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.option("basePath", root).parquet(f"{root.rstrip('/')}/{column}={{{names}}}")
    except AnalysisException as error:  # none of the folders exists (yet)
        if is_missing(error):
            return None
        raise


def write_source_partition(df: DataFrame, root: str, file_name: str) -> None:
    """One table into its own ``source_file=<name>`` folder of a shared area.

    The folder is replaced as a whole (a rerun leaves one copy), and tables go
    to separate folders, so several tables can be written at the same time.
    Readers see the usual partition layout (``read_source_partition``).
    """
    body = df.drop(SOURCE_FILE) if SOURCE_FILE in df.columns else df
    body.write.mode("overwrite").option("compression", CODEC).parquet(f"{root.rstrip('/')}/{SOURCE_FILE}={file_name}")


def write_bronze_batch(df: DataFrame, bronze_batch: str, file_name: str) -> None:
    """A landing table into the bronze batch area, one partition per source file."""
    write_source_partition(df, bronze_batch, file_name)


def read_source_partition(
    spark: SparkSession, root: str, file_name: str, schema: StructType | None = None
) -> DataFrame:
    """One ``source_file=`` partition of a table, keeping the partition column.

    ``basePath`` keeps ``source_file`` as a column and the path names the one
    folder, so only that partition is listed and read (the other tables in the
    same area have other schemas and are never touched).
    """
    reader = spark.read.option("basePath", root)
    schema = schema or schemas.BATCH_TABLES.get(file_name)
    if schema is not None:
        full = StructType(
            list(schema.fields)
            + [StructField("ingest_ts", TimestampType(), True)]
            + [StructField(SOURCE_FILE, StringType(), True)]
        )
        reader = reader.schema(full)
    return reader.parquet(f"{root.rstrip('/')}/{SOURCE_FILE}={file_name}")


# Bronze event tables: the event, its flags, provenance and the two partition
# columns (micro-batch id, then ingest day).
BRONZE_EVENT = StructType(
    list(schemas.USAGE_EVENT.fields)
    + [StructField("ingest_ts", TimestampType(), True)]
    + [StructField(SOURCE_FILE, StringType(), True)]
    + [StructField(n, BooleanType(), True) for n in rules.RULE_NAMES]
    + [StructField(rules.QUARANTINE, BooleanType(), True)]
    + [StructField("batch_id", LongType(), True)]
    + [StructField("date", StringType(), True)]
)


#: The text of a line that could not be read; a column of the quarantine table only.
RAW_LINE = "raw_line"
QUARANTINED_EVENT = StructType([*BRONZE_EVENT.fields, StructField(RAW_LINE, StringType(), True)])


def read_bronze_events(spark: SparkSession, path: str) -> DataFrame:
    """Good, quarantined or late events written by the stream, with typed partition columns
    (``date`` stays the ``yyyyMMdd`` string it was written as)."""
    return spark.read.schema(BRONZE_EVENT).parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Quarantined events with the text of the lines that could not be read."""
    return spark.read.schema(QUARANTINED_EVENT).parquet(path)
