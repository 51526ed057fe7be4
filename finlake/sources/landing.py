"""Landing zone: batch CSV tables and the JSON-lines event drop folder.

A batch table is ``<landing>/<name>.csv``, either one file or a folder of part
files (what Spark writes). Tables are found with a file listing through the
DataFrame reader (only paths, never file contents, reach the driver), and
read with their explicit schema when it is known.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finlake import schemas
from finlake.sources.marks import is_missing

#: Rows of a staged CSV file: the files are compressed, so a file is what one task reads.
CSV_ROWS = 500_000
#: Rows of a compressed JSON-lines file.
JSONL_ROWS = 250_000
# Timestamps keep their microseconds through text files.
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def batch_files(spark: SparkSession, landing: str) -> DataFrame | None:
    """name (the table), path, length, modificationTime of every file of the ``*.csv`` entries directly
    under ``landing`` (suffix match); None without any.

    The path is the glob ``<landing>/*.csv``, so only matching top-level
    entries are expanded; the stream's drop folder, which may hold millions
    of files, is never listed. The ``binaryFile`` scan selects no content,
    so no file is opened.
    """
    root = landing.rstrip("/")
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.{csv,csv.gz}")
            .load(f"{root}/*.csv")
            .select("path", "length", "modificationTime")
        )
    except AnalysisException as error:  # nothing matches the glob
        if is_missing(error):
            return None
        raise
    # Paths come back as URIs; the first element under the root is the table.
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", root)
    relative = F.regexp_replace("path", "^.*?" + re.escape(bare) + "/", "")
    named = files.select(F.element_at(F.split(relative, "/"), 1).alias("name"), *files.columns)
    return named.where(F.col("name").endswith(".csv"))


def discover_batch_files(spark: SparkSession, landing: str) -> list[str]:
    """Names of the batch tables in the landing zone (a handful)."""
    files = batch_files(spark, landing)
    return [] if files is None else sorted(r.name for r in files.select("name").distinct().collect())


def manifest(spark: SparkSession, landing: str) -> dict[str, str]:
    """Per batch table a fingerprint of its files' paths, lengths and times: equal as long as no file was
    added, removed or written again. One row per table is collected."""
    files = batch_files(spark, landing)
    if files is None:
        return {}
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    prints = files.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.sum(one).alias("h"))
    return {r.name: f"{r.n}-{r.size}-{r.h}" for r in prints.collect()}


def read_batch_table(
    spark: SparkSession,
    landing: str,
    file_name: str,
    schema: StructType | None = None,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """One landing CSV with provenance: ``ingest_ts`` (the run time) and ``source_file``.

    A known table's columns are matched to its schema *by header name* (a
    schema given to the CSV reader is applied by position, so a file with its
    columns in another order would be read wrongly without any error). Values
    are converted with ``try_cast``: a malformed value becomes NULL instead of
    failing the job. Columns the schema does not name are kept as text; a
    column the file lacks is NULL. An unknown table falls back to header-based
    inference (one extra pass over that file). All part files of a table must
    have the same header: one that has not is refused with a message that names it.
    """
    schema = schema or schemas.BATCH_TABLES.get(file_name)
    path = f"{landing.rstrip('/')}/{file_name}"
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE")
    if schema is None:
        df = reader.option("inferSchema", "true").csv(path)
    else:
        # Every column a string, named by the header; then the same with the header enforced:
        # a part file with other columns, or in another order, fails instead of being mixed up.
        named = reader.csv(path).schema
        text = reader.option("enforceSchema", "false").schema(named).csv(path)
        known = [
            (F.col(f.name).try_cast(f.dataType) if f.name in text.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
        extra = [c for c in text.columns if c not in schema.fieldNames()]
        df = text.select(*known, *extra)
    stamp = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    return df.withColumns({"ingest_ts": stamp, "source_file": F.lit(file_name)})


def read_landing(
    spark: SparkSession, landing: str, run_ts: dt.datetime | None = None, names: list[str] | None = None
) -> dict[str, DataFrame]:
    """Every batch table found in the landing zone (or those named), by file name."""
    names = discover_batch_files(spark, landing) if names is None else names
    return {name: read_batch_table(spark, landing, name, run_ts=run_ts) for name in names}


def write_csv_table(df: DataFrame, landing: str, file_name: str) -> None:
    """Stage a table as ``<landing>/<file_name>`` (a folder of compressed CSV part files)."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", CSV_ROWS)
        .option("timestampFormat", TIMESTAMP_TEXT_FORMAT)
        .csv(f"{landing.rstrip('/')}/{file_name}")
    )


def write_jsonl(df: DataFrame, folder: str, compressed: bool = False) -> None:
    """Stage events as JSON lines (NULL fields are left out, as producers do). ``compressed`` files are what one task
    reads, too."""
    w = df.write.mode("overwrite").option("timestampFormat", TIMESTAMP_TEXT_FORMAT)
    if compressed:
        w = w.option("compression", "gzip").option("maxRecordsPerFile", JSONL_ROWS)
    w.json(folder)
