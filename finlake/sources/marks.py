"""Progress marks: one small row that is never lost while it is replaced.

A mark lives in two slots. Mark n goes to slot n mod 2, so that writing it replaces mark
n - 2 and leaves mark n - 1 alone; a reader takes the newest row there is. A
run that stops while it writes a mark therefore finds the one before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because nothing is at the path (and not for any other reason)."""
    return error.getCondition() == "PATH_NOT_FOUND"


def newest(spark: SparkSession, path: str, schema: str, before: int | None = None) -> Row | None:
    """The newest mark (``before``: the newest with a smaller number), or None where there is none."""
    try:
        rows = spark.read.schema(f"mark_no long, {schema}").parquet(path.rstrip("/") + "/slot=*")
        if before is not None:
            rows = rows.where(F.col("mark_no") < before)
        return max(rows.collect(), key=lambda r: r.mark_no, default=None)  # two rows at most
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise


def put(spark: SparkSession, path: str, schema: str, mark_no: int, *values) -> None:
    fields = StructType.fromDDL(f"mark_no long, {schema}").fields
    row = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, (mark_no, *values))]
    one = spark.range(0, 1, 1, 1).select(*row)
    one.write.mode("overwrite").parquet(f"{path.rstrip('/')}/slot={mark_no % 2}")


def advance(spark: SparkSession, path: str, schema: str, *values) -> None:
    """The next mark after the newest."""
    last = newest(spark, path, schema)
    put(spark, path, schema, 0 if last is None else last.mark_no + 1, *values)
