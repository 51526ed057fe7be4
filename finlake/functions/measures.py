"""Measure columns: exact sums, metric un-stacking, version-gated fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from finlake.functions.constants import (
    EXACT_SUM_TYPE,
    EXTENDED_SCHEMA_VERSION,
    GENAI_SERVICE,
    METRIC_COLUMNS,
)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_total(c: str | Column) -> Column:
    """Sum as an exact decimal.

    A double sum depends on the order rows arrive in, so it can change with
    the number of partitions or a task retry. Adding decimals is exact and
    associative, so the total is the same on any cluster layout. NULLs are
    skipped; the total is NULL only when every input is.
    """
    return F.sum(_c(c).cast(EXACT_SUM_TYPE))


def exact_sum(c: str | Column) -> Column:
    """``exact_total`` as double, for results that are not added any further."""
    return exact_total(c).cast("double")


def exact_avg(c: str | Column) -> Column:
    """Mean of the known values: the exact sum over their number."""
    return exact_sum(c) / F.count(_c(c))


def as_double(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles: the types that marts and lookups show."""
    exact = {f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.select(*[F.col(c).cast("double").alias(c) if c in exact else c for c in df.columns])


def metric_columns(metric: str = "metric", value: str = "value") -> dict[str, Column]:
    """One column per known metric: the value where the metric matches, else 0.

    A NULL value stays NULL in its own metric's column.
    """
    return {
        m: F.when(F.col(metric) == F.lit(m), F.col(value)).otherwise(F.lit(0.0))
        for m in METRIC_COLUMNS
    }


def genai_tokens_kept() -> Column:
    """Tokens count only for GenAI events of the extended schema, else 0."""
    keep = (F.col("service") == F.lit(GENAI_SERVICE)) & (
        F.col("schema_version") == F.lit(EXTENDED_SCHEMA_VERSION)
    )
    return F.when(keep, F.col("genai_tokens")).otherwise(F.lit(0))


def carbon_kept() -> Column:
    """Carbon counts only for events of the extended schema, else 0.0."""
    keep = F.col("schema_version") == F.lit(EXTENDED_SCHEMA_VERSION)
    return F.when(keep, F.col("carbon_kg")).otherwise(F.lit(0.0))
