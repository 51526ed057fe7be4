"""NULL audit: which columns hold NULLs, and the rows that do.

The counts for every column come from one pass over the table (a single
global aggregation with partial aggregation), not one job per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: (column_name, null_count)."""
    cols = columns or df.columns
    wide = df.select(
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    )
    stacked = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stacked}) AS (column_name, null_count)")


def columns_with_nulls_df(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The columns that hold at least one NULL, with their count."""
    return null_counts(df, columns).where(F.col("null_count") > 0)


def columns_with_nulls(df: DataFrame) -> list[str]:
    """Names of the columns holding a NULL (one small row reaches the driver)."""
    return [r.column_name for r in columns_with_nulls_df(df).collect()]


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where any of ``columns`` is NULL."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))
