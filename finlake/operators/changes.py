"""Which groups of a table changed since they were last rolled up.

What is rewritten is a month, so each month of billing rows has a digest: its number of rows and the sum of their hashes
(organisation included), so neither order nor layout matters. Two tables of digests tell the months with an (organisation,
month) group that is new, gone or changed. One row per month is compared, never the billing rows themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.constants import MONTH_LABEL_FORMAT

#: The partition column of the revenue marts; rows without a month have a folder of their own.
PERIOD, NO_PERIOD = "period", "none"
#: What the revenue marts are computed from.
READ = ["org_id", "month", "subtotal_usd", "credits_usd", "taxes_usd", "exchange_rate_to_usd"]


def with_period(df: DataFrame, month: str = "month") -> DataFrame:
    """``df`` with the month's label as partition column (a ``month`` that is a label already stays as it is)."""
    label = F.col(month) if df.schema[month].dataType.simpleString() == "string" else F.date_format(F.col(month), MONTH_LABEL_FORMAT)
    return df.withColumn(PERIOD, F.coalesce(label, F.lit(NO_PERIOD)))


def group_digests(billing_usd: DataFrame) -> DataFrame:
    """period, n_rows, digest of the groups of each period (partial aggregation: a period leaves a task as one row)."""
    return with_period(billing_usd).groupBy(PERIOD).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*READ).cast("decimal(38,0)")).alias("digest")
    )


def changed_periods(before: DataFrame, now: DataFrame) -> DataFrame:
    """The periods with a group that differs between two tables of digests."""
    side = lambda df, n: df.withColumn("n_rows", F.col("n_rows") * n).withColumn("digest", F.col("digest") * n)
    left = side(now, 1).unionByName(side(before, -1)).groupBy(PERIOD)
    differs = left.agg(F.sum("n_rows").alias("n_rows"), F.sum("digest").alias("digest"))
    return differs.where("n_rows <> 0 or digest <> 0").select(PERIOD).distinct()
