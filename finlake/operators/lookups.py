"""Parameterised lookups over the published marts, and the top-services report.

Each lookup is a filter on a table, so Spark pushes the predicates into the
parquet scan (and prunes partitions on the partition column) instead of
fetching the whole table and filtering it in Python. ``None`` for a parameter
means no filter on it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.functions.constants import TOP_SERVICES_DAYS
from finlake.functions.measures import exact_sum


def _day(d: str | dt.date) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def _and(conds: list[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def _between(col: str, start: str | dt.date | None, end: str | dt.date | None) -> list[Column]:
    conds = []
    if start is not None:
        conds.append(F.col(col) >= _day(start))
    if end is not None:
        conds.append(F.col(col) <= _day(end))
    return conds


def lookup_costs_daily(
    org_daily_usage: DataFrame,
    org: str | None,
    services: Iterable[str] | None,
    start: str | dt.date | None,
    end: str | dt.date | None,
) -> DataFrame:
    """Daily usage of one organisation for some services, dates inclusive."""
    conds = _between("usage_date", start, end)
    if org is not None:
        conds.append(F.col("org_id") == F.lit(org))
    if services is not None:
        conds.append(F.col("service").isin(list(services)))
    return org_daily_usage.where(_and(conds)).orderBy("usage_date", "org_id", "service")


def lookup_top_revenue_months(revenue_label: DataFrame, org: str | None, n: int) -> DataFrame:
    """The ``n`` months with most revenue for an organisation (ties: earlier month)."""
    df = revenue_label if org is None else revenue_label.where(F.col("org_id") == F.lit(org))
    return df.orderBy(F.col("revenue_usd").desc_nulls_last(), F.col("month_and_year")).limit(n)


def lookup_sla_evolution(
    critical_daily: DataFrame, start: str | dt.date | None, end: str | dt.date | None
) -> DataFrame:
    """Critical-ticket SLA rows between two days, inclusive, by day."""
    return critical_daily.where(_and(_between("date", start, end))).orderBy("date")


def lookup_monthly_revenue(
    revenue_month: DataFrame, org: str | None = None, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Revenue of an organisation for one month, every month of a year, or one month of every year."""
    conds = []
    if org is not None:
        conds.append(F.col("org_id") == F.lit(org))
    if year is not None and month is not None:
        conds.append(F.col("month") == F.lit(dt.date(year, month, 1)))
    elif year is not None:
        conds += _between("month", dt.date(year, 1, 1), dt.date(year, 12, 31))
    elif month is not None:
        conds.append(F.month("month") == F.lit(month))
    return revenue_month.where(_and(conds)).orderBy("month", "org_id")


def lookup_genai_tokens(
    genai_by_org: DataFrame,
    org: str | None = None,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
) -> DataFrame:
    """GenAI tokens and cost per day of an organisation, dates inclusive, by day."""
    conds = _between("usage_date", start, end)
    if org is not None:
        conds.append(F.col("org_id") == F.lit(org))
    return genai_by_org.where(_and(conds)).orderBy("usage_date", "org_id")


def top_services(
    daily: DataFrame,
    as_of: str | dt.date,
    n: int,
    days: int = TOP_SERVICES_DAYS,
    org: str | None = None,
) -> DataFrame:
    """Per organisation, the ``n`` services with the highest cost over the
    ``days`` days ending on ``as_of`` (inclusive); ties go to the service name.

    The date filter reaches the scan; the sum is a partial aggregation; the
    rank is a window over (org) whose ``rank <= n`` filter Spark turns into a
    group limit applied before the shuffle, so a huge organisation never
    reaches one task whole.
    """
    end = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of)
    start = end - dt.timedelta(days=days - 1)
    conds = _between("usage_date", start, end)
    if org is not None:
        conds.append(F.col("org_id") == F.lit(org))
    totals = (
        daily.where(_and(conds))
        .groupBy("org_id", "service")
        .agg(exact_sum("daily_cost_usd").alias("cost_usd"))
    )
    w = Window.partitionBy("org_id").orderBy(F.col("cost_usd").desc_nulls_last(), F.col("service"))
    return totals.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
