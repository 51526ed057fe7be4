"""Gold marts over the silver tables.

Every mart is a filter plus a hash aggregation with partial (map-side)
aggregation, so the shuffle carries one row per group per task, whatever the
skew. No mart sorts before it is written: a sort before a write is no promise
to a reader, so the lookups order at read time instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.constants import CRITICAL_SEVERITY, GENAI_SERVICE, MONTH_LABEL_FORMAT
from finlake.functions.measures import as_double, exact_avg, exact_sum
from finlake.schemas import SERVING

FIRST, LAST = "_first_date", "_last_date"
METRIC_TOTALS = ["total_requests", "total_cpu_hours", "total_storage_gb_hours"]

# The published columns.
ORG_DAILY_USAGE_COLUMNS = SERVING["org_daily_usage_by_service"].fieldNames()


def org_daily_usage_by_service(daily: DataFrame) -> DataFrame:
    """Daily usage rows whose three metric totals are all known (totals as doubles)."""
    cols = [c for c in ORG_DAILY_USAGE_COLUMNS if c in daily.columns]
    return as_double(daily.select(*cols)).dropna(subset=METRIC_TOTALS)


def _revenue_measures() -> list:
    return [
        exact_sum("subtotal_usd").alias("revenue_usd"),
        exact_sum(F.coalesce(F.col("credits_usd"), F.lit(0.0))).alias("credits_usd"),
        exact_sum("taxes_usd").alias("tax_usd"),
        exact_avg("exchange_rate_to_usd").alias("fx_applied"),
    ]


def revenue_totals(billing_usd: DataFrame) -> DataFrame:
    """What both revenue marts show: revenue per organisation and ``yyyy-MM`` label, with the first and the last date
    among the rows of each group."""
    label = F.date_format(F.col("month"), MONTH_LABEL_FORMAT).alias("month_and_year")
    dates = [F.min("month").alias(FIRST), F.max("month").alias(LAST)]
    return billing_usd.groupBy("org_id", label).agg(*_revenue_measures(), *dates)


def one_date_a_label(totals: DataFrame) -> bool:
    """Whether no group of ``revenue_totals`` holds several dates of its month."""
    return totals.where(F.col(FIRST) < F.col(LAST)).isEmpty()


def revenue_by_org_month_label(billing_usd: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Revenue per organisation and ``yyyy-MM`` label (``totals``: ``revenue_totals`` of the same rows)."""
    if totals is not None:
        return totals.drop(FIRST, LAST)
    label = F.date_format(F.col("month"), MONTH_LABEL_FORMAT).alias("month_and_year")
    return billing_usd.groupBy("org_id", label).agg(*_revenue_measures())


def revenue_by_org_month(billing_usd: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Revenue per organisation and month (first day of the month). ``totals`` are ``revenue_totals`` of the same rows
    with ``one_date_a_label``: its groups are the same then."""
    if totals is not None:
        rest = [c for c in totals.columns if c not in ("org_id", "month_and_year", FIRST, LAST)]
        return totals.select("org_id", F.col(FIRST).alias("month"), *rest)
    return billing_usd.groupBy("org_id", "month").agg(*_revenue_measures())


def critical_tickets_sla_daily(tickets: DataFrame) -> DataFrame:
    """Critical tickets per creation day: breached, solved, total, breach rate."""
    crit = tickets.where(F.col("severity") == F.lit(CRITICAL_SEVERITY))
    out = crit.groupBy(F.to_date(F.col("created_at")).alias("date")).agg(
        F.count_if(F.col("sla_breached") == F.lit(True)).alias("breach_count"),
        F.count_if(F.col("resolved_at").isNotNull()).alias("solved_count"),
        F.count(F.lit(1)).alias("critical_ticket_count"),
    )
    return out.withColumn(
        "breach_rate", F.col("breach_count").cast("double") / F.col("critical_ticket_count")
    )


def _genai(daily: DataFrame, keys: list[str]) -> DataFrame:
    """GenAI totals from the daily rollup rather than from every event.

    The rollup already holds tokens and cost per (org, service, day); adding
    its exact totals again gives the same result, and reads a table orders of
    magnitude smaller than the events.
    """
    g = daily.where(F.col("service") == F.lit(GENAI_SERVICE))
    return g.groupBy(*keys).agg(
        F.sum("total_genai_tokens").alias("total_genai_tokens"),
        exact_sum("daily_cost_usd").alias("total_genai_cost_usd"),
    )


def genai_tokens_cost_daily(daily: DataFrame) -> DataFrame:
    """GenAI tokens and cost per day, all organisations (from daily usage)."""
    return _genai(daily, ["usage_date"])


def genai_tokens_cost_daily_by_org(daily: DataFrame) -> DataFrame:
    """GenAI tokens and cost per organisation and day (lets lookups filter by org)."""
    return _genai(daily, ["org_id", "usage_date"])
