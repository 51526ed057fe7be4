"""The query catalogue: one lazy plan per operator family, from the driver's tables.

Each entry takes ``(spark, sf_dir)``, builds the pipeline's inputs from the
parquet tables under ``sf_dir`` (``finlake.sources.fixtures``) and runs the
library's operators on them. Batch entries are pure plans; the streaming,
source and publication entries run their job into a fresh folder under the
shared folder (``spark.checkpoint.dir``) and read the result back.

Parameters of the parameterised lookups are fixed here (see SURVEY §7).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake import schemas
from finlake.functions import rules
from finlake.functions.measures import as_double
from finlake.operators import audit, lookups, marts, quality, silver
from finlake.operators.joins import left_join
from finlake.plans.parallel import run_parallel
from finlake.session import run_dir
from finlake.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]

EVENT_COLUMNS = schemas.USAGE_EVENT.fieldNames()
FLAG_COLUMNS = rules.RULE_NAMES + [rules.QUARANTINE]
CLEAN_EVENT_COLUMNS = EVENT_COLUMNS + [
    "org_name",
    "industry",
    "hq_country",
    "quota",
    "usage_date",
    "requests",
    "cpu_hours",
    "storage_gb_hours",
]
DAILY_COLUMNS = [
    "org_id",
    "service",
    "usage_date",
    "daily_cost_usd",
    "total_requests",
    "total_cpu_hours",
    "total_storage_gb_hours",
    "total_genai_tokens",
    "total_carbon_kg",
    "event_count",
]

# Parameters of the lookups (the org has events and invoices at every scale).
LOOKUP_ORG = "8"
LOOKUP_SERVICES = ("genai", "storage")
LOOKUP_START, LOOKUP_END = dt.date(2024, 1, 5), dt.date(2024, 1, 25)
TOP_N_MONTHS = 5
SLA_START, SLA_END = dt.date(1997, 1, 1), dt.date(1998, 12, 31)
MONTHLY_YEAR, MONTHLY_MONTH = 1995, 2
TOP_SERVICES_AS_OF, TOP_SERVICES_N = dt.date(2024, 1, 30), 3


# ---------------------------------------------------------------- chain pieces


def events_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ingest_events_batch(fixtures.usage_events_raw(spark, sf_dir))


def events_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ingest_events_split(fixtures.usage_events_raw(spark, sf_dir))[0]


def events_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.usage_events_clean(
        events_good(spark, sf_dir),
        fixtures.customers_orgs(spark, sf_dir),
        fixtures.resources(spark, sf_dir),
        unique=True,
    )


def events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events without dimension columns: what every rollup reads."""
    return silver.usage_events_base(events_good(spark, sf_dir), unique=True)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.daily_usage(events_base(spark, sf_dir))


def billing_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.billing_usd(fixtures.billing_monthly(spark, sf_dir))


def tickets_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.tickets_clean(fixtures.support_tickets(spark, sf_dir))


def mart_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The gold marts by published name (without the run stamp)."""
    usage = daily(spark, sf_dir)
    bill = billing_silver(spark, sf_dir)
    return {
        "org_daily_usage_by_service": marts.org_daily_usage_by_service(usage),
        "services_by_cum_cost_by_org": marts.revenue_by_org_month_label(bill),
        "critical_tickets_evolution_sla_rate_daily": marts.critical_tickets_sla_daily(
            tickets_silver(spark, sf_dir)
        ),
        "revenue_by_org_month_usd": marts.revenue_by_org_month(bill),
        "genai_tokens_cost_daily": marts.genai_tokens_cost_daily(usage),
        "genai_tokens_cost_daily_by_org": marts.genai_tokens_cost_daily_by_org(usage),
    }


def _stored_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five gold marts as stored tables: each is computed once, then read."""
    root = run_dir(spark, "marts")
    frames = mart_frames(spark, sf_dir)
    frames.pop("genai_tokens_cost_daily_by_org")

    def written(name: str) -> DataFrame:
        frames[name].write.parquet(f"{root}/{name}")
        return spark.read.schema(frames[name].schema).parquet(f"{root}/{name}")

    return run_parallel({name: lambda name=name: written(name) for name in frames})


# ---------------------------------------------------------------- the entries


def q_quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_quality_flags(fixtures.usage_events_raw(spark, sf_dir))


def q_quality_verdict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdict_counts(events_flagged(spark, sf_dir))


def q_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from finlake.operators.dedup import dedup_by_key

    raw = fixtures.usage_events_replayed(spark, sf_dir)
    return dedup_by_key(raw, ["event_id"], order_by=["timestamp"])


def q_silver_billing_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return billing_silver(spark, sf_dir)


def q_silver_tickets_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickets_silver(spark, sf_dir)


def q_silver_orgs_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.orgs_clean(fixtures.customers_orgs(spark, sf_dir))


def q_silver_resources_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.resources_clean(fixtures.resources(spark, sf_dir))


def q_silver_metric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.usage_events_raw(spark, sf_dir)
    derived = silver.derive_event_columns(raw)
    return derived.select(
        "event_id",
        "service",
        "metric",
        "value",
        "schema_version",
        "usage_date",
        "genai_tokens",
        "carbon_kg",
        "requests",
        "cpu_hours",
        "storage_gb_hours",
    )


def q_join_events_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orgs = silver.orgs_clean(fixtures.customers_orgs(spark, sf_dir))
    ev = events_good(spark, sf_dir).select("event_id", "org_id")
    return left_join(ev, orgs, ["org_id"])


def q_join_events_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = silver.resources_clean(fixtures.resources(spark, sf_dir))
    ev = events_good(spark, sf_dir).select("event_id", *silver.RESOURCE_KEY)
    return left_join(ev, res, silver.RESOURCE_KEY)


def q_silver_usage_events_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_clean(spark, sf_dir).select(*CLEAN_EVENT_COLUMNS)


def q_silver_daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(daily(spark, sf_dir).select(*DAILY_COLUMNS))


def q_mart_org_daily_usage_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.org_daily_usage_by_service(daily(spark, sf_dir))


def q_mart_revenue_by_org_month_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_org_month_label(billing_silver(spark, sf_dir))


def q_mart_critical_tickets_sla_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.critical_tickets_sla_daily(tickets_silver(spark, sf_dir))


def q_mart_revenue_by_org_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_org_month(billing_silver(spark, sf_dir))


def q_mart_genai_tokens_cost_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.genai_tokens_cost_daily(daily(spark, sf_dir))


def q_mart_genai_tokens_cost_daily_by_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.genai_tokens_cost_daily_by_org(daily(spark, sf_dir))


def q_lookup_costs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.org_daily_usage_by_service(daily(spark, sf_dir))
    return lookups.lookup_costs_daily(mart, LOOKUP_ORG, LOOKUP_SERVICES, LOOKUP_START, LOOKUP_END)


def q_lookup_top_revenue_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.revenue_by_org_month_label(billing_silver(spark, sf_dir))
    return lookups.lookup_top_revenue_months(mart, LOOKUP_ORG, TOP_N_MONTHS)


def q_lookup_sla_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.critical_tickets_sla_daily(tickets_silver(spark, sf_dir))
    return lookups.lookup_sla_evolution(mart, SLA_START, SLA_END)


def q_lookup_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.revenue_by_org_month(billing_silver(spark, sf_dir))
    return lookups.lookup_monthly_revenue(mart, LOOKUP_ORG, MONTHLY_YEAR, MONTHLY_MONTH)


def q_lookup_genai_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.genai_tokens_cost_daily_by_org(daily(spark, sf_dir))
    return lookups.lookup_genai_tokens(mart, LOOKUP_ORG, LOOKUP_START, LOOKUP_END)


def q_top_services_14d(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lookups.top_services(daily(spark, sf_dir), TOP_SERVICES_AS_OF, TOP_SERVICES_N)
    return out.withColumnRenamed("rank", "service_rank")


def q_audit_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        audit.columns_with_nulls_df(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in _stored_marts(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def q_audit_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = as_double(daily(spark, sf_dir)).select("org_id", "service", "usage_date", *marts.METRIC_TOTALS)
    return audit.null_rows(d, marts.METRIC_TOTALS)


BATCH_QUERIES: dict[str, Query] = {
    "quality_flags": q_quality_flags,
    "quality_verdict_counts": q_quality_verdict_counts,
    "dedup_events": q_dedup_events,
    "silver_billing_usd": q_silver_billing_usd,
    "silver_tickets_clean": q_silver_tickets_clean,
    "silver_orgs_clean": q_silver_orgs_clean,
    "silver_resources_clean": q_silver_resources_clean,
    "silver_metric_columns": q_silver_metric_columns,
    "join_events_orgs": q_join_events_orgs,
    "join_events_resources": q_join_events_resources,
    "silver_usage_events_clean": q_silver_usage_events_clean,
    "silver_daily_usage": q_silver_daily_usage,
    "mart_org_daily_usage_by_service": q_mart_org_daily_usage_by_service,
    "mart_revenue_by_org_month_label": q_mart_revenue_by_org_month_label,
    "mart_critical_tickets_sla_daily": q_mart_critical_tickets_sla_daily,
    "mart_revenue_by_org_month": q_mart_revenue_by_org_month,
    "mart_genai_tokens_cost_daily": q_mart_genai_tokens_cost_daily,
    "mart_genai_tokens_cost_daily_by_org": q_mart_genai_tokens_cost_daily_by_org,
    "lookup_costs_daily": q_lookup_costs_daily,
    "lookup_top_revenue_months": q_lookup_top_revenue_months,
    "lookup_sla_evolution": q_lookup_sla_evolution,
    "lookup_monthly_revenue": q_lookup_monthly_revenue,
    "lookup_genai_tokens": q_lookup_genai_tokens,
    "top_services_14d": q_top_services_14d,
    "audit_null_columns": q_audit_null_columns,
    "audit_null_rows": q_audit_null_rows,
}


def queries() -> dict[str, Query]:
    return dict(BATCH_QUERIES)
