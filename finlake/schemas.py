"""Explicit schemas of the landing inputs and of the published tables.

Reading with a schema (not inference) costs no extra pass over the data and
gives the same types on every run, whatever the first rows look like.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Usage events as they arrive on the stream (JSON lines). event_id is
# nullable: a file stream forces every field nullable anyway, and the
# quality rules check it.
USAGE_EVENT = _schema(
    ("event_id", StringType()),
    ("timestamp", TimestampType()),
    ("org_id", StringType()),
    ("resource_id", StringType()),
    ("service", StringType()),
    ("region", StringType()),
    ("metric", StringType()),
    ("value", DoubleType()),
    ("unit", StringType()),
    ("cost_usd_increment", DoubleType()),
    ("schema_version", IntegerType()),
    ("carbon_kg", DoubleType()),
    ("genai_tokens", IntegerType()),
)

CUSTOMERS_ORGS = _schema(
    ("org_id", StringType()),
    ("org_name", StringType()),
    ("industry", StringType()),
    ("hq_country", StringType()),
)

RESOURCES = _schema(
    ("resource_id", StringType()),
    ("org_id", StringType()),
    ("region", StringType()),
    ("service", StringType()),
    ("quota", DoubleType()),
)

BILLING_MONTHLY = _schema(
    ("invoice_id", StringType()),
    ("org_id", StringType()),
    ("month", DateType()),
    ("subtotal", DoubleType()),
    ("credits", DoubleType()),
    ("taxes", DoubleType()),
    ("exchange_rate_to_usd", DoubleType()),
)

SUPPORT_TICKETS = _schema(
    ("ticket_id", StringType()),
    ("org_id", StringType()),
    ("severity", StringType()),
    ("created_at", TimestampType()),
    ("resolved_at", TimestampType()),
    ("sla_breached", BooleanType()),
)

USERS = _schema(
    ("user_id", StringType()),
    ("org_id", StringType()),
)

# Landing file name -> schema of the batch tables.
BATCH_TABLES: dict[str, StructType] = {
    "customers_orgs.csv": CUSTOMERS_ORGS,
    "resources.csv": RESOURCES,
    "billing_monthly.csv": BILLING_MONTHLY,
    "support_tickets.csv": SUPPORT_TICKETS,
    "users.csv": USERS,
}

# Published (serving) tables: one fixed type per column. Numbers are double or
# long, ids and labels strings, days are dates; NULL stays NULL.
SERVING: dict[str, StructType] = {
    "org_daily_usage_by_service": _schema(
        ("org_id", StringType()),
        ("service", StringType()),
        ("usage_date", DateType()),
        ("daily_cost_usd", DoubleType()),
        ("total_requests", DoubleType()),
        ("total_cpu_hours", DoubleType()),
        ("total_storage_gb_hours", DoubleType()),
        ("total_genai_tokens", LongType()),
        ("total_carbon_kg", DoubleType()),
        ("last_updated", TimestampType()),
    ),
    "services_by_cum_cost_by_org": _schema(
        ("org_id", StringType()),
        ("month_and_year", StringType()),
        ("revenue_usd", DoubleType()),
        ("credits_usd", DoubleType()),
        ("tax_usd", DoubleType()),
        ("fx_applied", DoubleType()),
    ),
    "critical_tickets_evolution_sla_rate_daily": _schema(
        ("date", DateType()),
        ("breach_count", LongType()),
        ("solved_count", LongType()),
        ("critical_ticket_count", LongType()),
        ("breach_rate", DoubleType()),
    ),
    "revenue_by_org_month_usd": _schema(
        ("org_id", StringType()),
        ("month", DateType()),
        ("revenue_usd", DoubleType()),
        ("credits_usd", DoubleType()),
        ("tax_usd", DoubleType()),
        ("fx_applied", DoubleType()),
    ),
    "genai_tokens_cost_daily": _schema(
        ("usage_date", DateType()),
        ("total_genai_tokens", LongType()),
        ("total_genai_cost_usd", DoubleType()),
    ),
    "genai_tokens_cost_daily_by_org": _schema(
        ("org_id", StringType()),
        ("usage_date", DateType()),
        ("total_genai_tokens", LongType()),
        ("total_genai_cost_usd", DoubleType()),
    ),
}
