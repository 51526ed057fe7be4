"""Inputs in the shapes the pipeline expects, derived from the driver's tables.

The pipeline's own inputs (usage events, organisations, resources, invoices,
support tickets) are not shipped, so they are rebuilt here from the TPC-H-like
tables under ``sf_dir`` (see FIXTURES.md). The rows contain, on purpose, the
NULLs, replays, duplicates and mismatches the pipeline must handle.

Each builder is a lazy DataFrame plan over the parquet files, so every query
that starts from one of them grows with the tables. Copies of a row are made
with a bounded ``explode`` over one scan, not with a join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _with_copies(df: DataFrame, second_copy: Column, other: dict[str, Column] | None = None) -> DataFrame:
    """Each row once, and a second time where ``second_copy`` holds: identical, but for
    the columns in ``other``."""
    n = F.when(second_copy, F.lit(2)).otherwise(F.lit(1))
    copies = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), n)))
    changed = {c: F.when(F.col("_copy") == 2, v).otherwise(F.col(c)) for c, v in (other or {}).items()}
    return copies.withColumns(changed).drop("_copy")


def _str(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def usage_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream: one row per event, replays included."""
    e = _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("eid"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.col("value").alias("v"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )
    k, eid, user = F.col("k"), F.col("eid"), F.col("user_id")
    service = (
        F.when(F.col("event_type") == "click", "networking")
        .when(F.col("event_type") == "view", "storage")
        .when(F.col("event_type") == "purchase", "genai")
        .when(F.col("event_type") == "signup", "database")
        .otherwise("compute")
    )
    metric = (
        F.when(k % 4 == 0, "requests")
        .when(k % 4 == 1, "cpu_hours")
        .when(k % 4 == 2, "storage_gb_hours")
        .otherwise("other")
    )
    b = e.withColumns({"service": service, "metric": metric})
    m = F.col("metric")
    unit = (
        F.when(k == 18, F.lit(None).cast("string"))
        .when(k == 17, "bad")
        .when(m == "requests", "count")
        .when(m == "cpu_hours", "hours")
        .when(m == "storage_gb_hours", "gb_hours")
        .otherwise("unit")
    )
    region_no = F.when(k % 7 == 0, (user + 1) % 5).otherwise(user % 5)
    r = b.select(
        F.when(eid % 97 == 5, F.lit(None).cast("string")).otherwise(_str(eid)).alias("event_id"),
        F.when(k == 13, F.lit(None).cast("timestamp")).otherwise(F.col("ts")).alias("timestamp"),
        _str(user).alias("org_id"),
        F.concat(F.lit("res-"), _str(user), F.lit("-"), F.col("service")).alias("resource_id"),
        "service",
        F.concat(F.lit("region-"), _str(region_no)).alias("region"),
        "metric",
        F.when(k.isin(20, 18) & (eid % 2 == 0), F.lit(None).cast("double"))
        .when(eid % 4999 == 11, F.col("v") * 1e12)
        .otherwise(F.col("v"))
        .alias("value"),
        unit.alias("unit"),
        (F.round(F.col("v") * 0.05, 4) + (eid % 100).cast("double") / 1e8).alias("cost_usd_increment"),
        F.when(k == 29, F.lit(None).cast("int"))
        .when(k == 31, F.lit(3))
        .otherwise((k % 2 + 1).cast("int"))
        .alias("schema_version"),
        F.round(F.col("v") * 0.001, 6).alias("carbon_kg"),
        F.when(k != 33, (k * 10).cast("int")).alias("genai_tokens"),
        "eid",
    )
    return _with_copies(r, eid % 50 == 0).drop("eid")


def usage_events_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, and for some of them a replay a day later with another cost."""
    raw = usage_events_raw(spark, sf_dir)
    later = raw.where(F.col("event_id").cast("long") % 70 == 0).withColumns(
        {
            "timestamp": F.col("timestamp") + F.expr("interval 1 day"),
            "cost_usd_increment": F.col("cost_usd_increment") + 1,
        }
    )
    return raw.unionByName(later)


def customers_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisations: one per customer, some without a name, some twice."""
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "inner")
    out = j.select(
        _str("c_custkey").alias("org_id"),
        F.when(F.col("c_custkey") % 41 == 7, F.lit(None).cast("string"))
        .otherwise(F.col("c_name"))
        .alias("org_name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("n_name").alias("hq_country"),
        "c_custkey",
    )
    older = {"industry": F.concat(F.lit("~"), F.col("industry"))}
    return _with_copies(out, F.col("c_custkey") % 100 == 0, older).drop("c_custkey")


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resources: four services for two customers in three, some without id."""
    c = _table(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 != 0)
    services = F.array(*[F.lit(s) for s in ("networking", "storage", "genai", "database")])
    s = c.select("c_custkey", "c_acctbal", F.explode(services).alias("service"))
    key = F.col("c_custkey")
    out = s.select(
        F.when(key % 29 == 11, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("res-"), _str(key), F.lit("-"), F.col("service")))
        .alias("resource_id"),
        _str(key).alias("org_id"),
        F.concat(F.lit("region-"), _str(key % 5)).alias("region"),
        "service",
        F.col("c_acctbal").alias("quota"),
        "c_custkey",
    )
    return _with_copies(out, key % 50 == 0, {"quota": F.col("quota") + 1}).drop("c_custkey")


def _hundredths(c: str, digits: int) -> Column:
    """The column rounded to two places (as ``decimal(digits,2)``), counted in hundredths: a sum of long integers is as
    exact as one of decimals, and takes a third of their room in a shuffle. A sum of 9.2e14 or more fails the job. A
    decimal is made, by way of its text, only of a number that is not the double nearest to some hundredths."""
    n = F.rint(F.col(c) * F.lit(100.0))
    whole = (F.abs(n) < F.lit(float(10**digits))) & (n / F.lit(100.0) == F.col(c))
    return F.when(whole, n.cast("long")).otherwise((F.col(c).cast(f"decimal({digits},2)") * F.lit(100)).cast("long"))


def _of_ten_thousandths(c: str) -> Column:
    """The double nearest to a number of ten-thousandths: one division, where doubles hold the number exactly."""
    exact = F.col(c).between(-(1 << 52), 1 << 52)
    decimal = (F.col(c).cast("decimal(19,0)") * F.lit(Decimal("0.0001"))).cast("double")
    return F.when(exact, F.col(c).cast("double") / F.lit(10_000.0)).otherwise(decimal)


def orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, each with the taxes, credits and last ship date of its lines: what invoices and tickets share."""
    li = _table(spark, sf_dir, "lineitem")
    price, tax, discount = (
        _hundredths(c, digits) for c, digits in (("l_extendedprice", 12), ("l_tax", 4), ("l_discount", 4))
    )
    per_order = li.groupBy("l_orderkey").agg(
        F.sum(price * tax).alias("taxes"), F.sum(price * discount).alias("credits"), F.max("l_shipdate").alias("shipped")
    )
    o = _table(spark, sf_dir, "orders")
    j = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left").drop("l_orderkey")
    return j.withColumns({c: _of_ten_thousandths(c) for c in ("taxes", "credits")})


def billing_monthly(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Invoices: one per order (``orders_with_lines``), taxes and credits from its lines, some twice."""
    j = orders_with_lines(spark, sf_dir) if orders is None else orders
    rate = F.lit(0.5) + (F.col("o_custkey") % 7919).cast("double") / 10000.0
    out = j.select(
        _str("o_orderkey").alias("invoice_id"),
        _str("o_custkey").alias("org_id"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
        F.col("o_totalprice").alias("subtotal"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
        .otherwise(F.col("credits"))
        .alias("credits"),
        "taxes",
        rate.cast("double").alias("exchange_rate_to_usd"),
        "o_orderkey",
    )
    return _with_copies(out, F.col("o_orderkey") % 40 == 0).drop("o_orderkey")


def support_tickets(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Support tickets: one per order (``orders_with_lines``), resolved when the order is filled."""
    j = orders_with_lines(spark, sf_dir) if orders is None else orders
    p = F.col("o_orderpriority")
    severity = (
        F.when(p == "1-URGENT", "critical")
        .when(p == "2-HIGH", "high")
        .when(p == "3-MEDIUM", "medium")
        .otherwise("low")
    )
    out = j.select(
        F.when(F.col("o_orderkey") % 89 == 3, F.lit(None).cast("string"))
        .otherwise(_str("o_orderkey"))
        .alias("ticket_id"),
        _str("o_custkey").alias("org_id"),
        severity.alias("severity"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("shipped").cast("timestamp")).alias(
            "resolved_at"
        ),
        (F.col("o_totalprice") > 250000).alias("sla_breached"),
        "o_orderkey",
    )
    open_ = {"resolved_at": F.lit(None).cast("timestamp"), "sla_breached": ~F.col("sla_breached")}
    return _with_copies(out, F.col("o_orderkey") % 60 == 0, open_).drop("o_orderkey")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users: one per customer; carried through the lake but never joined."""
    return _table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user-"), _str("c_custkey")).alias("user_id"),
        _str("c_custkey").alias("org_id"),
    )


BUILDERS = {
    "usage_events_raw": usage_events_raw,
    "customers_orgs": customers_orgs,
    "resources": resources,
    "billing_monthly": billing_monthly,
    "support_tickets": support_tickets,
    "users": users,
}
