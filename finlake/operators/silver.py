"""Silver layer: cleaning, USD normalisation, enrichment, daily rollup.

Every function is DataFrame -> DataFrame; reading and writing live in
``finlake.sources`` and ``finlake.plans.pipeline``.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.measures import carbon_kept, exact_total, genai_tokens_kept, metric_columns
from finlake.operators.dedup import dedup_by_key, distinct_rows, few_copies
from finlake.operators.joins import BROADCAST_BYTES, HOT_ROWS, ROWS, hot_of_counts, measured_bytes, salted_left_join

USAGE_KEY = ["org_id", "service", "usage_date"]
RESOURCE_KEY = ["org_id", "resource_id", "region", "service"]
PROVENANCE = ["ingest_ts", "source_file"]
_KEY = "_key"


def billing_usd(billing: DataFrame, few: bool = False) -> DataFrame:
    """Invoices with amounts in USD (NULL in, NULL out), exact copies removed. ``few`` says that the rows are stored
    and few are expected to be copies (``few_copies``)."""
    rate = F.col("exchange_rate_to_usd")
    usd = billing.drop(*PROVENANCE).withColumns(
        {
            "subtotal_usd": F.col("subtotal") * rate,
            "credits_usd": F.col("credits") * rate,
            "taxes_usd": F.col("taxes") * rate,
        }
    )
    return few_copies(usd, usd.columns, distinct_rows) if few else distinct_rows(usd)


def tickets_clean(tickets: DataFrame, few: bool = False) -> DataFrame:
    """Tickets with an id, one per id, created_at as a date. ``few`` as for ``billing_usd``.

    ``try_to_date`` keeps a malformed date as NULL instead of failing the job
    (ANSI mode raises on bad input).
    """
    created = F.col("created_at")
    as_date = (
        created.cast("date")
        if dict(tickets.dtypes).get("created_at") in ("timestamp", "timestamp_ntz", "date")
        else F.try_to_date(created.cast("string"))
    )
    t = (
        tickets.drop(*PROVENANCE)
        .where(F.col("ticket_id").isNotNull())
        .withColumn("created_at", as_date)
    )
    # of several copies, a resolved one tells more than an open one
    t = t.withColumn("_open", F.col("resolved_at").isNull())

    def unique(rows: DataFrame) -> DataFrame:
        return dedup_by_key(rows, ["ticket_id"], order_by=["_open"], keep_null_keys=False)

    return (few_copies(t, ["ticket_id"], unique) if few else unique(t)).drop("_open")


def orgs_clean(orgs: DataFrame) -> DataFrame:
    """Organisations with an id and a name, one row per id."""
    o = orgs.drop(*PROVENANCE).where(F.col("org_id").isNotNull() & F.col("org_name").isNotNull())
    return dedup_by_key(o, ["org_id"], keep_null_keys=False)


def resources_clean(resources: DataFrame) -> DataFrame:
    """Resources with an id, one row per (org, resource, region, service)."""
    r = resources.drop(*PROVENANCE).where(F.col("resource_id").isNotNull())
    return dedup_by_key(r, RESOURCE_KEY, keep_null_keys=False)


def enrich_events(
    events: DataFrame,
    orgs: DataFrame,
    resources: DataFrame,
    hot_rows: int = HOT_ROWS,
    deal: list[str] | None = None,
    kept: list[DataFrame] | None = None,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """Events LEFT JOIN organisations (org_id) LEFT JOIN resources (four keys).

    Both dimensions are unique on their join keys (cleaned above), so the joins
    never add rows. Dimensions whose measured sizes allow it are broadcast; of larger ones, only the rows that
    the events ask for count. If these are too many as well, both dimensions are joined to the different keys of
    the events first, and the events to the result: one sort-merge join on (key, salt), so whole
    events are shuffled once, and a hot key is spread over several tasks (``finlake.operators.joins``).
    ``events`` are read twice then; where they are not cheap to read, ``keys_of`` are rows with all their keys (more rows
    and keys do no harm) that are read the first time. What the result reads of that is cached, and added to ``kept``, to be
    released once the result is written.
    ``deal`` names the columns by which the result is dealt to tasks: before rows are made wider, where that is possible.
    """
    if not _small(orgs, resources):
        asked = (events if keys_of is None else keys_of).groupBy(*RESOURCE_KEY).agg(F.count(F.lit(1)).alias(ROWS)).persist(StorageLevel.MEMORY_AND_DISK)
        orgs = orgs.join(asked.select("org_id").distinct(), "org_id", "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
        resources = resources.join(asked, RESOURCE_KEY, "left_semi").persist(StorageLevel.MEMORY_AND_DISK)
        if kept is not None:
            kept += [orgs, resources, asked]
        if not _small(orgs, resources):
            found = _enrich_by_key(events, asked, orgs, resources, hot_rows)
            return found.hint("rebalance", *deal) if deal else found
    if deal:
        events = events.hint("rebalance", *deal)
    return events.join(F.broadcast(orgs), ["org_id"], "left").join(F.broadcast(resources), RESOURCE_KEY, "left")


def _small(*dims: DataFrame) -> bool:
    return all(measured_bytes(dim) <= BROADCAST_BYTES for dim in dims)


def _enrich_by_key(
    events: DataFrame, asked: DataFrame, orgs: DataFrame, resources: DataFrame, hot_rows: int
) -> DataFrame:
    """The events with what both dimensions hold for their keys. ``asked`` has a row per different key of the events
    and about its number of events. A key is one struct here, as keys with a NULL in them have an organisation, too."""
    key = F.struct(*RESOURCE_KEY).alias(_KEY)
    told = salted_left_join(asked.drop(ROWS), orgs, ["org_id"], hot_rows).join(resources, RESOURCE_KEY, "left")
    found = [c for dim in (orgs, resources) for c in dim.columns if c not in RESOURCE_KEY]
    hot = hot_of_counts(asked.select(key, ROWS), [_KEY], hot_rows)
    rest = [c for c in events.columns if c not in RESOURCE_KEY]
    joined = salted_left_join(events.select("*", key), told.select(key, *found), [_KEY], hot_rows, hot=hot)
    return joined.select(*RESOURCE_KEY, *rest, *found)


def derive_event_columns(events: DataFrame) -> DataFrame:
    """usage_date, version-gated tokens and carbon, one column per metric."""
    return events.withColumns(
        {
            "usage_date": F.to_date(F.col("timestamp")),
            "genai_tokens": genai_tokens_kept(),
            "carbon_kg": carbon_kept(),
            **metric_columns(),
        }
    )


def usage_events_base(good_events: DataFrame, unique: bool = False) -> DataFrame:
    """Good events, one per id, with derived columns (no dimension columns).

    Good events always have an id (the first rule), so no NULL-key branch.
    Enough for every rollup: none needs an organisation or resource column.
    ``unique`` says that every id is there once already (the batch split
    de-duplicates), which saves a shuffle of whole rows.
    """
    derived = derive_event_columns(good_events)
    if unique:
        return derived
    return dedup_by_key(derived, ["event_id"], order_by=["timestamp"], keep_null_keys=False)


def usage_events_clean(
    good_events: DataFrame,
    orgs: DataFrame,
    resources: DataFrame,
    hot_rows: int = HOT_ROWS,
    unique: bool = False,
) -> DataFrame:
    """Good events, one per id, with derived columns, enriched by both dimensions.

    De-duplication runs before the joins (fewer rows to join, and a duplicate
    dimension row cannot multiply events); the dimensions are cleaned here.
    """
    base = usage_events_base(good_events, unique)
    return enrich_events(base, orgs_clean(orgs), resources_clean(resources), hot_rows)


def daily_usage(events_clean: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Usage per (org, service, day): exact decimal sums of cost and measures, row count.

    ``last_updated`` is added only when a run time is given, so the rollup
    itself is deterministic.
    """
    out = events_clean.groupBy(*USAGE_KEY).agg(
        exact_total("cost_usd_increment").alias("daily_cost_usd"),
        exact_total("requests").alias("total_requests"),
        exact_total("cpu_hours").alias("total_cpu_hours"),
        exact_total("storage_gb_hours").alias("total_storage_gb_hours"),
        F.sum("genai_tokens").alias("total_genai_tokens"),
        exact_total("carbon_kg").alias("total_carbon_kg"),
        F.count(F.lit(1)).alias("event_count"),
    )
    if run_ts is not None:
        out = out.withColumn("last_updated", F.lit(run_ts).cast("timestamp"))
    return out
