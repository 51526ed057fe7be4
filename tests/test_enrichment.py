"""Enrichment by dimensions of every size, and how often whole events are shuffled for it."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from finlake.operators import silver
from finlake.sources import fixtures


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    raw = fixtures.usage_events_raw(spark, sf_dir).where("event_id is not null")
    n = F.col("event_id").cast("long") % 11
    events = raw.withColumn("region", F.when(n == 3, F.lit(None)).otherwise(F.col("region"))).withColumn(
        "org_id", F.when(n == 5, F.lit(None)).when(n == 7, F.lit("nobody")).when(n == 9, F.lit("8")).otherwise(F.col("org_id"))
    )
    return events, silver.orgs_clean(fixtures.customers_orgs(spark, sf_dir)), silver.resources_clean(fixtures.resources(spark, sf_dir))


def _plain(events, orgs, resources):
    return events.join(orgs, ["org_id"], "left").join(resources, silver.RESOURCE_KEY, "left")


def test_keys_with_nulls_and_hot_keys_get_what_plain_joins_give(monkeypatch, tables):
    plain = _plain(*tables)
    monkeypatch.setattr(silver, "BROADCAST_BYTES", 0)
    for hot_rows in (5, 1_000_000):
        found = silver.enrich_events(*tables, hot_rows=hot_rows)
        assert found.columns == plain.columns
        assert _rows(found) == _rows(plain)


def test_whole_events_are_shuffled_once(monkeypatch, tables):
    monkeypatch.setattr(silver, "BROADCAST_BYTES", 0)
    events = tables[0].repartition(3)  # a shuffle of its own, for all columns
    plan = plan_text(silver.enrich_events(events, *tables[1:]), "formatted")
    wide = re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[[^\]]*carbon_kg[^\]]*\]\nArguments: hashpartitioning", plan)
    assert len(wide) == 1


def test_rows_that_no_event_asks_for_do_not_count(monkeypatch, tables):
    events, orgs, resources = tables
    few = events.where("org_id in ('8', '9')")
    size = silver.measured_bytes(resources) // 2
    monkeypatch.setattr(silver, "BROADCAST_BYTES", size)
    found = silver.enrich_events(few, orgs, resources)
    assert "BroadcastHashJoin" in plan_text(found, "simple") and "_salt" not in plan_text(found, "simple")
    assert _rows(found) == _rows(_plain(few, orgs, resources))
