"""One organisation holding a third of all events: results stay whole and the
hot partition is split, not funnelled through one task."""

import re

from pyspark.sql import functions as F

from conftest import plan_text
from finlake.operators import joins, quality, silver
from finlake.sources import fixtures

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_org_join_is_split_and_whole(spark):
    sf = "/root/testdata/sf0.01"
    raw = fixtures.usage_events_raw(spark, sf)
    hot = F.when(F.xxhash64("event_id") % 3 == 0, F.lit("8")).otherwise(F.col("org_id"))
    good = quality.ingest_events_split(raw.withColumn("org_id", hot))[0]
    orgs = silver.orgs_clean(fixtures.customers_orgs(spark, sf))
    n_hot = good.where("org_id = '8'").count()
    assert n_hot > good.count() / 4

    budget = 200
    hk = {r.org_id: r._buckets for r in joins.hot_keys(good, ["org_id"], budget).collect()}
    assert hk["8"] == -(-n_hot // budget) and hk["8"] > 10  # the hot org is split this many ways

    def run():
        salted = joins.salted_left_join(good, orgs, ["org_id"], hot_rows=budget)
        plain = good.join(orgs, "org_id", "left")
        key = lambda df: sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
        return key(salted), key(plain), plan_text(salted, "simple")

    salted_rows, plain_rows, plan = _with_conf(spark, SKEW_CONF, run)
    assert salted_rows == plain_rows  # whole: nothing dropped, nothing repeated
    assert re.search(r"hashpartitioning\(org_id#\d+, _salt#\d+", plan)


def test_hot_org_rollup_is_partial(spark):
    sf = "/root/testdata/sf0.01"
    raw = fixtures.usage_events_raw(spark, sf).withColumn("org_id", F.lit("8"))
    good = quality.ingest_events_split(raw)[0]
    clean = silver.derive_event_columns(good)
    daily = silver.daily_usage(clean)
    p = plan_text(daily, "simple")
    assert p.index("partial_sum") > p.index("Exchange hashpartitioning(org_id")
    assert daily.agg(F.sum("event_count")).first()[0] == good.count()


def test_null_heavy_key_is_spread_and_whole(spark):
    sf = "/root/testdata/sf0.01"
    raw = fixtures.usage_events_raw(spark, sf)
    nulls = F.when(F.xxhash64("event_id") % 3 == 0, F.lit(None).cast("string")).otherwise(
        F.col("org_id"))
    facts = raw.withColumn("org_id", nulls).select("event_id", "org_id", "value")
    orgs = silver.orgs_clean(fixtures.customers_orgs(spark, sf))
    salted = joins.salted_left_join(facts, orgs, ["org_id"], hot_rows=200)
    plain = facts.join(orgs, "org_id", "left")
    key = lambda df: sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    assert key(salted) == key(plain)
    # the NULL-key rows are spread over many (key, salt) groups
    spread = facts.where("org_id IS NULL").select(
        F.pmod(F.xxhash64(*facts.columns), F.lit(joins.NULL_SPREAD)).alias("s")).distinct().count()
    assert spread > 100


def test_the_number_of_hot_keys_is_bounded(spark, monkeypatch):
    from finlake.operators import joins

    facts = spark.range(1000).selectExpr("id % 100 AS k")
    assert joins.hot_keys(facts, ["k"], hot_rows=5).count() == 100
    monkeypatch.setattr(joins, "MOST_HOT_KEYS", 20)  # a hot key needs more than a twentieth of all rows
    assert joins.hot_keys(facts, ["k"], hot_rows=5).count() == 0
    skewed = facts.unionByName(spark.range(500).selectExpr("cast(7 AS long) AS k"))
    assert [r.k for r in joins.hot_keys(skewed, ["k"], hot_rows=5).collect()] == [7]
