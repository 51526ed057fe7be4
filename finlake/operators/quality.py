"""Quality flags, verdict and the good / quarantine split of usage events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions import rules
from finlake.operators.dedup import dedup_by_key


def with_quality_flags(df: DataFrame) -> DataFrame:
    """All input columns, the five rule flags and ``is_quarantine``."""
    flags = rules.rule_columns()
    flagged = df.select("*", *[c.alias(n) for n, c in flags.items()])
    return flagged.withColumn(rules.QUARANTINE, rules.quarantine_verdict(list(flags)))


def split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): complementary, so together they are the input."""
    q = F.col(rules.QUARANTINE)
    return flagged.where(~q), flagged.where(q)


def _arrival_branches(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row per id among rows with an id and a time, rows without either)."""
    keyed = F.col("event_id").isNotNull() & F.col("timestamp").isNotNull()
    unique = dedup_by_key(
        events.where(keyed), ["event_id"], order_by=["timestamp"], keep_null_keys=False
    )
    return unique, events.where(~keyed)


def dedup_arrivals(events: DataFrame) -> DataFrame:
    """Batch form of the stream's de-duplication.

    Events with an id and a time keep one row per id; rows without an id or
    time are never merged (they fail a rule and are all quarantined), exactly
    as the streaming job treats them.
    """
    unique, unkeyed = _arrival_branches(events)
    return unique.unionByName(unkeyed)


def ingest_events_batch(events: DataFrame) -> DataFrame:
    """De-duplicated, flagged events: what the stream writes, as one batch."""
    return with_quality_flags(dedup_arrivals(events))


def ingest_events_split(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of ``ingest_events_batch``, planned per branch.

    A row without an id or a time fails a rule, so good rows come from the
    de-duplicated branch alone: the good output keeps that branch's hash
    partitioning on event_id, and a later de-duplication or aggregation on
    event_id needs no new shuffle.
    """
    unique, unkeyed = _arrival_branches(events)
    good, bad = split(with_quality_flags(unique))
    return good, bad.unionByName(with_quality_flags(unkeyed))


def verdict_counts(flagged: DataFrame) -> DataFrame:
    """Rows per verdict, with how many rows fail each rule."""
    names = rules.RULE_NAMES
    return flagged.groupBy(rules.QUARANTINE).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(~F.col(n)).alias(f"n_fail_{n}") for n in names],
    )
