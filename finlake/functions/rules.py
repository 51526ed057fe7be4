"""Data-quality rules on usage events, as NULL-safe boolean columns.

Each rule is a plain column expression, so the whole rule set stays inside
whole-stage codegen. A rule that cannot be decided (a NULL operand) counts as
failed: without this a NULL verdict would send a row to neither the good nor
the quarantine output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from finlake.functions.constants import ACCEPTED_SCHEMA_VERSIONS, MEASURE_LIMIT, METRIC_UNITS, SUMMED_MEASURES

EVENT_ID_VALID = "is_event_id_valid"
TIMESTAMP_VALID = "is_valid_timestamp"
UNIT_PRESENT = "is_unit_valid"
SCHEMA_VERSION_VALID = "is_schema_version_valid"
UNIT_MATCHES_METRIC = "is_correct_unit"
# Ours: the original summed doubles, where one NaN makes a total NaN.
MEASURES_SUMMABLE = "is_measure_summable"
QUARANTINE = "is_quarantine"
RULE_NAMES = [
    EVENT_ID_VALID,
    TIMESTAMP_VALID,
    UNIT_PRESENT,
    SCHEMA_VERSION_VALID,
    UNIT_MATCHES_METRIC,
    MEASURES_SUMMABLE,
]


def _decided(rule: Column) -> Column:
    """TRUE only when the rule holds; NULL (undecidable) becomes FALSE."""
    return F.coalesce(rule, F.lit(False))


def unit_matches_metric(metric: Column, unit: Column) -> Column:
    """The unit a known metric requires; an unknown metric passes."""
    branches = None
    for name, expected in METRIC_UNITS.items():
        cond, value = metric == F.lit(name), unit == F.lit(expected)
        branches = F.when(cond, value) if branches is None else branches.when(cond, value)
    return branches.otherwise(F.lit(True))


def summable(measure: Column) -> Column:
    """NULL, or a finite number small enough that many of them add up exactly (NaN is not below the limit)."""
    return measure.isNull() | (F.abs(measure) < F.lit(MEASURE_LIMIT))


def rule_columns() -> dict[str, Column]:
    """The rules, by output column name, in evaluation order."""
    value, unit = F.col("value"), F.col("unit")
    return {
        EVENT_ID_VALID: F.col("event_id").isNotNull(),
        TIMESTAMP_VALID: F.col("timestamp").isNotNull(),
        UNIT_PRESENT: F.when(value.isNotNull(), unit.isNotNull()).otherwise(F.lit(True)),
        SCHEMA_VERSION_VALID: _decided(
            F.col("schema_version").isin(*ACCEPTED_SCHEMA_VERSIONS)
        ),
        UNIT_MATCHES_METRIC: _decided(unit_matches_metric(F.col("metric"), unit)),
        MEASURES_SUMMABLE: reduce(lambda a, b: a & b, [summable(F.col(m)) for m in SUMMED_MEASURES]),
    }


def quarantine_verdict(flag_names: list[str] | None = None) -> Column:
    """TRUE when any rule failed (flags are never NULL, so neither is this)."""
    names = flag_names or RULE_NAMES
    return reduce(lambda a, b: a | b, [~F.col(n) for n in names])
