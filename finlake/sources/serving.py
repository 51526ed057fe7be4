"""Publication of the gold marts as serving tables with fixed column types.

Each mart is coerced to its serving schema with one ``select`` of casts (NULL
stays NULL) and written by the executors; nothing is collected to the driver.
Lookups then read the published table with its schema, and their filters
reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finlake import schemas
from finlake.sources.lake import replace_days, write_table

# Published table -> partition column (lookups filter on it, so it prunes).
PARTITION_BY: dict[str, list[str]] = {
    "org_daily_usage_by_service": ["usage_date"],
    "genai_tokens_cost_daily": ["usage_date"],
    "genai_tokens_cost_daily_by_org": ["usage_date"],
}


#: Parquet Bloom filters, for lookups by organisation.
BLOOM = {"parquet.bloom.filter.enabled#org_id": "true", "parquet.bloom.filter.expected.ndv#org_id": "100000"}


def coerce(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, cast to its types; a missing column is NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def clustered(df: DataFrame, part: list[str] | None, dealt: bool = False) -> DataFrame:
    """Rows dealt by partition (unless they are ``dealt`` already) and ordered by organisation in it, so that a lookup
    for one organisation skips the row groups of a file that do not hold it (``BLOOM`` adds a filter on top)."""
    if not part or "org_id" not in df.columns:
        return df
    rows = df if dealt else df.hint("rebalance", *part)
    return rows.sortWithinPartitions(*part, "org_id")


def publish(df: DataFrame, serving_root: str, name: str, days: DataFrame | None = None, dealt: bool = False) -> None:
    """Write one mart as the serving table ``name``.

    With ``days``, only these partitions are replaced (the days that a run
    recomputed; the table must be partitioned by day for that). ``dealt`` says that ``df`` is read from a table
    with the same partitions.
    """
    part = PARTITION_BY.get(name)
    out = clustered(coerce(df, schemas.SERVING[name]), part, dealt)
    path = f"{serving_root.rstrip('/')}/{name}"
    if part and days is not None:
        replace_days(out, path, days, part[0], options=BLOOM, dealt=dealt)
    else:
        dealt = part is not None and (dealt or "org_id" in out.columns)
        write_table(out, path, part, replace_all=True, dealt=dealt, options=BLOOM)


def read_published(spark: SparkSession, serving_root: str, name: str) -> DataFrame:
    """A serving table, read with its schema (no inference, typed partition column)."""
    return spark.read.schema(schemas.SERVING[name]).parquet(f"{serving_root.rstrip('/')}/{name}")
