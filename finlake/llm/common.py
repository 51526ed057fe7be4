"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from finlake.session import run_dir

#: The white space of every word and text rule here: space and 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared folder and read back: cuts the lineage, and a
    lost executor costs nothing that was written."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_batch(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


def text_bytes() -> F.Column:
    """The text as UTF-8 bytes, NULL as empty."""
    return F.coalesce(F.col("text").cast("binary"), F.lit(b""))


def packed(docs: DataFrame, **more: F.Column) -> DataFrame:
    """Whole rows as one column ``row``, with further columns: no names can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[c.alias(name) for name, c in more.items()])
