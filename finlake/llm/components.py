"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node of ``edges`` (a, b).

    Large-star and small-star rounds: each node's neighbours are linked to the
    smallest of them, until only stars are left. Minima are aggregated before
    the shuffle and joined back, so a node with very many neighbours is split by
    Spark's skew join. A round's edges are written to the shared folder.
    """

    edges = edges.where(F.col("a") != F.col("b"))
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("low")), "low")
        low = low.select(F.col("a").alias("n"), F.least("a", "low").alias("low"))
        large = both.join(low, F.col("a") == F.col("n")).where(F.col("b") > F.col("a"))
        large = stored(large.select(F.col("b").alias("a"), F.col("low").alias("b")), "edges")
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")), "low")
        up = low.select(F.col("a").alias("n"), "low")
        down = large.join(up, F.col("a") == F.col("n")).where(F.col("b") != F.col("low")).select("b", "low")
        small = low.select("a", F.col("low").alias("b")).unionByName(
            down.select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        edges = stored(small.distinct(), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def stars(edges: DataFrame) -> bool:
    """Whether every node has one edge at most, to a node that has none."""
    nodes = edges.select("a", F.lit(1).alias("up")).unionByName(
        edges.select(F.col("b").alias("a"), F.lit(0).alias("up")).distinct()
    )
    # a centre is in one row, with no way up; any other node in one row, with one
    return nodes.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
