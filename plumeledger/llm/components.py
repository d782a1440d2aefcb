"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def _stars(edges: DataFrame) -> bool:
    """Whether every ``a`` has one ``b`` and no ``b`` is an ``a``: then nothing is left to do."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    held = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return held.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` for every node of an edge ``a, b`` (longs): the root is the smallest
    node reachable. Loops and repeated edges are allowed.

    A step sends every edge to the smallest neighbour of one of its ends. The smallest
    neighbours come from a pre-aggregated group and are joined back from a written table, so
    a node with very many neighbours is never gathered in one task: its edges are a skewed
    join, which Spark splits.
    """
    # No step has more edges than these, or more nodes than they have ends.
    n = 2 * edges.count()
    current = scratch.stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), n
    )
    while not _stars(current):
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = scratch.stage(
            both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low")), n
        )
        large = scratch.stage(
            both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), n
        )
        least = scratch.stage(large.groupBy("a").agg(F.min("b").alias("low")), n)
        small = scratch.stage(
            large.join(least, "a")
            .where("b <> low")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(least.select("a", "low"))
            .distinct(),
            n,
        )
        scratch.drop(current, lowest, large, least)
        current = small
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
