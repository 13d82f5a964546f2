"""Connected components of a link table, by joins and partial aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import settled


def least_neighbour(links: DataFrame) -> DataFrame:
    """For each first end of (u, v) the least of its neighbours and itself, as ``m``."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).withColumnRenamed("u", "w")


def both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def linked_to(links: DataFrame, least: DataFrame, rows) -> DataFrame:
    """Each chosen row (u, v) turned into (v, least of u), without loops and repeats."""
    joined = links.join(least, F.col("u") == F.col("w")).where(rows).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.where("u <> v")


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v) but the roots; a root is the least of its component.

    Alternates two steps until nothing changes: every node ties its larger neighbours, then itself and
    its smaller neighbours, to the least node it knows. Each step is a minimum per node, aggregated
    before the shuffle, and an equi join that adaptive execution can split at a hub. Each round is
    written to the shared folder; only a count and a checksum reach the driver.
    """
    state = settled(links.where("u <> v").select("u", "v").distinct(), "links")
    seen = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        double = both_ways(state)
        large = linked_to(double, least_neighbour(double), F.col("v") > F.col("u")).distinct()
        # The least of a node must stay tied to the node itself where it has only larger neighbours.
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = least_neighbour(down)
        small = linked_to(down, least, F.lit(True)).union(
            least.where("w <> m").select(F.col("w").alias("u"), F.col("m").alias("v"))
        )
        state = settled(
            small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
        )
