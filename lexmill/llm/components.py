"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import write_once


def _stars(edges: DataFrame) -> DataFrame:
    """One round: larger neighbours to the smallest neighbour, then smaller ones to the smallest.

    Minima are combined before the shuffle, and the joins leave a node with many links to Spark's
    splitting of skewed partitions.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    large = write_once(large.where(F.col("u") > F.col("v")), "large-star")
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") > F.col("v"))
    return write_once(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: two bigint nodes) that is not its component itself.

    The component is the smallest node reachable. Rounds go on until the edges stay the same, which takes about
    the logarithm of the longest path. Loops, repeated edges and edges with a null end do no harm.
    """
    edges = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = write_once(edges, "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        edges, before = _stars(edges), now
