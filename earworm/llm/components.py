"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earworm.llm.store import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("m").alias("a"), "b").where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and itself, are tied to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    tied = edges.join(least, "b")
    return (tied.select(F.col("m").alias("a"), F.col("a").alias("b"))
            .unionByName(least.select(F.col("m").alias("a"), "b"))
            .where("a <> b").distinct())


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (bigint a, b); root is the least
    node that can be reached.

    Edges keep a < b.  Each round is two partial aggregates and two joins on
    the edge table; rounds are logarithmic in the longest path.  A hub's edges
    are one key of a join, which adaptive execution splits.  The edge table of
    each round is written to the shared folder, and only its count and a
    checksum reach the driver.  No edges: no rows.  Loops and repeated edges
    change nothing; null ends are dropped.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    edges, seen = written(edges, "edges"), None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
        edges = written(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
