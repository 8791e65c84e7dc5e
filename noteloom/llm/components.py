"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom.llm.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is tied to the smallest node around that node."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("near"))
    least = least.select(F.col("a").alias("node"), F.least("a", "near").alias("least"))
    return both.join(least, both["a"] == least["node"]).filter("b > a").select(F.col("least").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least")).withColumnRenamed("b", "node")
    joined = edges.join(least, edges["b"] == least["node"])
    return joined.select(F.col("least").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a < b")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links as ``(node, root)``: each node that has a link, and the smallest node it can reach.

    Nulls and links of a node with itself are left out; links may repeat and be given in either
    direction.  No links give no rows.  Each round is one written table, and the number of rounds
    grows with the logarithm of the longest path.  A node with very many links meets one row of
    minima in a plain shuffle join, which adaptive execution splits.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")
    before = _mark(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    member = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return member.union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
