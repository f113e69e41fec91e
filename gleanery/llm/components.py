"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import common as C


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a"))
    least = down.groupBy("b").agg(F.min("a").alias("m"))
    moved = down.join(least, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).filter("x <> y")
    return moved.unionAll(least.select(F.col("m").alias("x"), F.col("b").alias("y"))).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node of ``links`` (a, b) that is not a root itself.

    Each round is written to shared space; rounds grow with the logarithm of the longest path. A node of very many links is
    first aggregated within the tasks; its rows of the join are split by adaptive execution.
    """
    edges = C.settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    sign = None
    while True:
        edges = C.settle(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == sign:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        sign = now
