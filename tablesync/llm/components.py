"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b) with a != b; a component is named by its smallest node.

    Alternates the public large-star and small-star steps until the links no longer change. Each step is
    written to the shared folder; the driver sees two numbers a round. An empty table gives an empty result.
    """
    edges = staged(_ordered(links), "links")
    before = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour, or to itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _ordered(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, and the node, are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("m").alias("b"))))
