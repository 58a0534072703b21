"""Connected components of a link table, by alternating stars; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import passing, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (a, b) with a > b: neighbours are linked to the least of the neighbourhood.

    The large star moves the greater neighbours of each node, the small star its lesser
    ones and itself. Least neighbours come from partial aggregates; the join back to the
    neighbours is one that Spark can split where a node is crowded.
    """
    around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    moved = around.join(least, F.col("a") == F.col("c"))
    if large:
        return moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    # one pass over ``moved``: a union would hold its shuffles twice
    both = moved.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
    return both.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node with a link."""
    edges = written(links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).filter("a <> b").distinct(), "links")
    state = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = state(edges)
    while before[0]:
        # written in between, since a star reads its edges more than once
        with passing(_star(edges, True), "large-stars") as large:
            edges = written(_star(large, False), "stars")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
