"""Connected components of a graph given as a table of edges, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, root: the smallest node reachable from each node that has an edge.

    ``edges`` has long columns a and b (a table that is cheap to read).  Each
    round links every larger neighbour of a node to the smallest neighbour,
    then every smaller one, until the edges are stars around their smallest
    node.  A node with very many edges is only ever aggregated by minimum and
    joined with one row, never gathered.  Rounds grow with the logarithm of
    the longest path; each ends in a written table.
    """
    least, most = F.least("a", "b"), F.greatest("a", "b")
    edges = save(edges.filter("a <> b").select(least.alias("a"), most.alias("b")).distinct(), name)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").filter("b > a").select(F.col("b"), "m")
                 .filter("b <> m").select(F.col("m").alias("a"), "b").distinct())
        # now a < b on every edge: b's smaller neighbours are its a's
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        small = (small.select(F.col("m").alias("x"), F.col("a").alias("y"))
                 .unionByName(small.select(F.col("m").alias("x"), F.col("b").alias("y")))
                 .filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        edges = save(small, name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


__all__ = ["components"]
