"""Connected components of a graph given as links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the smallest neighbour of that node, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = both.where(F.col("v") > F.col("u")).join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours meet at the smallest of them; links run from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link: root is the smallest node it can reach.

    Alternates large-star and small-star steps until the links no longer change; each round is a stored
    table, so a lost executor costs one round at most. Rounds grow with the logarithm of the longest path.
    Links of a node to itself and repeated links are allowed; no links give no rows.
    """
    edges = stored(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    before, now = None, _state(edges)
    while now != before:
        edges = stored(_small_star(_large_star(edges)), "links")
        before, now = now, _state(edges)
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(tops)
