"""Connected components of an edge table by joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import staged


def _minima(edges: DataFrame) -> DataFrame:
    """(u, m) for each u that has a neighbour v, with m the smallest of u and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (u, v); root is the smallest node of its component.

    Each round first hangs all larger neighbours of a node on its smallest neighbour, then all smaller
    ones; the rounds needed grow with the logarithm of the longest path. Minima are formed in each task before
    the shuffle, and no neighbourhood is ever gathered, so a node with very many
    neighbours is harmless. Loops and repeated edges may occur; null ends are dropped.
    """
    edges = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Larger neighbours of u go to the smallest one.
        large = both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct(), "large-star")
        # Smaller neighbours of u, and u itself, go to the smallest one.
        least = _minima(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        small = staged(small.where("u <> v").distinct(), "small-star")
        # Done when the edges are stars: no node is both a root and hung on another one.
        roots = small.select(F.col("v").alias("u")).distinct()
        if small.join(roots, "u", "left_semi").isEmpty() and small.groupBy("u").count().where("count > 1").isEmpty():
            break
        edges = small
    hung = small.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return hung.unionByName(hung.select(F.col("root").alias("node"), "root").distinct())
