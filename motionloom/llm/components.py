"""Connected components of a graph of long ids, as alternating star operations on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour (or itself)."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge in ``edges`` (u, v): the smallest node of its component.

    Edges may repeat and run either way; loops are ignored.  Minima are combined before each shuffle, and the join of
    a node with many neighbours is one that adaptive execution may split, so stars of any size are fine.
    """
    edges = stored(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    seen = _fingerprint(edges)
    while seen[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    # All edges now lead from a node to the smallest of its component, which has none itself.
    pairs = edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("label"))
    return pairs.unionByName(pairs.select(F.col("label").alias("node"), "label").distinct())
