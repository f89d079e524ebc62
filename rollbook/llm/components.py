"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.sources.scratch import stored


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours; a minimum, so it is folded before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    joined = edges.join(_least(edges), "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        joined.select("u", F.col("m").alias("v"))
    )


def _digest(edges: DataFrame):
    return edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the least node reachable.

    Nodes are integers; loops, repeated and reversed links do no harm; no links give no rows.
    Rounds grow with the logarithm of the longest path; each is stored in the shared folder and
    only a count and a checksum come to the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.where("u > v").distinct(), "edges")
    seen = _digest(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)).where("u > v").distinct(), "edges")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
