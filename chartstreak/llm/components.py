"""Connected components of a link table, by alternating large and small stars.

Every step is a partially aggregated minimum per node, written, and a join back
on the node, so a node with very many links is pre-aggregated before its
shuffle and its join, between plain exchanges, is one that Spark can split. No
adjacency list is ever built. Each
round is written to the shared folder; rounds grow with the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartstreak.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = materialise(least, "least-neighbours").hint("merge")
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialise(down.groupBy("u").agg(F.min("v").alias("m")), "least-neighbours")
    near = down.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", "m")).where(F.col("u") != F.col("v"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest id reachable from every node that has a link to another node."""
    edges = materialise(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        large = materialise(_large_star(edges).distinct(), "large-stars")
        edges = materialise(_small_star(large).distinct(), "stars")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v")).distinct()
