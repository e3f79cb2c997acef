"""Connected components of a table of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node go to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it go to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether every lower end is a root and every upper end has one root."""
    if not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
        return False
    return edges.groupBy("u").count().where("count > 1").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node of ``links`` the smallest node that it reaches.

    Large star and small star in turn, until only stars are left: the number of rounds grows with
    the logarithm of the longest chain, not with the number of links. A node with very many links
    is one row of a grouped minimum, and joins on it are split by the engine.
    """
    big, small = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = stored(links.where(F.col(a) != F.col(b)).select(big, small).distinct(), "links")
    while not _only_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
