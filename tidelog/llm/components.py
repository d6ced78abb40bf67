"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored


def components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """Rows (node, root) for every node with an edge; the root is the smallest node reachable.

    Alternates the large-star and the small-star step until nothing changes.  Each round is
    one stored table; minima are pre-aggregated, and the join back to them can be split where
    one node has very many neighbours.
    """
    a, b = F.col(first), F.col(second)
    links = stored(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .distinct(), "links")
    before = None
    while (now := _mark(links)) != before:
        before = now
        links = stored(_small_star(_large_star(links)).distinct(), "links")
    return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    rest = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v")))
