"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcraft.sources.staging import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, F.col("u") == F.col("w"))
            .where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    moved = (down.join(least, F.col("u") == F.col("w")).where("v <> m")
             .select(F.col("v").alias("a"), F.col("m").alias("b")))
    return moved.union(least.select(F.col("w").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of `links` (a, b): the root is the component's smallest node.

    Stars are moved towards smaller nodes until nothing changes, a number of rounds that grows
    with the logarithm of the longest path. Every round is written to the shared folder. A link
    of a node to itself names a component of one node and is left out, like null ends. Repeated
    links count once; an empty table gives an empty table.
    """
    links = cut_lineage(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        links = cut_lineage(_small_star(_large_star(links)), "links")
        now = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"),
                        F.expr("sum(cast(xxhash64(b, a) as decimal(38,0)))")).first()
        if now == before:
            roots = links.select("b").distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                roots.select("b", "b"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
