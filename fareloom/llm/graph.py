"""Connected components of a link table, by shuffles alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import join_counted, stored


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root): root is the smallest node that can be reached. Only nodes with links appear.

    Large-star and small-star steps alternate until nothing changes; each halves the distance to the root or better,
    so the number of rounds grows with the logarithm of the longest chain. A step needs the smallest neighbour of each
    node, an aggregation that combines inside the map tasks, and a join on the node, whose hot keys are broadcast.
    Every round is written to the shared folder.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour.
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
        linked = join_counted(both, least, "u", "n", "inner").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(linked.filter("u <> v").distinct(), "large-star")
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        moved = join_counted(edges, least, "u", "n", "inner").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        edges = stored(moved.union(own).filter("u <> v").distinct(), "small-star")
        now = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hash"),
        ).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
