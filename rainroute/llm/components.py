"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainroute.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for every node of a link (a, b).

    Each star step keeps the components and brings every node closer to its smallest; rounds
    grow with the logarithm of the longest path. A node with many links is an ordinary
    group: minima fold before they move. Every round is written to the shared folder.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        # A sum of 64-bit hashes as decimals: does not wrap, so two rounds alike are alike.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionAll(stars.select(F.col("label").alias("node"), "label").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
