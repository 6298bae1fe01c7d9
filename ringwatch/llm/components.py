"""Connected components of links between nodes, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node of ``links`` (a, b).

    Each round first ties every node's larger neighbours, then its smaller ones, to its smallest
    neighbour, until every node hangs on its root. Only minima are aggregated, neighbours are never
    listed, so a node with very many links is one row among the minima; rounds are written to the
    shared folder.
    """
    edges = cut(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
