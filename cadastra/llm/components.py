"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import cut


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _towards_least(neighbours: DataFrame) -> DataFrame:
    """Each node with the least of itself and its neighbours."""
    return neighbours.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (columns a, b); the root is the least node reachable.

    Large-star and small-star rounds (Kiveris et al., 2014) keep the table no larger than the
    links and need a logarithmic number of rounds; each ends in a checkpoint. Self links and
    repeated links are harmless; an empty table gives an empty result. A node with very many
    neighbours only meets a partially aggregated minimum and a join that adaptive execution splits.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = _both_ways(edges)
        large = (
            both.join(_towards_least(both), "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct()
        )
        least = _towards_least(large)
        small = (
            large.join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .union(least.select("a", F.col("least").alias("b")))
            .where("a <> b")
            .distinct()
        )
        edges = cut(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
