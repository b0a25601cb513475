"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(least.select("a", F.least("a", "m").alias("m")), "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point to the smallest one."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of all linked nodes.

    ``links`` has the columns ``a`` and ``b``, in any direction.  Each round is
    two groupings with map-side minima and two joins that adaptive execution can
    split, so a node with a third of all links is not one task.  Rounds are
    written to the shared folder; their number grows with the logarithm of the
    longest path.
    """
    edges = stage(links.select("a", "b").where("a <> b").distinct(), label)
    mark = None
    while True:
        edges = stage(_small_star(_large_star(edges)), label)
        seen = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
        ).first()
        if mark == tuple(seen):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = tuple(seen)
