"""Connected components by alternating large-star and small-star rounds.

Every round is joins and minimum aggregates over an edge table; the
table is written to the shared scratch folder after each round, so no
lineage grows and nothing is gathered on the driver but a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                 .first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node.

    Self links and repeated links change nothing; an empty edge table
    gives an empty result.  Nodes without a link are not listed.
    """
    canonical = (edges.filter("a <> b")
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct())
    current = materialise(canonical, "edges")
    seen = _checksum(current)
    while seen[0]:
        current = materialise(_small_star(_large_star(current)), "edges")
        now = _checksum(current)
        if now == seen:
            break
        seen = now
    return (current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")))
            .distinct())
