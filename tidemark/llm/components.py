"""Connected components of a distributed edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each larger neighbour of a node on the smallest node around it."""
    both = edges.union(edges.select("dst", "src"))
    least = both.groupBy("src").agg(F.min("dst").alias("low")).withColumn("low", F.least("low", "src"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node, and its smaller neighbours, on the smallest of them."""
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst")
    least = down.groupBy("src").agg(F.min("dst").alias("low"))
    moved = down.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.union(least.select("src", F.col("low").alias("dst"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("src", "dst")
    return tuple(edges.agg(F.count("*"), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.bit_xor(h)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(src, dst)``; the component is its smallest node.

    Only aggregates by node meet on a key, so a node with many edges is combined before the shuffle;
    where a join meets it, AQE splits the partition. Every round is written to the shared folder.
    Nodes without an edge are not returned; an empty list gives no rows.
    """
    edges = materialize(edges.select("src", "dst").where("src <> dst").distinct(), "edges")
    before = _digest(edges)
    while before[0]:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        after = _digest(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return stars.union(edges.select("dst", "dst").distinct())
