"""Connected components of a large graph, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _spread_out(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least node the node knows."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a != b").distinct()


def _gather_in(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """For links ``(a, b)`` between integers, ``(node, root)`` of every linked node.

    ``root`` is the least node reachable. Each round writes the contracted edges to
    the shared folder, so the lineage stays short and lost executors cost one round.
    A node with very many neighbours is never gathered: its least neighbour is an
    aggregate, and the join that follows can be split where it is skewed.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialise(edges.where("a != b").distinct(), "links")
    state = None
    while True:
        edges = materialise(_gather_in(_spread_out(edges)), "links")
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == state:
            break
        state = seen
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
