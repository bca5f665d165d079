"""Following links between rows, in rounds of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import column
from ..session import materialise


def follow(links: DataFrame, starts: DataFrame, of: Sequence[str], node: str, to: str, longest: int) -> DataFrame:
    """The nodes on the way from every start, with their ``position`` from 0.

    ``links`` leads from ``node`` to ``to``, at most once from a node, within the columns
    ``of``; ``starts`` holds ``of`` and ``node``, at most one for each ``of``. Links double:
    after a round they lead twice as far, and twice as many nodes of a way are known, so a
    way of a million nodes takes twenty rounds. ``longest`` bounds a way's nodes; a way that
    leads in a circle ends there, so its nodes may be repeated.
    """
    keys = [column(c) for c in of]
    found = starts.select(*keys, column(node), F.lit(0).cast("bigint").alias("position"))
    rest = links.where(column(to).isNotNull())
    rest = materialise(rest.select(*keys, column(node).alias("_from"), column(to).alias("_to")), "links")
    step = 1
    while step < longest and not rest.isEmpty():
        ends = found.withColumnRenamed(node, "_from")
        onward = ends.join(rest, [*of, "_from"]).select(*keys, F.col("_to").alias(node), (F.col("position") + step).alias("position"))
        found = materialise(found.union(onward), "followed")
        after = rest.select(*keys, F.col("_from").alias("_to"), F.col("_to").alias("_further"))
        rest = materialise(rest.join(after, [*of, "_to"]).select(*keys, "_from", F.col("_further").alias("_to")), "links")
        step *= 2
    return found


def downstream(edges: DataFrame, starts: DataFrame, of: Sequence[str], node: str, after: str) -> DataFrame:
    """The nodes that the starts lead to, with their least ``distance``; the starts themselves at 0.

    ``edges`` says that ``node`` comes after ``after``, within the columns ``of``. Every round
    joins the nodes found in the round before, and keeps those not met yet, so a node that
    many ways lead to is looked at once, and circles end. As many rounds as the longest way.
    """
    keys = [column(c) for c in of]
    found = frontier = materialise(starts.select(*keys, column(node)).distinct().withColumn("distance", F.lit(0)), "reached")
    steps = materialise(edges.select(*keys, column(after).alias("_after"), column(node)).distinct(), "edges")
    while not frontier.isEmpty():
        reached = frontier.withColumnRenamed(node, "_after").join(steps, [*of, "_after"])
        reached = reached.select(*keys, column(node), (F.col("distance") + 1).alias("distance")).distinct()
        frontier = materialise(reached.join(found, [*of, node], "left_anti"), "reached")
        found = found.union(frontier)
    return found
