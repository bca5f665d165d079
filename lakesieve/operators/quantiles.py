"""Exact quantiles with linear interpolation, at any size, by one way.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. Here
values are counted, range-partitioned and written once; the rank of a value is
then its partition's offset plus its rank inside the partition, and only the
partitions that hold a wanted rank are ranked at all. No task ever holds more
than one range partition, and a value that most rows share is one counted row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import column
from ..session import materialise


def ranked_quantiles(
    df: DataFrame,
    value: Column,
    wanted: Mapping[str, float],
    groups: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """One row per group with a column per wanted quantile, by distributed ranking."""
    keys = [f"_g{i}" for i in range(len(groups))]
    named = [column(g).alias(k) for g, k in zip(groups, keys)]
    counted = (
        df.select(*named, value.cast("double").alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy(*keys, "_v")
        .agg(F.count("*").alias("_n"))
    )
    by_range = [*keys, "_v"]
    spread = (
        counted.repartitionByRange(partitions, *by_range)
        if partitions
        else counted.repartitionByRange(*by_range)
    )
    ranked = materialise(spread.withColumn("_part", F.spark_partition_id()), "quantiles")

    # Rows per (group, partition): as many per group as there are partitions.
    in_order = Window.partitionBy(*keys).orderBy("_part")
    parts = (
        ranked.groupBy(*keys, "_part")
        .agg(F.sum("_n").alias("_in_part"))
        .withColumn("_before", F.sum("_in_part").over(in_order) - F.col("_in_part"))
        .withColumn("_total", F.sum("_in_part").over(Window.partitionBy(*keys)))
    )
    ranks: dict[str, Column] = {}
    for name, probability in wanted.items():
        position = F.lit(float(probability)) * (F.col("_total") - 1)
        ranks[f"{name}_lo"] = F.floor(position)
        ranks[f"{name}_hi"] = F.ceil(position)

    def holds(rank: Column, before: Column, size: Column) -> Column:
        return (rank >= before) & (rank < before + size)

    needed = parts.where(
        reduce(
            lambda a, b: a | b,
            (holds(r, F.col("_before"), F.col("_in_part")) for r in ranks.values()),
        )
    )
    within = Window.partitionBy(*keys, "_part").orderBy("_v")
    placed = (
        ranked.join(
            needed.select(
                *[F.col(k).alias(f"{k}_p") for k in keys],
                F.col("_part").alias("_part_p"),
                "_before",
                "_total",
            ),
            reduce(
                lambda a, b: a & b,
                [F.col(k).eqNullSafe(F.col(f"{k}_p")) for k in keys]
                + [F.col("_part") == F.col("_part_p")],
            ),
        )
        .withColumn("_start", F.col("_before") + F.sum("_n").over(within) - F.col("_n"))
    )
    at_rank = [
        F.max(F.when(holds(rank, F.col("_start"), F.col("_n")), F.col("_v"))).alias(name)
        for name, rank in ranks.items()
    ]
    found = placed.groupBy(*keys).agg(F.max("_total").alias("_total"), *at_rank)
    results = []
    for name, probability in wanted.items():
        position = F.lit(float(probability)) * (F.col("_total") - 1)
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        share = position - F.floor(position)
        results.append((low + (high - low) * share).alias(name))
    return found.select(*[F.col(k).alias(g) for k, g in zip(keys, groups)], *results)


def column_quantiles(
    df: DataFrame, values: Mapping[str, Column], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """Quantiles of whole columns, all ranked together; columns without values are left out."""
    if not values:
        return {}
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), v.cast("double").alias("v")) for n, v in values.items()])
    listed = df.select(F.explode(pairs).alias("e")).select("e.*")
    wanted = {f"q{i}": float(p) for i, p in enumerate(probabilities)}
    found = ranked_quantiles(listed, F.col("v"), wanted, ["name"]).collect()
    return {row["name"]: [row[q] for q in wanted] for row in found}
