"""Shards that all hold the same mixture of sources, by stratified interleaving."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

SHARDS = 8
SEED = "0"

#: Rows that are numbered together by one task, on average.
ROWS_TOGETHER = 50_000
#: So many times that number in one bucket is no chance of the hash.
CROWDED = 4


def _fraction(hashed: Column) -> Column:
    """A hexadecimal hash as a number from 0 to less than 1."""
    return F.conv(F.substring(hashed, 1, 12), 16, 10).cast("double") / float(16**12)


def _numbered(df: DataFrame, strata: list[str], value: Column, buckets: int, tie: Column, last: list[Column]) -> DataFrame:
    """``df`` with ``rank``, from 1 within each stratum, and ``of``, the stratum's rows.

    Rows are ordered by ``value``, from 0 to less than 1, by the hexadecimal hash ``tie``,
    then by ``last``. Buckets, which cut the range of values evenly, are counted first; a
    row's rank is what the buckets before its own hold, plus its place inside its own, so a
    stratum of any size is ranked by as many tasks as it has buckets. A bucket with far more
    rows than an even share holds values that repeat: each of its values is a bucket of its
    own, cut further along the tie.
    """
    keyed = df.withColumns({"value": value, "tie": tie})
    keyed = keyed.withColumn("bucket", F.floor(F.col("value") * buckets))
    counts = keyed.groupBy(*strata, "bucket").agg(F.count("*").alias("n"))
    crowded = counts.where(F.col("n") > CROWDED * ROWS_TOGETHER).select(
        *[F.col(s).alias(f"of {s}") for s in strata], F.col("bucket").alias("of bucket"),
        F.floor(F.col("n") / ROWS_TOGETHER).alias("cuts"))
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"of {c}") for c in [*strata, "bucket"]])
    keyed = keyed.join(crowded, same, "left").drop(*[f"of {c}" for c in [*strata, "bucket"]])
    fine = F.when(F.col("cuts").isNotNull(), F.col("value")).otherwise(-1.0)
    keyed = keyed.withColumns({"fine": fine, "part": F.coalesce(F.floor(_fraction(F.col("tie")) * F.col("cuts")), F.lit(0))})

    group = ["bucket", "fine", "part"]
    counts = keyed.groupBy(*strata, *group).agg(F.count("*").alias("n"))
    inside = W.partitionBy(*strata)
    before = F.sum("n").over(inside.orderBy(*group).rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(*strata, *group, F.coalesce(before, F.lit(0)).alias("start"), F.sum("n").over(inside).alias("of"))
    place = F.row_number().over(W.partitionBy(*strata, *group).orderBy("value", "tie", *last))
    placed = keyed.withColumn("place", place)
    return placed.join(starts, [*strata, *group]).withColumn("rank", F.col("start") + F.col("place")).drop(
        *group, "value", "tie", "cuts", "start", "place"
    )


def interleave(
    df: DataFrame, doc_id: str = "doc_id", source: str = "source", shards: int = SHARDS, seed: str = SEED,
) -> DataFrame:
    """``df`` with ``shard``, from 0, and ``slot``, gapless from 0 within the shard.

    Rows of each source are shuffled by a seeded hash of their id and ranked; a row's
    fractional rank is ``(rank - 1/2) / rows of its source``. All rows are laid out by
    fractional rank and cut into ``shards`` runs whose lengths differ by one at most, so
    each holds every source in its share of the whole, to within one row, and so does
    every stretch of a shard.

    A null source is a source of its own. Rows with the same id, or a null one, are
    ordered by a hash of all their columns; rows equal in all columns are interchangeable,
    and numbered by one task. An empty table has no shards; texts are not looked at.
    Columns named ``shard`` or ``slot`` are replaced. All columns of ``df`` are moved and
    written once to the shared folder: pass keys and sizes where texts need not move.
    """
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    rows = df.select(
        row.alias("row"),
        F.col(f"`{source}`").isNull().alias("unnamed"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")))).alias("h"),
    )
    total = df.count()
    buckets = total // ROWS_TOGETHER + 1
    strata = ["unnamed", "source"]
    ranked = _numbered(rows, strata, _fraction(F.col("h")), buckets, F.md5(F.to_json("row")), [F.col("h"), F.to_json("row")])
    spot = (2 * F.col("rank") - 1) / (2 * F.col("of"))
    ranked = materialise(ranked.select("row", *strata, spot.alias("spot")), "ranked")
    ordered = _numbered(
        ranked.withColumn("all", F.lit(0)), ["all"], F.col("spot"), buckets, F.md5("source"),
        [F.col("unnamed"), F.col("source")],
    )
    exact = f"(rank - 1) * {shards} div {max(total, 1)}"
    cut = ordered.withColumn("shard", F.expr(exact).cast("int"))
    start = F.expr(f"(shard * bigint({total}) + {shards - 1}) div {shards}")
    return cut.withColumn("slot", F.col("rank") - 1 - start).select("row.*", "shard", F.col("slot").cast("bigint"))
