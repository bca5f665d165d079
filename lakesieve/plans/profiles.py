"""Profiles of columns as mergeable sketches: quantiles and distinct counts of many runs.

The exact ways of this library read the data again for every question. A profile is made
in the one pass over a run's rows and kept in the history; later questions, over any set of
runs, are answered by merging a few kilobytes for each run and column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import column, is_missing

#: Size of a quantile sketch. A quantile's share of the rows is off by ``RANK_ERROR`` at most,
#: in 99 of 100 sketches, merged or not.
QUANTILE_SIZE = 200
RANK_ERROR = 0.0133
#: Registers of a distinct-count sketch, as a power of two; its relative standard error.
DISTINCT_SIZE = 12
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_SIZE / 2)

FIELDS = ("row_count", "missing", "distinct_sketch", "quantile_sketch")


def _number(value: Column, dtype: T.DataType) -> Column:
    """What of a column has an order that quantiles can be taken in: numbers, and times as seconds."""
    if isinstance(dtype, (T.DateType, T.TimestampNTZType)):
        value = value.cast("timestamp")
    elif not isinstance(dtype, (T.NumericType, T.TimestampType)):
        return F.lit(None).cast("double")
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per column, and per group of ``by``: its rows, its missing values, its sketches.

    ``distinct_sketch`` counts values by their text. ``quantile_sketch`` holds numbers, and
    times as seconds since 1970; it is null for columns of other types and for groups without
    a value. Missing are nulls and NaN. All columns are sketched by one aggregate, which
    combines before the shuffle, so a hot group costs a sketch for each task. An empty table
    without ``by`` gives one row per column, with ``by`` none.
    """
    for name in columns:
        if name not in df.columns:
            raise KeyError(f"No column {name!r} to profile")
    aggregates = []
    for i, name in enumerate(columns):
        value, dtype = column(name), df.schema[name].dataType
        absent = is_missing(value, dtype)
        # a type without a text form of its own is counted by its JSON
        text = value.cast("string") if not isinstance(dtype, (T.MapType, T.ArrayType, T.StructType)) else F.to_json(F.struct(value))
        aggregates += [
            F.count_if(absent).alias(f"_missing{i}"),
            F.hll_sketch_agg(F.when(~absent, text), DISTINCT_SIZE).alias(f"_distinct{i}"),
            F.kll_sketch_agg_double(_number(value, dtype), QUANTILE_SIZE).alias(f"_quantile{i}"),
        ]
    keys = [column(k).alias(f"_by{i}") for i, k in enumerate(by)]
    wide = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *aggregates)
    entries = [
        F.struct(
            F.lit(name).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"_missing{i}").alias("missing"),
            F.col(f"_distinct{i}").alias("distinct_sketch"), _held(F.col(f"_quantile{i}")).alias("quantile_sketch"),
        )
        for i, name in enumerate(columns)
    ]
    return wide.select(*[F.col(f"_by{i}").alias(k) for i, k in enumerate(by)], F.inline(F.array(*entries)))


def _held(sketch: Column) -> Column:
    """A quantile sketch, or null if it holds nothing and so has no quantiles."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, sketch)


def merged(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of several runs or groups as one, per column and group of ``by``."""
    return profiles.groupBy(*[column(k) for k in by], "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("missing").alias("missing"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("_merged"),
    ).withColumn("quantile_sketch", _held(F.col("_merged"))).drop("_merged")


def estimates(profiles: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The numbers that profiles hold, in place of the sketches.

    Adds ``distinct_values``, ``quantiles`` in the order of ``probabilities``, and the exact
    ``least`` and ``most``; quantiles and ends are null where there is no number.
    """
    sketch = F.col("quantile_sketch")

    def at(probability: float) -> Column:
        return F.when(sketch.isNotNull(), F.kll_sketch_get_quantile_double(sketch, F.lit(float(probability))))

    found = F.when(sketch.isNotNull(), F.array(*map(at, probabilities)))
    return profiles.select(
        *[column(c) for c in profiles.columns if c not in ("distinct_sketch", "quantile_sketch")],
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        found.alias("quantiles"), at(0).alias("least"), at(1).alias("most"),
    )


def drift(now: DataFrame, before: DataFrame, steps: int = 100) -> DataFrame:
    """How far the distribution of each column has moved between two sets of profiles.

    ``drift`` is the largest difference, over the ``steps`` even quantiles of ``before``,
    between the shares of values up to that quantile: 0 for equal distributions, 1 for ones
    that do not meet. Columns that have no numbers on either side are left out. Both sides may
    hold many runs; they are merged here. The error is at most that of both sketches and a step.
    """
    grid = F.array(*[F.lit(i / steps) for i in range(1, steps)])

    def spread(profiles: DataFrame, name: str) -> DataFrame:
        known = merged(profiles).where("quantile_sketch is not null")
        return known.select("column_name", F.kll_sketch_get_quantile_double("quantile_sketch", grid).alias(name))

    both = spread(now, "_now").join(spread(before, "_old"), "column_name")

    def share(values: Column, at: Column) -> Column:
        return F.size(F.filter(values, lambda v: v <= at)) / steps

    gaps = F.transform(F.col("_old"), lambda at: F.abs(share(F.col("_now"), at) - share(F.col("_old"), at)))
    return both.select("column_name", F.array_max(gaps).alias("drift"))
