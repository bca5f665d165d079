"""Group-by aggregation with the usual data-frame conventions.

Missing values are skipped, rows with a missing group key are left out, the sum
of nothing is 0. A column with one function keeps its name; with a list of
functions the results are called ``column_function``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import column, column_type, normalise_missing
from ..session import ROW
from .quantiles import ranked_quantiles


def _truth(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, T.StringType):
        return F.length(value) > 0
    return value != 0


def _skew(value: Column) -> Column:
    n = F.count(value).cast("double")
    corrected = F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(F.count(value) > 2, corrected)


#: Functions of one column: ``(value, type) -> aggregate``.
FUNCTIONS: dict[str, Callable[[Column, T.DataType], Column]] = {
    "sum": lambda v, t: F.coalesce(F.sum(v), F.lit(0)),
    "mean": lambda v, t: F.avg(v),
    "min": lambda v, t: F.min(v),
    "max": lambda v, t: F.max(v),
    "count": lambda v, t: F.count(v),
    "size": lambda v, t: F.count(F.lit(1)),
    "nunique": lambda v, t: F.count_distinct(v),
    "std": lambda v, t: F.stddev_samp(v),
    "var": lambda v, t: F.var_samp(v),
    "sem": lambda v, t: F.stddev_samp(v) / F.sqrt(F.count(v)),
    "skew": lambda v, t: _skew(v),
    "prod": lambda v, t: F.coalesce(F.product(v), F.lit(1.0)),
    "any": lambda v, t: F.coalesce(F.bool_or(_truth(v, t)), F.lit(False)),
    "all": lambda v, t: F.coalesce(F.bool_and(_truth(v, t)), F.lit(True)),
}

#: Ranked apart: a group's values are never gathered in one buffer.
MEDIAN = "median"

#: Functions that depend on row order.
ORDERED = {"first": F.min_by, "last": F.max_by}


def aggregate(
    df: DataFrame,
    group_by: Sequence[str] | str,
    aggregations: Mapping[str, str | Sequence[str]],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per group. ``first``/``last`` follow ``order_by``, then file position."""
    keys = [group_by] if isinstance(group_by, str) else list(group_by)
    wanted: dict[str, tuple[str, str]] = {}
    for name, functions in aggregations.items():
        if isinstance(functions, str):
            wanted[name] = (name, functions)
        else:
            wanted.update({f"{name}_{f}": (name, f) for f in functions})
    unknown = {f for _, f in wanted.values()} - FUNCTIONS.keys() - ORDERED.keys() - {MEDIAN}
    if unknown:
        raise ValueError(f"Unknown aggregate functions: {sorted(unknown)}")
    df = normalise_missing(df).dropna(subset=keys)

    medians = {out: name for out, (name, f) in wanted.items() if f == MEDIAN}
    aggregates = []
    for out, (name, function) in wanted.items():
        if out in medians:
            continue
        value, dtype = column(name), column_type(df, name)
        if function in ORDERED:
            # Without a given order, order by content: a fixed choice, if an arbitrary one.
            rest = [ROW] if ROW in df.columns else [c for c in df.columns if c not in order_by]
            position = F.struct(*[column(c) for c in [*order_by, *rest]])
            picked = ORDERED[function](value, F.when(value.isNotNull(), position))
            aggregates.append(picked.alias(out))
        else:
            aggregates.append(FUNCTIONS[function](value, dtype).alias(out))
    grouped = df.groupBy(*[column(k) for k in keys])
    result = grouped.agg(*aggregates) if aggregates else df.select(*map(column, keys)).distinct()
    if not medians:
        return result
    for out, name in medians.items():
        found = ranked_quantiles(df, column(name), {out: 0.5}, keys)
        renamed = found.toDF(*[f"_k{i}" for i in range(len(keys))], out)
        same = reduce(and_, (column(k) == F.col(f"_k{i}") for i, k in enumerate(keys)))
        result = result.join(renamed, same, "left").drop(*renamed.columns[:-1])
    return result.select(*[column(c) for c in [*keys, *wanted]])
