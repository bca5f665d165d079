"""Transform steps: an ordered list of named ``DataFrame -> DataFrame`` functions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    as_double,
    as_flag,
    as_timestamp,
    as_whole,
    column,
    column_type,
    without_nan,
)
from ..functions.naming import snake_case
from ..session import ROW
from . import uniqueness
from .aggregate import aggregate as group_and_aggregate

Step = Callable[[DataFrame, Mapping[str, Any]], DataFrame]

#: Cast targets: names as used in configuration, and what they do to a column.
CASTS: dict[str, Callable[[Column, T.DataType], Column]] = {
    "int": as_whole,
    "integer": as_whole,
    "float": as_double,
    "double": as_double,
    "str": lambda v, t: v.cast("string"),
    "string": lambda v, t: v.cast("string"),
    "bool": as_flag,
    "boolean": as_flag,
    "datetime": as_timestamp,
    "date": as_timestamp,
}


def renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns at once; a change of metadata only."""
    clashes = sorted({n for n in names if list(names).count(n) > 1})
    if clashes:
        raise ValueError(f"Several columns would be called {clashes}")
    return df.toDF(*names)


def rename(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    mapping = params.get("columns", {})
    return renamed(df, [mapping.get(c, c) for c in df.columns])


def rename_lower(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    return renamed(df, [c if c == ROW else snake_case(c) for c in df.columns])


def cast(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """Tolerant casts; unreadable values become null. Other types go to Spark as named."""
    converted = {}
    for name, target in params.get("columns", {}).items():
        if name in df.columns:
            convert = CASTS.get(str(target).lower(), lambda v, t, to=target: v.try_cast(to))
            converted[name] = convert(column(name), column_type(df, name))
    return df.withColumns(converted) if converted else df


def derive(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    return df.withColumn(params["column"], F.expr(params["expression"]))


def drop_columns(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    return df.drop(*params.get("columns", []))


def drop_duplicates(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    keep = params.get("keep", "first")
    return uniqueness.drop_duplicates(df, params.get("subset"), keep, params.get("order_by", ()))


def _filled(value: Column, dtype: T.DataType, filler: Any) -> Column:
    whole = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if whole and isinstance(filler, float) and not filler.is_integer():
        return F.coalesce(value.cast("double"), F.lit(filler))
    return F.coalesce(without_nan(value, dtype), F.lit(filler).cast(dtype))


def fillna(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    """``values`` fills the named columns, ``value`` every column of its type family."""
    if "values" in params:
        fillers = {c: v for c, v in params["values"].items() if c in df.columns}
        filled = {c: _filled(column(c), column_type(df, c), v) for c, v in fillers.items()}
        return df.withColumns(filled) if filled else df
    if params.get("value") is None:
        raise ValueError("fillna needs 'values' or 'value'")
    return df.na.fill(params["value"])


def filter_rows(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    return df.where(F.expr(params["expression"]))


def add_constant(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    return df.withColumn(params["column"], F.lit(params["value"]))


def aggregate(df: DataFrame, params: Mapping[str, Any]) -> DataFrame:
    order_by = params.get("order_by", ())
    return group_and_aggregate(df, params["group_by"], params["aggregations"], order_by)


STEPS: dict[str, Step] = {
    "rename": rename,
    "rename_lower": rename_lower,
    "cast": cast,
    "derive": derive,
    "drop_columns": drop_columns,
    "drop_duplicates": drop_duplicates,
    "fillna": fillna,
    "filter": filter_rows,
    "add_constant": add_constant,
    "aggregate": aggregate,
}


def register_transform(name: str, step: Step) -> None:
    """Add or replace a transform step."""
    STEPS[name] = step


def apply_steps(df: DataFrame, steps: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Apply ``{"type": ..., "params": {...}}`` steps in order.

    A ``_row`` column, where the rows carry one, gives ``drop_duplicates`` and
    ``first``/``last`` their order and is passed through by every other step.
    """
    unknown = [s["type"] for s in steps if s["type"] not in STEPS]
    if unknown:
        raise ValueError(f"Unknown transform type: {unknown[0]}")
    return reduce(lambda d, s: STEPS[s["type"]](d, s.get("params") or {}), steps, df)
