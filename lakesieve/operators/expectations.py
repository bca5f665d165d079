"""The built-in expectations, each compiled to Columns.

A compiled check contributes counts to the one aggregate that serves a whole
rule set, and, for row-level rules, the predicate that marks a row as bad. What
a plain count cannot answer (duplicates, outliers, samples of unexpected
values) it declares, and the runner in :mod:`.validate` provides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (
    as_double,
    as_number,
    column,
    column_type,
    epoch_micros,
    is_in,
    is_missing,
)
from .rules import Expectation

# Type names a schema rule may use, by family.
TYPE_FAMILIES = {
    "int": "whole", "integer": "whole", "int64": "whole",
    "float": "floating", "double": "floating", "float64": "floating",
    "str": "text", "string": "text", "object": "text",
    "bool": "flag", "boolean": "flag",
    "datetime": "time", "date": "time", "datetime64[ns]": "time",
}

FAMILY_TYPES = {
    "whole": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "floating": (T.FloatType, T.DoubleType),
    "text": (T.StringType, T.CharType, T.VarcharType),
    "flag": (T.BooleanType,),
    "time": (T.TimestampType, T.TimestampNTZType),
}

# Result messages, (when it holds, when it fails).
MESSAGES = {
    "schema": ("Schema valid", "Schema validation failed"),
    "not_null": ("Completeness within threshold", "Null rate threshold exceeded"),
    "unique": ("Values unique", "Found {n} duplicate rows"),
    "range": ("Values within range", "Range violations exceeded threshold"),
    "allowed_values": ("Categorical values valid", "Unexpected categorical values found"),
    "outliers": ("Outliers within threshold", "Outlier rate exceeded threshold"),
    "freshness": ("Data is fresh", "Data is stale"),
    "custom": ("Business rule satisfied", "Business rule violated"),
}

# Messages of rules that could not be evaluated.
UNKNOWN_TYPE = "Unknown expectation type '{}'"
RAISED = "Expectation raised an error: {}"
CUSTOM_ERROR = "Custom expression error"

#: How many unexpected values a categorical rule reports.
SAMPLE_VALUES = 20

Judgement = tuple[bool, dict[str, Any], str]


class InvalidExpectation(ValueError):
    """The rule cannot be applied to this table; it fails with these details."""

    def __init__(self, message: str, observed: dict[str, Any] | None = None):
        super().__init__(message)
        self.observed = observed or {}


@dataclass
class Outliers:
    """A column to test for outliers; ``method`` decides which bounds apply."""

    value: Column
    method: str
    factor: float


@dataclass
class Check:
    #: Judges the collected facts.
    judge: Callable[[Mapping[str, Any]], Judgement]
    #: Counts for the shared aggregate.
    metrics: dict[str, Column] = field(default_factory=dict)
    #: True for a row that breaks the rule; duplicates come on top, from ``unique_on``.
    violation: Column | None = None
    unique_on: Sequence[str] = ()
    outliers: dict[str, Outliers] = field(default_factory=dict)
    #: Per column, the text of values to sample when the column has violations.
    samples: dict[str, Column] = field(default_factory=dict)


def any_of(conditions: Sequence[Column]) -> Column | None:
    return reduce(or_, conditions) if conditions else None


def rate(part: int, whole: int) -> float:
    return part / whole if whole else 0.0


def message(kind: str, success: bool, **values: Any) -> str:
    return MESSAGES[kind][0 if success else 1].format(**values)


def present_columns(df: DataFrame, rule: Expectation) -> list[str]:
    return [c for c in rule.columns if c in df.columns]


def missing_columns(df: DataFrame, rule: Expectation) -> list[str]:
    return [c for c in rule.columns if c not in df.columns]


def has_type(dtype: T.DataType, expected: str) -> bool:
    family = TYPE_FAMILIES.get(expected.lower())
    if family:
        return isinstance(dtype, FAMILY_TYPES[family])
    return dtype.simpleString() == expected.lower()


def schema(df: DataFrame, rule: Expectation) -> Check:
    """Columns exist and have a type of the expected family; reads no data."""
    types: Mapping[str, str] = rule.param("columns", {})
    required = list(types) or list(rule.columns)
    observed = {
        "missing": [c for c in required if c not in df.columns],
        "type_mismatches": {
            c: f"expected {t}, got {column_type(df, c).simpleString()}"
            for c, t in types.items()
            if c in df.columns and not has_type(column_type(df, c), t)
        },
        "unexpected": []
        if rule.param("allow_extra", True)
        else [c for c in df.columns if c not in required],
    }
    success = not any(observed.values())
    return Check(judge=lambda _: (success, observed, message("schema", success)))


def not_null(df: DataFrame, rule: Expectation) -> Check:
    """Share of missing values per column, over all rows."""
    limit = float(rule.param("max_null_rate", 0.0))
    present = present_columns(df, rule)
    missing = {c: is_missing(column(c), column_type(df, c)) for c in present}

    def judge(facts: Mapping[str, Any]) -> Judgement:
        rates = {c: rate(facts[c], facts["rows"]) for c in present}
        broken = {c: round(r, 4) for c, r in rates.items() if r > limit}
        broken |= {c: 1.0 for c in missing_columns(df, rule)}
        observed = {
            "null_rates": {c: round(r, 4) for c, r in rates.items()},
            "threshold": limit,
            "violations": broken,
        }
        return not broken, observed, message("not_null", not broken)

    return Check(
        judge=judge,
        metrics={c: F.count_if(m) for c, m in missing.items()},
        violation=any_of(list(missing.values())),
    )


def unique(df: DataFrame, rule: Expectation) -> Check:
    """No two rows share the key; as a primary key, no key part is missing either."""
    if not rule.columns:
        raise InvalidExpectation("No columns provided for uniqueness rule")
    present = present_columns(df, rule)
    absent = missing_columns(df, rule)
    primary = bool(rule.param("primary_key"))
    null_key = any_of([is_missing(column(c), column_type(df, c)) for c in present])
    # Rows are still split on the key columns that do exist.
    row_level = {"violation": null_key if primary else None, "unique_on": present}
    if absent:
        failed = (False, {"missing": absent}, "Uniqueness columns missing")
        return Check(judge=lambda _: failed, **row_level)

    def judge(facts: Mapping[str, Any]) -> Judgement:
        duplicates = facts["duplicate_rows"]
        observed = {"duplicate_rows": duplicates}
        if primary:
            observed["null_key_rows"] = facts["null_key_rows"]
        success = not any(observed.values())
        return success, observed, message("unique", success, n=duplicates)

    metrics = {"null_key_rows": F.count_if(null_key)} if primary and present else {}
    return Check(judge=judge, metrics=metrics, **row_level)


def within_range(df: DataFrame, rule: Expectation) -> Check:
    """Numbers between two inclusive bounds; what is no number breaks no bound."""
    low, high = rule.param("min"), rule.param("max")
    limit = float(rule.param("max_violation_rate", 0.0))

    def outside(name: str) -> Column:
        number = as_number(column(name), column_type(df, name))
        broken = F.lit(False)
        if low is not None:
            broken = broken | (number < F.lit(low))
        if high is not None:
            broken = broken | (number > F.lit(high))
        return F.coalesce(broken, F.lit(False))

    present = present_columns(df, rule)
    broken = {c: outside(c) for c in present}

    def judge(facts: Mapping[str, Any]) -> Judgement:
        observed: dict[str, Any] = {c: "missing" for c in missing_columns(df, rule)}
        success = not observed
        for c in present:
            share = rate(facts[c], facts["rows"])
            observed[c] = {"violation_rate": round(share, 4), "violations": facts[c]}
            success = success and share <= limit
        return success, observed, message("range", success)

    return Check(
        judge=judge,
        metrics={c: F.count_if(b) for c, b in broken.items()},
        violation=any_of(list(broken.values())),
    )


def allowed_values(df: DataFrame, rule: Expectation) -> Check:
    """Values from a fixed set; missing values are not judged."""
    allowed = list(rule.param("values", []))
    limit = float(rule.param("max_violation_rate", 0.0))
    present = present_columns(df, rule)

    def outside(name: str) -> Column:
        dtype, value = column_type(df, name), column(name)
        member = F.coalesce(is_in(value, allowed, dtype), F.lit(False))
        return ~is_missing(value, dtype) & ~member

    broken = {c: outside(c) for c in present}
    metrics = {c: F.count_if(b) for c, b in broken.items()}
    for c in present:
        metrics[f"{c} present"] = F.count_if(~is_missing(column(c), column_type(df, c)))

    def judge(facts: Mapping[str, Any]) -> Judgement:
        observed: dict[str, Any] = {c: "missing" for c in missing_columns(df, rule)}
        success = not observed
        for c in present:
            share = rate(facts[c], facts[f"{c} present"])
            observed[c] = {
                "violation_rate": round(share, 4),
                "unexpected": facts.get(f"{c} sample", []),
            }
            success = success and share <= limit
        return success, observed, message("allowed_values", success)

    return Check(
        judge=judge,
        metrics=metrics,
        violation=any_of(list(broken.values())),
        samples={c: F.when(b, column(c).cast("string")) for c, b in broken.items()},
    )


def outliers(df: DataFrame, rule: Expectation) -> Check:
    """Share of numbers far from the rest, by quartiles or by standard deviations."""
    method = "zscore" if rule.param("method", "iqr") == "zscore" else "iqr"
    factor = float(rule.param("factor", 3.0 if method == "zscore" else 1.5))
    limit = float(rule.param("max_outlier_rate", 0.05))
    present = present_columns(df, rule)
    numbers = {c: as_double(column(c), column_type(df, c)) for c in present}
    metrics = {}
    for c, number in numbers.items():
        metrics[f"{c} count"] = F.count(number)
        if method == "zscore":
            metrics[f"{c} mean"] = F.avg(number)
            metrics[f"{c} spread"] = F.stddev_pop(number)

    def judge(facts: Mapping[str, Any]) -> Judgement:
        observed: dict[str, Any] = {c: "missing" for c in missing_columns(df, rule)}
        success = not observed
        for c in present:
            total = facts[f"{c} count"]
            if not total:
                observed[c] = {"outlier_rate": 0.0}
                continue
            share = rate(facts[f"{c} outliers"], total)
            observed[c] = {"outlier_rate": round(share, 4), "outliers": facts[f"{c} outliers"]}
            success = success and share <= limit
        return success, observed, message("outliers", success)

    tests = {c: Outliers(number, method, factor) for c, number in numbers.items()}
    return Check(judge=judge, metrics=metrics, outliers=tests)


def freshness(df: DataFrame, rule: Expectation) -> Check:
    """Age of the newest timestamp of the first listed column."""
    limit = float(rule.param("max_age_hours", 24))
    name = next(iter(rule.columns), None)
    if name is None or name not in df.columns:
        raise InvalidExpectation("Freshness column missing or empty", {"column": name})
    reference = rule.param("reference", "now")
    utc = dt.timezone.utc
    given = None
    if reference != "now":
        try:
            given = dt.datetime.fromisoformat(str(reference))
        except ValueError as exc:
            raise InvalidExpectation("Freshness reference is no time", {"reference": str(reference)}) from exc
        given = given if given.tzinfo else given.replace(tzinfo=utc)

    def judge(facts: Mapping[str, Any]) -> Judgement:
        if facts["latest"] is None:
            text = "No valid timestamps" if facts["rows"] else "Freshness column missing or empty"
            return False, {"column": name}, text
        epoch = dt.datetime(1970, 1, 1, tzinfo=utc)
        latest = epoch + dt.timedelta(microseconds=facts["latest"])
        now = given or dt.datetime.now(utc)
        age = (now - latest).total_seconds() / 3600.0
        observed = {
            "latest": str(latest.replace(tzinfo=None)),
            "age_hours": round(age, 2),
            "max_age_hours": limit,
        }
        return age <= limit, observed, message("freshness", age <= limit)

    newest = F.max(epoch_micros(column(name), column_type(df, name)))
    return Check(judge=judge, metrics={"latest": newest})


def custom(df: DataFrame, rule: Expectation) -> Check:
    """A Spark SQL predicate every row must satisfy; null counts as not satisfied."""
    expression = rule.param("expression")
    limit = float(rule.param("max_violation_rate", 0.0))
    if not expression:
        raise InvalidExpectation("No expression provided for custom rule")
    try:
        # Analysis only; no job runs.
        dtype = df.select(F.expr(expression).alias("ok")).schema["ok"].dataType
    except Exception as exc:
        raise InvalidExpectation(CUSTOM_ERROR, {"error": str(exc)}) from exc
    if not isinstance(dtype, T.BooleanType):
        error = f"expression is {dtype.simpleString()}, not boolean"
        raise InvalidExpectation(CUSTOM_ERROR, {"error": error})
    broken = ~F.coalesce(F.expr(expression), F.lit(False))

    def judge(facts: Mapping[str, Any]) -> Judgement:
        share = rate(facts["violations"], facts["rows"])
        observed = {
            "expression": expression,
            "violation_rate": round(share, 4),
            "violations": facts["violations"],
        }
        return share <= limit, observed, message("custom", share <= limit)

    return Check(judge=judge, metrics={"violations": F.count_if(broken)}, violation=broken)


BUILT_IN: dict[str, Callable[[DataFrame, Expectation], Check]] = {
    "schema": schema,
    "not_null": not_null,
    "completeness": not_null,
    "unique": unique,
    "primary_key": unique,
    "range": within_range,
    "allowed_values": allowed_values,
    "categorical": allowed_values,
    "outliers": outliers,
    "freshness": freshness,
    "custom": custom,
    "business_rule": custom,
}
