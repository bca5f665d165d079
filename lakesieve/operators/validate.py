"""Evaluate a rule set in as few passes as it allows.

One aggregate answers every count of every rule. On top of it come one grouped
count per distinct unique key, one aggregate for quartiles and one for outlier
counts if there are such rules, and a top-20 query per column that turned out
to hold unexpected values. Only these few numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import normalise_missing
from . import expectations as built_in
from .expectations import SAMPLE_VALUES, Check, InvalidExpectation
from .quantiles import column_quantiles
from .rules import Expectation, ExpectationResult, RuleSet, ValidationReport
from .uniqueness import COPIES, duplicate_row_count

#: Evaluates a rule by itself: ``(df, rule) -> ExpectationResult``.
ResultFunction = Callable[[DataFrame, Expectation], ExpectationResult]
#: Describes a bad row: ``(df, rule) -> Column``, true where the rule is broken.
RowFunction = Callable[[DataFrame, Expectation], Column]

_result_functions: dict[str, ResultFunction] = {}
_compilers: dict[str, Callable[[DataFrame, Expectation], Check]] = dict(built_in.BUILT_IN)


def register_expectation(type_name: str, function: ResultFunction) -> None:
    """Add or replace a rule type evaluated by a function of the whole DataFrame."""
    _compilers.pop(type_name, None)
    _result_functions[type_name] = function


def register_row_rule(type_name: str, violation: RowFunction) -> None:
    """Add or replace a row-level rule type; it joins the shared pass and the split."""

    def compile_rule(df: DataFrame, rule: Expectation) -> Check:
        broken = F.coalesce(violation(df, rule), F.lit(False))
        limit = float(rule.param("max_violation_rate", 0.0))

        def judge(facts: Mapping[str, Any]):
            share = built_in.rate(facts["violations"], facts["rows"])
            observed = {"violation_rate": round(share, 4), "violations": facts["violations"]}
            return share <= limit, observed, built_in.message("custom", share <= limit)

        return Check(judge=judge, metrics={"violations": F.count_if(broken)}, violation=broken)

    _result_functions.pop(type_name, None)
    _compilers[type_name] = compile_rule


def unregister_expectation(type_name: str) -> None:
    """Take back a registration; a built-in of that name is in force again."""
    _result_functions.pop(type_name, None)
    _compilers.pop(type_name, None)
    if type_name in built_in.BUILT_IN:
        _compilers[type_name] = built_in.BUILT_IN[type_name]


def compile_row_rules(df: DataFrame, rules: RuleSet) -> dict[int, tuple[Expectation, Check]]:
    """The error rules that can mark single rows, by their place in the rule set."""
    compiled = {}
    for i, rule in enumerate(rules.expectations):
        compiler = _compilers.get(rule.type)
        if rule.severity != "error" or compiler is None:
            continue
        try:
            check = compiler(df, rule)
        except Exception:
            continue  # a rule that cannot be applied marks no rows
        if check.violation is not None or check.unique_on:
            compiled[i] = (rule, check)
    return compiled


def validate(
    df: DataFrame,
    rules: RuleSet,
    dataset: str | None = None,
    duplicates: Callable[[], Mapping[tuple[str, ...], DataFrame]] | None = None,
) -> ValidationReport:
    """Check ``df`` against ``rules``.

    ``duplicates`` may give duplicated keys the caller looks for anyway, by key
    columns, with their row counts in ``_copies``; it is called when these are needed.
    """
    df = normalise_missing(df)
    results: dict[int, ExpectationResult] = {}
    checks: dict[int, Check] = {}
    for i, rule in enumerate(rules.expectations):
        try:
            if rule.type in _result_functions:
                results[i] = _result_functions[rule.type](df, rule)
            elif rule.type in _compilers:
                checks[i] = _compilers[rule.type](df, rule)
            else:
                results[i] = _failed(rule, built_in.UNKNOWN_TYPE.format(rule.type))
        except InvalidExpectation as exc:
            results[i] = _failed(rule, str(exc), exc.observed)
        except Exception as exc:
            results[i] = _failed(rule, built_in.RAISED.format(exc))

    facts, errors, rows = _collect_counts(df, checks)
    for i, error in errors.items():
        rule = rules.expectations[i]
        is_custom = _compilers.get(rule.type) is built_in.custom
        text = built_in.CUSTOM_ERROR if is_custom else built_in.RAISED.format(error)
        results[i] = _failed(rule, text, {"error": error} if is_custom else {})
        del checks[i]

    steps = (
        lambda some: _add_outliers(df, some, facts),
        lambda some: _add_samples(df, some, facts),
        lambda some: _add_duplicates(df, some, facts, duplicates or dict),
    )
    # The steps wait for nothing from each other, and each adds facts of its own.
    with ThreadPoolExecutor(len(steps)) as side_by_side:
        failing = list(side_by_side.map(lambda step: _failing(step, checks), steps))
    for i, error in {i: error for found in failing for i, error in found.items()}.items():
        results[i] = _failed(rules.expectations[i], built_in.RAISED.format(error))
        del checks[i]

    for i, check in checks.items():
        rule = rules.expectations[i]
        try:
            success, observed, text = check.judge(facts[i])
        except Exception as exc:
            results[i] = _failed(rule, built_in.RAISED.format(exc))
            continue
        results[i] = ExpectationResult(
            rule.name, rule.type, success, rule.severity, list(rule.columns), observed, text
        )
    return ValidationReport(
        dataset=dataset or rules.dataset or rules.name,
        rule_set=rules.name,
        row_count=rows,
        results=[results[i] for i in sorted(results)],
    )


def _failing(step: Callable[[Mapping[int, Check]], None], checks: Mapping[int, Check]) -> dict[int, str]:
    """Run a step for all rules at once; if it fails, for each alone, and say which ones fail."""
    try:
        step(checks)
        return {}
    except Exception:
        errors = {}
        for i, check in checks.items():
            try:
                step({i: check})
            except Exception as exc:
                errors[i] = str(exc)
        return errors


def _failed(rule: Expectation, text: str, observed: dict | None = None) -> ExpectationResult:
    return ExpectationResult(
        rule.name, rule.type, False, rule.severity, list(rule.columns), observed or {}, text,
        broken=True,
    )


def _collect_counts(df: DataFrame, checks: Mapping[int, Check]):
    """Run the shared aggregate; if it fails, find the rules that make it fail."""
    named = {
        (i, name): metric.alias(f"m{i}_{j}")
        for i, check in checks.items()
        for j, (name, metric) in enumerate(check.metrics.items())
    }
    total = F.count(F.lit(1)).alias("rows")
    try:
        row = df.agg(total, *named.values()).first()
    except PySparkException:
        return _collect_separately(df, checks)
    facts: dict[int, dict[str, Any]] = {i: {"rows": row["rows"]} for i in checks}
    values = iter(row[1:])
    for i, name in named:
        facts[i][name] = next(values)
    return facts, {}, row["rows"]


def _collect_separately(df: DataFrame, checks: Mapping[int, Check]):
    rows = df.count()
    facts: dict[int, dict[str, Any]] = {}
    errors: dict[int, str] = {}
    for i, check in checks.items():
        facts[i] = {"rows": rows}
        if not check.metrics:
            continue
        try:
            row = df.agg(*[m.alias(f"m{j}") for j, m in enumerate(check.metrics.values())]).first()
            facts[i].update(zip(check.metrics, row))
        except PySparkException as exc:
            errors[i] = str(exc)
    return facts, errors, rows


def _add_duplicates(df, checks: Mapping[int, Check], facts, found) -> None:
    known = found() if any(check.unique_on for check in checks.values()) else {}
    counted: dict[tuple[str, ...], int] = {}
    for i, check in checks.items():
        keys = tuple(check.unique_on)
        if not keys:
            continue
        if keys not in counted:
            if keys in known:
                total = known[keys].agg(F.coalesce(F.sum(COPIES), F.lit(0).cast("bigint")))
            else:
                total = duplicate_row_count(df, keys)
            counted[keys] = total.first()[0]
        facts[i]["duplicate_rows"] = counted[keys]


def _add_outliers(df, checks: Mapping[int, Check], facts) -> None:
    tests = {(i, c): t for i, check in checks.items() for c, t in check.outliers.items()}
    tests = {(i, c): t for (i, c), t in tests.items() if facts[i][f"{c} count"]}
    by_quartile = {f"{i} {c}": t.value for (i, c), t in tests.items() if t.method == "iqr"}
    quartiles = column_quantiles(df, by_quartile, [0.25, 0.75])
    counts: dict[tuple[int, str], Column] = {}
    for (i, c), test in tests.items():
        if test.method == "iqr":
            q1, q3 = quartiles[f"{i} {c}"]
            reach = test.factor * (q3 - q1)
            far = (test.value < F.lit(q1 - reach)) | (test.value > F.lit(q3 + reach))
        else:
            mean, spread = facts[i][f"{c} mean"], facts[i][f"{c} spread"]
            if not spread:
                facts[i][f"{c} outliers"] = 0
                continue
            far = F.abs(test.value - F.lit(mean)) / F.lit(spread) > F.lit(test.factor)
        counts[i, c] = F.count_if(far)
    if counts:
        row = df.agg(*[n.alias(f"o{k}") for k, n in enumerate(counts.values())]).first()
        for (i, c), number in zip(counts, row):
            facts[i][f"{c} outliers"] = number


def unexpected_values(df: DataFrame, text: Column, name: str = "value") -> DataFrame:
    """The first unexpected values in text order, each once."""
    values = df.select(text.alias(name)).where(F.col(name).isNotNull()).distinct()
    return values.orderBy(name).limit(SAMPLE_VALUES)


def _add_samples(df, checks: Mapping[int, Check], facts) -> None:
    for i, check in checks.items():
        for c, text in check.samples.items():
            if facts[i][c]:
                found = unexpected_values(df, text).collect()
                facts[i][f"{c} sample"] = [r["value"] for r in found]


def score_rows(results: DataFrame, by: Sequence[str] = ("dataset", "rule_set")) -> DataFrame:
    """Score per data set from a table of rule results."""
    passed = F.count_if("success")
    total = F.count(F.lit(1))
    return results.groupBy(*by).agg(
        total.alias("total"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.count_if(~F.col("success") & (F.col("severity") == "error")).alias("error_failures"),
        F.count_if(~F.col("success") & (F.col("severity") == "warning")).alias("warning_failures"),
        F.bround(passed / total, 4).alias("score"),
    )
