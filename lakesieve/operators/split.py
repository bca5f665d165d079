"""Separate the rows that break an error rule from the rest.

Every rule is judged on the original table, tolerances do not apply, and the
broken rules' names travel with the row. Row predicates are plain expressions
over the scan. A unique rule adds one aggregate (the duplicated keys, and of few
keys their first rows), and one join to its result or, of many keys, one ranking of
their rows. Rows carry their place in stored files, so that the valid and the
quarantined side come to the same decision.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import column, normalise_missing
from ..session import ROW, fresh_path, landed
from .rules import RuleSet, ValidationReport
from .uniqueness import find_copies, flag_copies
from .validate import compile_row_rules

VIOLATIONS, OK = "_violations", "_ok"

#: A control character no rule name holds.
SEPARATOR = "\x01"


@dataclass
class Split:
    """The two sides of a table; ``quarantined`` rows name the rules they break."""

    rows: DataFrame
    columns: Sequence[str]
    #: True where a rule is broken, and the names of the broken ones.
    broken: Column
    names: Column
    duplicates: dict[tuple[str, ...], DataFrame]

    @property
    def valid(self) -> DataFrame:
        return self.rows.where(~self.broken).select(*map(column, self.columns))

    @property
    def quarantined(self) -> DataFrame:
        return self._named(self.rows.where(self.broken))

    @property
    def annotated(self) -> DataFrame:
        """All rows, each with the rules it breaks."""
        return self._named(self.rows)

    def settled(self) -> Split:
        """The same split, its rows written once if telling copies apart takes a join.

        Both sides are then read from what was written, so the join runs once.
        """
        if not self.duplicates:
            return self
        spark, path = self.rows.sparkSession, fresh_path(self.rows.sparkSession, "split")
        rows = self.rows.select(*map(column, self.columns), self.names.alias(VIOLATIONS), (~self.broken).alias(OK))
        rows.write.partitionBy(OK).parquet(path)
        stored = spark.read.schema(rows.schema).parquet(path)
        return Split(stored, self.columns, ~F.col(OK), F.col(VIOLATIONS), self.duplicates)

    def _named(self, rows: DataFrame) -> DataFrame:
        return rows.select(*map(column, self.columns), self.names.alias(VIOLATIONS))


def find_duplicates(
    df: DataFrame,
    rules: RuleSet,
    order_by: Sequence[str] = (),
    plain: DataFrame | None = None,
) -> dict[tuple[str, ...], DataFrame]:
    """The duplicated keys of every unique rule, written once; of few keys, their first rows too.

    ``plain`` is the same table without ``_row``, if there is a cheaper scan of it.
    """
    keys = {tuple(c.unique_on) for _, c in compile_row_rules(df, rules).values() if c.unique_on}
    return {k: find_copies(df, k, order_by, plain) for k in sorted(keys)}


def split(
    df: DataFrame,
    rules: RuleSet,
    order_by: Sequence[str] = (),
    report: ValidationReport | None = None,
    duplicates: Mapping[tuple[str, ...], DataFrame] | None = None,
) -> Split:
    """Annotate the rows of ``df`` with the error rules they break.

    Which copy of a key is the first follows ``order_by``, then the rows' file
    position. Rows that do not carry ``_row`` yet are written once to get one
    if a unique rule needs it. Rules the ``report`` found impossible to
    evaluate mark no rows.
    """
    df = normalise_missing(df)
    compiled = compile_row_rules(df, rules)
    if report is not None:
        compiled = {i: c for i, c in compiled.items() if not report.results[i].broken}
    keyed, plain = ROW in df.columns, None
    if not keyed and any(check.unique_on for _, check in compiled.values()):
        df, plain = landed(df, "rows")
        compiled = {i: c for i, c in compile_row_rules(df, rules).items() if i in compiled}
    found = dict(duplicates or {})
    columns = [c for c in df.columns if keyed or c != ROW]

    flags: dict[tuple[str, ...], str] = {}
    flagged = df
    for _, check in compiled.values():
        keys = tuple(check.unique_on)
        if keys and keys not in flags:
            if keys not in found:
                found[keys] = find_copies(df, keys, order_by, plain)
            flags[keys] = f"_later_{len(flags)}"
            flagged = flag_copies(flagged, found[keys], keys, order_by, flags[keys])

    marks: list[tuple[str, Column]] = []
    for rule, check in compiled.values():
        broken = F.lit(False) if check.violation is None else check.violation
        if check.unique_on:
            broken = broken | F.col(flags[tuple(check.unique_on)])
        marks.append((rule.name, broken))
    any_broken = reduce(or_, (broken for _, broken in marks), F.lit(False))
    return Split(flagged, columns, any_broken, _names(marks, any_broken), found)


def _names(marks: Sequence[tuple[str, Column]], any_broken: Column) -> Column:
    """The broken rules' names as an array.

    Joining the names and cutting them again stays inside generated code, which
    removing nulls from an array does not.
    """
    nothing = F.array().cast("array<string>")
    if not marks:
        return nothing
    joined = F.concat_ws(SEPARATOR, *[F.when(broken, F.lit(name)) for name, broken in marks])
    return F.when(any_broken, F.split(joined, SEPARATOR)).otherwise(nothing)


def violations_by_rule(annotated: DataFrame) -> DataFrame:
    """How many rows break each rule."""
    broken = annotated.select(F.explode(VIOLATIONS).alias("expectation_name"))
    return broken.groupBy("expectation_name").agg(F.count("*").alias("violations"))
