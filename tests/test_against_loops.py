"""Validation and split on random tables, against plain loops over the rows."""

import math
import random

import pytest
from conftest import rows_of

from lakesieve import RuleSet, split, validate

RULES = RuleSet.of("random", [
    {"name": "key", "type": "primary_key", "columns": ["a", "b"], "params": {"primary_key": True}},
    {"name": "soft_key", "type": "unique", "columns": ["b"], "severity": "warning"},
    {"name": "known", "type": "not_null", "columns": ["x", "t"], "params": {"max_null_rate": 0.3}},
    {"name": "bounds", "type": "range", "columns": ["x", "t"], "params": {"min": -5, "max": 5}},
    {"name": "words", "type": "allowed_values", "columns": ["t"], "params": {"values": ["1", "2.5", "w"]}},
    {"name": "rule", "type": "custom", "params": {"expression": "x > 0 or a = 1"}},
])


def number(text):
    try:
        return None if text is None else float(text)
    except ValueError:
        return None


def missing(value):
    return value is None or (isinstance(value, float) and math.isnan(value))


def outside(value):
    return not missing(value) and (value < -5 or value > 5)


def random_rows(seed, n=120):
    rng = random.Random(seed)
    return [
        (i, rng.choice([1, 2, 3, None]), rng.choice(["p", "q", "r", None, "s"]),
         rng.choice([None, float("nan"), -7.5, -5.0, 0.0, 3.25, 5.0, 8.0]),
         rng.choice([None, "1", "2.5", "w", "100", "-9", "nope"]))
        for i in range(n)
    ]


def expected_marks(rows):
    """Per row id, the error rules it breaks."""
    seen, marks = set(), {}
    for i, a, b, x, t in rows:
        broken = []
        if (a, b) in seen or a is None or b is None:
            broken.append("key")
        seen.add((a, b))
        if missing(x) or t is None:
            broken.append("known")
        if outside(x) or outside(number(t)):
            broken.append("bounds")
        if t is not None and t not in ("1", "2.5", "w"):
            broken.append("words")
        if not ((not missing(x) and x > 0) or a == 1):
            broken.append("rule")
        marks[i] = broken
    return marks


@pytest.mark.parametrize("seed", range(4))
def test_split_and_counts(spark, seed):
    rows = random_rows(seed)
    schema = "id bigint, a bigint, b string, x double, t string"
    df = spark.createDataFrame(rows, schema)
    marks = expected_marks(rows)
    report = validate(df, RULES)
    sides = split(df, RULES, order_by=["id"], report=report)
    got = {r["id"]: r["_violations"] for r in sides.annotated.collect()}
    assert got == marks
    assert [r[0] for r in rows_of(sides.valid, "id")] == [i for i, m in marks.items() if not m]

    keys = [(a, b) for _, a, b, _, _ in rows]
    copies = sum(keys.count(k) > 1 for k in keys)
    nulls = sum(None in k for k in keys)
    assert report.result("key").observed == {"duplicate_rows": copies, "null_key_rows": nulls}
    bad = sum(outside(x) for _, _, _, x, _ in rows)
    assert report.result("bounds").observed["x"]["violations"] == bad
    words = [t for *_, t in rows if t is not None]
    wrong = [t for t in words if t not in ("1", "2.5", "w")]
    assert report.result("words").observed["t"] == {
        "violation_rate": round(len(wrong) / len(words), 4), "unexpected": sorted(set(wrong))}
    rule = report.result("rule").observed["violations"]
    assert rule == sum("rule" in m for m in marks.values())


@pytest.mark.parametrize("broadcast", [True, False])
def test_first_copies_are_found_by_either_join(spark, broadcast):
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = random_rows(99, 400)
        df = spark.createDataFrame([r[:3] for r in rows], "id bigint, a bigint, b string")
        rules = RuleSet.of("u", [{"name": "u", "type": "unique", "columns": ["a", "b"]}])
        first = {}
        for i, a, b, *_ in rows:
            first.setdefault((a, b), i)
        kept = rows_of(split(df, rules, order_by=["id"]).valid, "id")
        assert kept == sorted((i,) for i in first.values())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
