"""Whole rule sets: scoring, isolation of broken rules, registration, and the row split."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from lakesieve import (
    ExpectationResult,
    RuleSet,
    register_expectation,
    register_row_rule,
    split,
    validate,
)
from lakesieve.operators import uniqueness
from lakesieve.operators.split import violations_by_rule
from lakesieve.operators.validate import unregister_expectation
from lakesieve.session import ROW, materialise, read_parquet

CATEGORY = {"name": "category", "type": "not_null", "columns": ["category"]}
AMOUNT = {"name": "amount", "type": "range", "columns": ["amount"], "params": {"min": 0}}


def test_score_counts_warnings_too(sample):
    rules = RuleSet.of("rs", [
        CATEGORY,
        {**AMOUNT, "severity": "warning"},
        {"name": "ok", "type": "range", "columns": ["amount"], "params": {"max": 5000}},
    ], dataset="sample")
    report = validate(sample, rules)
    assert report.summary() == {"total": 3, "passed": 1, "failed": 2, "score": 0.3333, "success": False}
    assert report.row_count == 5 and report.evaluated_at.tzinfo
    assert report.score == 0.3333
    assert not report.success
    assert [r.name for r in report.results if not r.success and r.severity == "warning"] == ["amount"]
    assert [r.success for r in report.results] == [False, False, True]
    assert validate(sample, RuleSet("empty")).score == 1.0


def test_warnings_do_not_fail_a_report(sample):
    report = validate(sample, RuleSet.of("rs", [{**AMOUNT, "severity": "warning"}]))
    assert report.success and report.score == 0.0


def test_unknown_type_and_broken_rules_leave_the_others_alone(sample):
    rules = RuleSet.of("rs", [
        {"name": "unknown", "type": "does_not_exist"},
        {"name": "raises", "type": "custom", "params": {"expression": "cast(category as int) > 0"}},
        CATEGORY,
        {"name": "ok", "type": "unique", "columns": ["id"]},
    ])
    report = validate(sample, rules)
    assert [r.success for r in report.results] == [False, False, False, True]
    assert report.result("unknown").message == "Unknown expectation type 'does_not_exist'"
    assert "error" in report.result("raises").observed
    # The rule that raises says nothing about single rows.
    assert rows_of(split(sample, rules, report=report).quarantined, "id") == [(5,)]


def test_registered_expectation_overrides_and_is_isolated(sample):
    def fail(df, rule):
        return ExpectationResult(rule.name, rule.type, False)

    def crash(df, rule):
        raise RuntimeError("boom")

    register_expectation("always_fail", fail)
    register_expectation("crash", crash)
    try:
        rules = RuleSet.of("rs", [{"name": "a", "type": "always_fail"}, {"name": "b", "type": "crash"}])
        report = validate(sample, rules)
        assert [r.success for r in report.results] == [False, False]
        assert report.result("b").message == "Expectation raised an error: boom"
        assert split(sample, rules).quarantined.count() == 0
    finally:
        unregister_expectation("always_fail")
        unregister_expectation("crash")


def test_registered_row_rule_takes_part_in_the_split(sample):
    register_row_rule("even", lambda df, rule: F.col(rule.columns[0]) % 2 == 0)
    try:
        rules = RuleSet.of("rs", [{"name": "odd", "type": "even", "columns": ["id"]}])
        assert validate(sample, rules).results[0].observed["violations"] == 2
        assert rows_of(split(sample, rules).quarantined, "id") == [(2,), (4,)]
    finally:
        unregister_expectation("even")


def test_split_names_the_broken_rules(sample):
    sides = split(sample, RuleSet.of("rs", [CATEGORY, AMOUNT]))
    assert rows_of(sides.valid, "id") == [(1,), (2,), (3,)]
    assert rows_of(sides.quarantined.select("id", F.concat_ws(",", "_violations"))) == [
        (4, "amount"), (5, "category")
    ]
    assert sides.valid.columns == sample.columns
    assert rows_of(violations_by_rule(sides.annotated)) == [("amount", 1), ("category", 1)]


def test_split_ignores_tolerances_and_warnings(sample):
    tolerant = {**AMOUNT, "params": {"min": 0, "max_violation_rate": 0.5}}
    rules = RuleSet.of("rs", [tolerant, {**CATEGORY, "severity": "warning"}])
    assert validate(sample, rules).result("amount").success
    assert rows_of(split(sample, rules).quarantined, "id") == [(4,)]


def test_split_keeps_the_first_copy_in_file_order(spark, frame, folder):
    path = folder()
    frame("k bigint, v bigint", *[(i % 3, 100 - i) for i in range(9)]).coalesce(1).write.parquet(path)
    rules = RuleSet.of("rs", [{"name": "k", "type": "unique", "columns": ["k"]}])
    assert rows_of(split(spark.read.parquet(path), rules).valid, "v") == [(98,), (99,), (100,)]
    assert rows_of(split(spark.read.parquet(path), rules, order_by=["v"]).valid, "v") == [
        (92,), (93,), (94,)
    ]


def test_split_keeps_one_of_identical_rows(frame):
    df = frame("k bigint, v string", *[(1, "a")] * 5, (None, "n"), (None, "n"), (2, "b"))
    rules = RuleSet.of("rs", [{"name": "k", "type": "unique", "columns": ["k"]}])
    sides = split(df, rules, order_by=["v"])
    assert rows_of(sides.valid) == [(None, "n"), (1, "a"), (2, "b")]
    assert sides.quarantined.count() == 5
    assert ROW not in sides.valid.columns


def test_split_looks_for_duplicates_in_the_original_rows(frame):
    # The first copy falls to another rule, and its later copy is a duplicate all the same.
    df = frame("k bigint, amount bigint", (1, -1), (1, 5))
    rules = RuleSet.of("rs", [{"name": "k", "type": "unique", "columns": ["k"]}, AMOUNT])
    assert split(df, rules, order_by=["amount"]).valid.count() == 0


def test_split_uses_the_key_columns_that_exist(frame):
    df = frame("k bigint", (1,), (1,), (2,))
    rules = RuleSet.of("rs", [{"name": "k", "type": "unique", "columns": ["k", "absent"]}])
    assert split(df, rules).valid.count() == 2


def test_primary_key_quarantines_missing_keys(duplicated):
    rules = RuleSet.of("rs", [{"name": "id", "type": "primary_key", "columns": ["id"],
                               "params": {"primary_key": True}}])
    assert rows_of(split(duplicated, rules).valid, "id") == [(1,), (2,), (3,)]


def test_rules_of_the_same_name_are_judged_separately(sample):
    rules = RuleSet.of("rs", [{**CATEGORY, "name": "x"}, {**AMOUNT, "name": "x"}])
    assert [r.success for r in validate(sample, rules).results] == [False, False]
    assert rows_of(split(sample, rules).quarantined, "id") == [(4,), (5,)]


@pytest.mark.parametrize("keep_rows", [True, False])
def test_split_partitions_the_rows(spark, keep_rows):
    df = spark.range(1000).selectExpr("id % 300 as k", "id as v", "nullif(id % 7, 3) as w")
    if keep_rows:
        df = materialise(df, "rows", row_id=True)
    rules = RuleSet.of("rs", [
        {"name": "k", "type": "unique", "columns": ["k"]},
        {"name": "kw", "type": "unique", "columns": ["w", "k"]},
        {"name": "w", "type": "not_null", "columns": ["w"]},
    ])
    sides = split(df, rules, order_by=["v"])
    valid, bad = sides.valid, sides.quarantined.drop("_violations")
    assert valid.count() + bad.count() == 1000
    assert valid.unionByName(bad).exceptAll(sides.annotated.drop("_violations")).isEmpty()
    expected = [(i,) for i in range(300) if i % 7 != 3]
    assert rows_of(valid, "v") == expected


def test_a_key_holding_a_third_of_all_rows(spark):
    n = 30_000
    df = spark.range(n).selectExpr("if(id % 3 = 0, -1, id) as k", "id as v")
    rules = RuleSet.of("rs", [{"name": "k", "type": "unique", "columns": ["k"]}])
    report = validate(df, rules)
    assert report.results[0].observed["duplicate_rows"] == n // 3
    sides = split(df, rules, order_by=["v"])
    assert sides.quarantined.count() == n // 3 - 1
    assert rows_of(sides.valid.where("k = -1"), "v") == [(0,)]


def test_one_rule_never_ends_the_run(sample):
    report = validate(sample, RuleSet.of("odd", [
        {"name": "no columns", "type": "unique"},
        {"name": "no time", "type": "freshness", "columns": ["id"], "params": {"reference": "garbage"}},
        {"name": "mixed", "type": "allowed_values", "columns": ["id"], "params": {"values": [True, 2, 3, 4, 5]}},
        {"name": "fine", "type": "not_null", "columns": ["id"]},
    ]))
    assert [r.success for r in report.results] == [False, False, True, True]
    assert [r.broken for r in report.results] == [True, True, False, False]


def test_a_judgement_that_raises_fails_its_rule_alone(sample):
    def count(df, rule):
        raise RuntimeError("boom")

    register_expectation("booming", count)
    try:
        report = validate(sample, RuleSet.of("odd", [
            {"name": "bad", "type": "booming"}, {"name": "fine", "type": "not_null", "columns": ["id"]},
        ]))
    finally:
        unregister_expectation("booming")
    assert [r.success for r in report.results] == [False, True] and "boom" in report.results[0].message


def test_severities_are_checked():
    with pytest.raises(ValueError, match="eror"):
        RuleSet.of("r", [{"name": "n", "type": "not_null", "columns": ["id"], "severity": "eror"}])


def test_many_repeated_keys_move_the_table_once(spark, folder, monkeypatch):
    monkeypatch.setattr(uniqueness, "FEW_KEYS", 100_000)
    path = folder()
    spark.range(260_000).selectExpr("case when id % 130000 > 0 then id % 130000 end as k", "-id as v").write.parquet(path)
    stored = read_parquet(spark, path, row_id=True)
    found = uniqueness.find_copies(stored, ["k"], ["v"])
    assert found.columns == ["k", "_copies"] and found.count() == 130_000
    sides = split(stored, RuleSet.of("u", [{"name": "u", "type": "unique", "columns": ["k"]}]), ["v"], duplicates={("k",): found})
    assert sides.settled().quarantined.agg(F.count("*"), F.count("k"), F.min("v")).first()[:] == (130_000, 129_999, -129_999)
    assert sides.valid.agg(F.count("*"), F.count("k"), F.max("v")).first()[:] == (130_000, 129_999, -130_000)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_copies_are_ranked_and_crowds_are_joined(spark, folder, monkeypatch, broadcast):
    monkeypatch.setattr(uniqueness, "FEW_KEYS", 0)
    monkeypatch.setattr(uniqueness, "CROWD", 3)
    path = folder()
    spark.range(60).selectExpr(
        "id", "case when id < 9 then null when id < 30 then 1 when id < 34 then 2 else floor(id / 3) end as a",
        "case when id % 2 = 0 then double('nan') when id < 40 then null else 0.5D end as b", "id % 5 as o").write.parquet(path)
    stored = read_parquet(spark, path, row_id=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        firsts = uniqueness.first_of_duplicates(stored, ["a", "b"], ["o"])
        joined = uniqueness.flag_later_copies(stored, firsts, ["a", "b"], "later")
        found = uniqueness.find_copies(stored, ["a", "b"], ["o"])
        ranked = uniqueness.flag_copies(stored, found, ["a", "b"], ["o"], "later")
        assert ranked.columns == joined.columns
        assert rows_of(ranked, "id", "later") == rows_of(joined, "id", "later")
        assert found.where("_copies > 3").count() > 1 and ranked.where("later").count() > 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
