"""The plans behind the operators: what is read, what moves, and what is limited early."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from lakesieve import RuleSet, split
from lakesieve.operators.split import find_duplicates
from lakesieve.operators.uniqueness import drop_duplicates, duplicate_row_count
from lakesieve.plans import alerts, history
from lakesieve.plans.monitor import filter_runs
from lakesieve.session import read_parquet

UNIQUE = RuleSet.of("rs", [{"name": "k", "type": "unique", "columns": ["k"]},
                           {"name": "v", "type": "range", "columns": ["v"], "params": {"max": 900}}])


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture
def stored(spark, folder):
    path = folder()
    spark.range(1000).selectExpr("id % 990 as k", "id as v", "cast(id as string) as w").write.parquet(path)
    return read_parquet(spark, path, row_id=True)


def test_few_duplicates_do_not_move_the_table(stored):
    sides = split(stored, UNIQUE, duplicates=find_duplicates(stored, UNIQUE))
    for side in (sides.valid, sides.quarantined):
        text = plan(side)
        assert "BroadcastHashJoin" in text
        assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_copies_are_told_apart_once(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = split(stored, UNIQUE)
        assert "SortMergeJoin" in plan(sides.valid)
        settled = sides.settled()
        for side in (settled.valid, settled.quarantined):
            assert "Join" not in plan(side) and "Exchange" not in plan(side)
        assert settled.valid.count() == sides.valid.count() == 901
        assert settled.quarantined.count() == 99
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_intermediates_can_be_removed(spark, stored):
    from lakesieve import clear_intermediates, storage
    from lakesieve.session import _own_dir, materialise

    materialise(stored, "kept")
    assert any(n.startswith("kept-") for n in storage.names(spark, _own_dir(spark)))
    clear_intermediates(spark)
    assert storage.names(spark, _own_dir(spark)) == []


def test_counting_duplicates_reads_only_the_key(stored):
    plain = stored.sparkSession.read.parquet(*stored.inputFiles())
    text = plan(duplicate_row_count(plain, ["k"]))
    assert "ReadSchema: struct<k:bigint>" in text
    assert "partial_count" in text


def test_dropping_duplicates_shrinks_keys_before_the_shuffle(stored):
    text = plan(drop_duplicates(stored.drop("_row"), ["k"], order_by=["v"]))
    assert "partial_min(" in text
    assert "Window" not in text


def test_alert_lists_are_limited_before_the_shuffle(frame):
    metrics = frame(history.TABLES["quality_metrics"])
    scores = frame(history.TABLES["quality_scores"])
    text = plan(alerts.quality_alerts(metrics, scores, F.lit("p")))
    assert "WindowGroupLimit" in text or "LocalTableScan" in text


def test_top_lists_are_taken_without_a_full_sort(spark, folder):
    path = folder()
    spark.range(100).selectExpr("cast(id as string) as run_id", "timestamp_seconds(id) as started_at",
                                "'p' as pipeline_name", "'s' as status").write.parquet(path)
    runs = spark.read.parquet(path)
    assert "TakeOrderedAndProject" in plan(history.recent_runs(runs, 5))
    assert "EqualTo(pipeline_name,p)" in plan(filter_runs(runs, "p"))
