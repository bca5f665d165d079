"""Column sketches against exact numbers, and the history they are kept in."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakesieve import Places, Stage, run_pipeline
from lakesieve.plans import history, profiles
from lakesieve.storage import delete, names

AT = dt.datetime(2024, 1, 1, 12)


def test_merged_sketches_keep_to_their_errors(spark):
    df = spark.range(60_000).selectExpr(
        "pmod(hash(id), 20000) as v", "id % 7 as run", "if(id % 10 = 0, null, cast(id as double)) as d")
    one = profiles.merged(profiles.profile(df, ["v", "d"], ["run"]))
    found = {r["column_name"]: r for r in profiles.estimates(one, [i / 10 for i in range(1, 10)]).collect()}
    assert (found["v"]["row_count"], found["v"]["missing"], found["d"]["missing"]) == (60_000, 0, 6_000)
    assert (found["d"]["least"], found["d"]["most"]) == (1.0, 59_999.0)
    for i, q in enumerate(found["d"]["quantiles"]):
        assert abs(q / 60_000 - (i + 1) / 10) <= 3 * profiles.RANK_ERROR
    exact = df.agg(F.count_distinct("v")).first()[0]
    assert abs(found["v"]["distinct_values"] - exact) <= 6 * profiles.DISTINCT_ERROR * exact


def test_types_nulls_and_empty_tables(spark, frame):
    df = frame("d date, t timestamp, s string, a array<int>, x double, n int",
               (dt.date(1970, 1, 2), dt.datetime(1970, 1, 1), "a", [1], float("nan"), None),
               (None, None, None, None, None, None),
               (dt.date(1970, 1, 3), dt.datetime(1970, 1, 1), "b", [1], 2.5, None))
    found = {r["column_name"]: r for r in profiles.estimates(profiles.profile(df, df.columns)).collect()}
    assert {c: r["missing"] for c, r in found.items()} == {"d": 1, "t": 1, "s": 1, "a": 1, "x": 2, "n": 3}
    assert {c: r["distinct_values"] for c, r in found.items()} == {"d": 2, "t": 1, "s": 2, "a": 1, "x": 1, "n": 0}
    assert (found["d"]["least"], found["d"]["most"], found["x"]["quantiles"]) == (86400.0, 172800.0, [2.5] * 3)
    assert found["s"]["quantiles"] is None and found["n"]["least"] is None
    nothing = profiles.profile(df.limit(0), ["x"])
    assert [(r["row_count"], r["quantile_sketch"]) for r in nothing.collect()] == [(0, None)]
    assert profiles.profile(df.limit(0), ["x"], ["s"]).count() == 0
    assert profiles.merged(nothing.union(profiles.profile(df, ["x"]))).first()["row_count"] == 3
    with pytest.raises(KeyError):
        profiles.profile(df, ["absent"])


def test_drift_tells_a_moved_column(spark):
    def of(low):
        return profiles.profile(spark.range(5000).selectExpr(f"id + {low} as v", "id as w", "'x' as s"), ["v", "w", "s"])

    found = {r["column_name"]: r["drift"] for r in profiles.drift(of(2500), of(0)).collect()}
    assert found.keys() == {"v", "w"}
    assert abs(found["v"] - 0.5) <= 6 * profiles.RANK_ERROR and found["w"] <= 6 * profiles.RANK_ERROR


def test_runs_keep_profiles_of_what_they_load(spark, folder):
    places = Places(folder(), folder(), folder())
    for run, low in (("r1", 0), ("r2", 1000)):
        stage = Stage("s", spark.range(low, low + 1000).selectExpr("id", "id * 2 as v"), profile=["v"])
        run_pipeline(spark, "p", [stage], places, run_id=run)
    kept = history.History(spark, places.history).table("column_profiles")
    assert kept.count() == 2
    last = profiles.estimates(profiles.merged(kept, ["dataset"])).first()
    assert (last["dataset"], last["row_count"], last["least"], last["most"]) == ("s", 2000, 0.0, 3998.0)


def contents(log):
    return {name: sorted(map(repr, log.table(name).collect())) for name in history.TABLES}


def filled(spark, root, runs):
    log = history.History(spark, root)
    for run in runs:
        log.start_run(run, "p", AT)
        log.log_error(run, "no stage", AT)
        log.log_error(run, "first", AT, stage="s")
        log.finish_run(run, "p", "success", AT, AT, {})
    return log


def test_compaction_keeps_rows_and_the_replay_rule(spark, folder):
    root = folder()
    log = filled(spark, root, ["a b", "c:d", "e"])
    log.start_run("open", "p", AT)
    before = contents(log)
    # error_logs and pipeline_runs hold a folder for each of three runs that have ended
    assert log.compact() == 6
    assert contents(log) == before
    assert names(spark, f"{root}/{history.TABLE}=error_logs") == []
    assert [n for n in names(spark, f"{root}/{history.TABLE}=pipeline_runs") if n.startswith("run_id")] == ["run_id=open"]
    assert log.compact() == 0

    # a later attempt replaces the compacted rows of its run and stage alone
    log.log_error("c:d", "second", AT, stage="s")
    found = {(r["run_id"], r["stage_name"], r["message"]) for r in log.table("error_logs").collect()}
    assert ("c:d", "s", "second") in found and ("c:d", "s", "first") not in found
    assert ("c:d", None, "no stage") in found and ("e", "s", "first") in found
    log.start_run("e", "other", AT)  # known, though compacted
    log.finish_run("open", "p", "failed", AT, AT, {})
    before = contents(log)
    assert log.compact() == 2
    assert contents(log) == before
    assert sorted(names(spark, f"{root}/{history.COMPACTED}")) == ["2", f"2{history.WHOLE}"]


def test_a_compaction_that_stops_half_way_changes_nothing(spark, folder, monkeypatch):
    root = folder()
    log = filled(spark, root, ["a", "b"])
    before = contents(log)

    def fails(*_):
        raise RuntimeError("executor lost")

    # before the mark
    monkeypatch.setattr(history, "put_once", fails)
    with pytest.raises(RuntimeError):
        log.compact()
    assert contents(log) == before
    monkeypatch.undo()
    # between the mark and the last deletion
    gone = []

    def once(spark, path):
        if gone and history.COMPACTED not in path:
            fails()
        gone.append(path)
        delete(spark, path)

    monkeypatch.setattr(history, "delete", lambda s, p: once(s, p) if history.COMPACTED not in p else delete(s, p))
    with pytest.raises(RuntimeError):
        log.compact()
    assert len(gone) == 1 and contents(log) == before
    monkeypatch.undo()
    assert log.compact() == 3
    assert contents(log) == before
