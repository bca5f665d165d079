"""History, monitoring and alerts; suppression against a plain loop."""

import datetime as dt
import random
import tracemalloc

import pyarrow as pa
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from lakesieve import RuleSet, validate
from lakesieve.plans import alerts, history, monitor

AT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("previous, current, change", [
    (None, {"a": "int"}, "initial"),
    ({"a": "int"}, {"a": "int", "b": "string"}, "added"),
    ({"a": "int", "b": "string"}, {"a": "int"}, "removed"),
    ({"a": "int"}, {"a": "double"}, "changed"),
    ({"a": "int"}, {"a": "int"}, "unchanged"),
    ({"a": "int", "b": "int"}, {"a": "int", "c": "int"}, "added"),
])
def test_schema_change_classes(frame, previous, current, change):
    rows = [("d", s, f"2024-0{i}-01") for i, s in enumerate([previous, current], 1) if s]
    df = frame("dataset string, schema_snapshot map<string,string>, at string", *rows)
    df = df.withColumn("recorded_at", F.col("at").cast("timestamp"))
    last = monitor.schema_changes(df).orderBy("at").collect()[-1]
    assert last["change_type"] == change


def test_previous_value_reaches_over_ranges(spark, ranges):
    df = spark.range(60).selectExpr(
        "id", "if(id % 3 = 0, 'hot', 'b') as k",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id * id as int)) as at",
        "if(id % 10 = 0, null, id) as v")
    found = rows_of(monitor.with_previous(df, "k", "at", "v", "before"), "id", "before")
    last = {}
    for i, before in found:
        key = "hot" if i % 3 == 0 else "b"
        assert before == last.get(key)
        last[key] = None if i % 10 == 0 else i


def test_one_key_and_one_instant_hold_all_rows(spark, ranges):
    df = spark.range(500).selectExpr("id", "'k' as k", "timestamp'2024-01-01' as at", "id * 2 as v")
    found = rows_of(monitor.with_previous(df, "k", "at", "v", "before", ties=["id"]), "id", "before")
    assert found == [(i, None if i == 0 else 2 * (i - 1)) for i in range(500)]
    ranged = monitor.in_ranges(df, "k", ["at", "id"], "t")
    assert ranged.select("_range").distinct().count() == (1 if ranges == "one range" else 13)


def test_run_life_cycle(spark, folder):
    log = history.History(spark, folder())
    assert log.table("pipeline_runs").count() == 0
    log.start_run("r1", "p", AT)
    log.start_run("r1", "other", AT)
    later = AT + dt.timedelta(seconds=90, milliseconds=250)
    log.finish_run("r1", "p", "success", AT, later, {"rows_extracted": 5, "rows_loaded": 4})
    log.start_run("r2", "p", AT)
    runs = history.latest_state(log.table("pipeline_runs"))
    assert rows_of(runs, "run_id", "status") == [("r1", "success"), ("r2", "running")]
    first = runs.where("run_id = 'r1'").first()
    assert (first["pipeline_name"], float(first["duration_seconds"]), first["rows_loaded"]) == (
        "p", 90.25, 4)
    timed = monitor.run_duration(runs.drop("duration_seconds"))
    assert rows_of(timed, "duration_seconds") == [(0.0,), (90.25,)]
    kpis = monitor.run_kpis(runs).first()
    assert (kpis["total_runs"], kpis["success_rate"], kpis["rows_loaded"]) == (2, 0.5, 4)
    nobody = monitor.run_kpis(monitor.filter_runs(runs, pipeline="absent")).first()
    assert (nobody["total_runs"], nobody["success_rate"], nobody["rows_loaded"]) == (0, None, 0)


def test_quality_history(spark, sample, folder):
    log = history.History(spark, folder())
    rules = RuleSet.of("rs", [
        {"name": "category", "type": "not_null", "columns": ["category"]},
        {"name": "amount", "type": "range", "columns": ["amount"], "params": {"min": 0}},
        {"name": "low", "type": "range", "columns": ["id"], "params": {"max": 1}, "severity": "warning"},
        {"name": "ok", "type": "unique", "columns": ["id"]},
    ])
    report = validate(sample, rules, "stage")
    for _ in range(2):  # a retry replaces its own rows
        log.record_quality("r1", "stage", report, AT)
    assert log.table("quality_metrics").count() == 4
    score = log.table("quality_scores").first()
    assert (score["total"], score["passed"], float(score["score"]), score["row_count"]) == (4, 1, 0.25, 5)
    found = alerts.quality_alerts(
        log.table("quality_metrics"), log.table("quality_scores"), F.lit("p")).collect()
    assert len(found) == 1
    assert found[0]["key"] == "quality:p:stage"
    assert found[0]["subject"] == "Data quality failure in p/stage"
    assert found[0]["body"] == (
        "Pipeline: p\nStage: stage\nRun: r1\nQuality score: 25.00%\nFailed expectations (2):\n"
        "- category (not_null): Null rate threshold exceeded\n"
        "- amount (range): Range violations exceeded threshold")


def test_quality_alert_lists_ten_failures_and_counts_all(spark, folder, sample):
    log = history.History(spark, folder())
    rules = RuleSet.of("rs", [{"name": f"rule{i}", "type": "unknown"} for i in range(13)])
    log.record_quality("r", "s", validate(sample, rules), AT)
    body = alerts.quality_alerts(
        log.table("quality_metrics"), log.table("quality_scores"), F.lit("p")).first()["body"]
    assert "Failed expectations (13):" in body
    assert [line.split()[1] for line in body.splitlines()[5:]] == [f"rule{i}" for i in range(10)]


def test_schema_history(spark, frame, folder):
    log = history.History(spark, folder())
    first, second = frame("a int"), frame("a int, b string")
    assert log.record_schema("r1", "d", first, AT) == "initial"
    assert log.record_schema("r1", "d", first, AT) == "initial"
    assert log.record_schema("r2", "d", second, AT + dt.timedelta(hours=1)) == "added"
    assert log.record_schema("r3", "other", second, AT) == "initial"
    log.log_error("r1", "boom", AT, context={"at": AT})
    assert rows_of(log.table("error_logs"), "run_id", "stage_name", "message") == [("r1", None, "boom")]


def test_status_and_rates(frame):
    stages = frame("run_id string, status string, rows_extracted bigint, rows_loaded bigint, "
                   "rows_quarantined bigint",
                   ("a", "success", 10, 9, 1), ("a", "success", 0, 0, 0), ("b", "success", 5, None, 5),
                   ("b", "failed", 4, 0, None), ("c", "skipped", None, None, None))
    runs = frame("run_id string", ("a",), ("b",), ("c",), ("d",))
    assert rows_of(monitor.run_status(stages, runs)) == [
        ("a", "success"), ("b", "partial"), ("c", "failed"), ("d", "failed")]
    assert rows_of(monitor.run_totals(stages)) == [("a", 10, 9, 1), ("b", 9, 0, 5), ("c", 0, 0, 0)]
    assert rows_of(monitor.quarantine_rate(stages), "quarantine_rate") == [
        (0.0,), (0.0,), (0.0,), (0.1,), (1.0,)]


def test_latest_score_skips_missing_ones(frame):
    df = frame("dataset string, recorded_at string, score double",
               ("a", "2024-01-01", 0.5), ("a", "2024-01-02", None), ("b", "2024-01-01", None))
    assert rows_of(monitor.latest_score(df)) == [("a", 0.5), ("b", None)]


# -- alerts ---------------------------------------------------------------------------------


def test_dedup_key_depends_on_key_and_severity_only(frame):
    import hashlib

    df = frame("k string, s string", ("k", "error"), ("k", "error"), ("k", "info"))
    keys = [r[0] for r in df.select(alerts.dedup_key(F.col("k"), F.col("s"))).collect()]
    assert keys[0] == keys[1] != keys[2]
    assert keys[0] == "k:" + hashlib.sha1(b"k|error").hexdigest()[:16]


def test_threshold(frame):
    df = frame("severity string", *[(s,) for s in ["info", "warning", "error", "critical", "odd"]])
    assert rows_of(alerts.above_threshold(df)) == [("critical",), ("error",), ("odd",)]
    assert rows_of(alerts.above_threshold(df, "critical")) == [("critical",)]
    assert alerts.above_threshold(df, "info").count() == 5


def test_log_rows(frame):
    df = frame("id int, severity string, suppressed boolean",
               (1, "error", False), (2, "error", True), (3, "info", False))
    assert rows_of(alerts.alert_log_rows(df, ["email", "slack"]), "id", "channel") == [
        (1, "email"), (1, "slack"), (2, "all")]
    assert rows_of(alerts.alert_log_rows(df, []), "id", "channel") == [(2, "all")]


def test_dispatch_without_channels_records_nothing(frame):
    df = frame("alert_id int, key string, severity string, created_at timestamp",
               (1, "k", "error", "2024-01-01"), (2, "k", "error", "2024-01-01"))
    assert alerts.dispatch(df, []).count() == 0
    assert rows_of(alerts.dispatch(df, ["email"]), "alert_id", "channel", "sent") == [
        (1, "email", True), (2, "all", False)]


def greedy(alarms, window):
    """Ids of the alerts sent, one by one in time order."""
    sent, last = set(), {}
    for at, number, key in sorted(alarms):
        if key not in last or at > last[key] + window:
            sent.add(number)
            last[key] = at
    return sent


@pytest.mark.parametrize("seed,rows", [(2, 500_000), (0, 60), (1, 60), (2, 60), (3, 40)])
def test_suppression_agrees_with_a_plain_loop(spark, seed, rows, monkeypatch):
    monkeypatch.setattr(alerts, "RANGE_ROWS", rows)
    rng = random.Random(seed)
    spread = [600, 2_000, 30_000, 200_000][seed]
    alarms = [
        (rng.choice([rng.randrange(spread), 600 * rng.randrange(max(spread // 600, 1))]), i,
         rng.choices(["hot", "b", None], [6, 3, 1])[0])
        for i in range(400)
    ]
    df = spark.createDataFrame(alarms, "at long, alert_id long, alert_key string").withColumn(
        "created_at", F.timestamp_seconds("at"))
    out = alerts.suppress_repeats(df, minutes=10)
    assert out.count() == 400
    got = {r["alert_id"] for r in out.where("not suppressed").collect()}
    assert got == greedy([(at, i, str(key)) for at, i, key in alarms], 600)


def test_a_burst_of_one_key_stays_in_bounded_tasks(spark, monkeypatch):
    """100,000 alerts of one key: dense minutes, then a quiet hour, three times. No group that a
    task holds has more than four times the rows that a range has on average."""
    monkeypatch.setattr(alerts, "RANGE_ROWS", 5_000)
    sizes, seen = [], alerts.in_ranges

    def noted(df, key, order, label, ranges=None):
        found = seen(df, key, order, label, ranges)
        sizes.append(found.groupBy("_range").count().agg(F.max("count")).first()[0])
        return found

    monkeypatch.setattr(alerts, "in_ranges", noted)
    monkeypatch.setattr("lakesieve.plans.monitor.in_ranges", noted)
    held, decide, reduce_ = spark.sparkContext.accumulator(0), alerts._decide, alerts._range_function

    def bounded(make):
        def made(window):
            function = make(window)

            def checked(*parts):
                if len(parts[-1]) > 20_000:
                    held.add(1)
                return function(*parts)

            if make is decide:
                return lambda rows: checked(rows)
            return lambda key, rows: checked(key, rows)

        return made

    monkeypatch.setattr(alerts, "_decide", bounded(decide))
    monkeypatch.setattr(alerts, "_range_function", bounded(reduce_))
    n = 100_000
    df = spark.range(n).selectExpr(
        "id as alert_id", "'k' as alert_key",
        "timestamp_micros(id div 33334 * 3600000000L * 3 + id % 33334 * 50000L) as created_at")
    sent = alerts.suppress_repeats(df).where("not suppressed")
    at = [(i // 33334 * 3 * 3600 * 10**6 + i % 33334 * 50_000, i, "k") for i in range(n)]
    assert {r.alert_id for r in sent.collect()} == greedy(at, 30 * 60 * 10**6)
    assert len(sizes) == 2 and max(sizes) <= 20_000 and held.value == 0


def test_alerts_without_a_time_are_sent(frame):
    df = frame("alert_id int, alert_key string, created_at timestamp", (1, "k", None), (2, "k", None), (3, "k", "2024-01-01"), (4, "k", "2024-01-01"))
    assert rows_of(alerts.suppress_repeats(df).where("suppressed"), "alert_id") == [(4,)]


def test_next_point_of_a_key(spark):
    from lakesieve.plans.monitor import with_next

    rng = random.Random(2)
    points = [(rng.choice("ab"), rng.randrange(300)) for _ in range(60)]
    asked = [(rng.choice("abc"), rng.randrange(-5, 305), i) for i in range(200)]
    rows = spark.createDataFrame(asked, "k string, x long, n long")
    for ranges in (1, 6):
        found = with_next(rows, spark.createDataFrame(points, "k string, x long"), "k", "x", "after", ranges)
        expected = [(k, x, n, min((p for q, p in points if q == k and p > x), default=None)) for k, x, n in asked]
        assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_suppression_window_is_inclusive(spark):
    minutes = [0, 10, 30, 31, 50, 62]
    df = spark.createDataFrame([(m, m) for m in minutes], "alert_id long, m long").selectExpr(
        "alert_id", "'k' as alert_key", "timestamp_seconds(m * 60) as created_at")
    sent = alerts.suppress_repeats(df).where("not suppressed")
    assert rows_of(sent, "alert_id") == [(0,), (31,), (62,)]


def test_a_range_of_alerts_is_decided_without_python_objects():
    n, minute = 200_000, 60_000_000
    rows = pa.table({
        "_key": [f"+some event of some kind:{i % 5000}" for i in range(n)], "_at": [i // 5000 * minute for i in range(n)],
        "_id": pa.array(range(n), pa.int64()), "_before": pa.array([-10 * minute if i % 5000 == 1 else None for i in range(n)], pa.int64()),
    })
    tracemalloc.start()
    sent = alerts._decide(30 * minute)(rows)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 * n  # a text alone takes more as an object
    minutes = {key: [i // 5000 for i in sorted(sent["_sent"].to_pylist()) if i % 5000 == key] for key in (0, 1, 4999)}
    assert minutes == {0: [0, 31], 1: [21], 4999: [0, 31]}
    assert sent.schema.field("_sent").type == pa.int64()
