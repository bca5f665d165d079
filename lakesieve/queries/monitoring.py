"""History and monitoring queries, with the sample tables standing in for history."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import compile_row_rules
from ..plans import alerts, history, monitor, profiles
from .base import query, table
from .functions import EVENT_ALERTS, SEVERITY, event_alerts
from .quality import LINE_RULES

RUN_COLUMNS = """
    cast(o_orderkey as varchar(20)) as run_id, o_orderpriority as pipeline_name,
    case o_orderstatus when 'F' then 'success' when 'P' then 'partial' else 'failed' end as status,
    o_orderdate as started_at,
    cast(floor(o_totalprice) as bigint) as rows_extracted,
    case when o_custkey % 9 = 0 then null else cast(floor(o_totalprice / 2) as bigint) end as rows_loaded,
    o_custkey % 100 as rows_quarantined
"""
RUNS = f"select {RUN_COLUMNS} from orders"

STAGE_COLUMNS = """
    cast(l_orderkey as varchar(20)) as run_id, concat('stage', l_linenumber) as stage_name,
    case l_returnflag when 'R' then 'failed' when 'A' then 'skipped' else 'success' end as status,
    cast(floor(l_extendedprice) as bigint) % 50 as rows_extracted,
    cast(floor(l_quantity) as bigint) as rows_loaded,
    case when l_partkey % 8 = 0 then null else l_partkey % 20 end as rows_quarantined,
    case when l_returnflag = 'R' then concat('error ', l_suppkey, '-', l_partkey) end as error_message,
    l_shipdate as started_at
"""
STAGES = f"select {STAGE_COLUMNS} from lineitem"


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(f"select {RUN_COLUMNS} from {{orders}}", orders=table(spark, sf, "orders"))


def stages(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(f"select {STAGE_COLUMNS} from {{lines}}", lines=table(spark, sf, "lineitem"))


# -- runs and stages ------------------------------------------------------------------------


@query(f"""
    select run_id, status, rows_extracted from ({RUNS})
    where pipeline_name = '1-URGENT' and status = 'failed'
""")
def runs_filtered(spark, sf):
    found = monitor.filter_runs(runs(spark, sf), "1-URGENT", "failed")
    return found.select("run_id", "status", "rows_extracted")


@query(f"""
    select run_id, cast(sum(coalesce(rows_extracted, 0)) as bigint) as rows_extracted,
      cast(sum(coalesce(rows_loaded, 0)) as bigint) as rows_loaded,
      cast(sum(coalesce(rows_quarantined, 0)) as bigint) as rows_quarantined
    from ({STAGES}) group by run_id
""")
def run_totals(spark, sf):
    return monitor.run_totals(stages(spark, sf))


@query(f"""
    select r.run_id, case when count(s.run_id) = 0 then 'failed'
        when bool_and(s.status = 'success') then 'success'
        when bool_or(s.status = 'success') then 'partial' else 'failed' end as status
    from ({RUNS}) r left join ({STAGES}) s on r.run_id = s.run_id group by r.run_id
""")
def run_status(spark, sf):
    return monitor.run_status(stages(spark, sf), runs(spark, sf))


@query(f"""
    select count(*) as total_runs, count(*) filter (where status = 'success') as success_runs,
      round(count(*) filter (where status = 'success') / count(*), 6) as success_rate,
      cast(sum(coalesce(rows_loaded, 0)) as bigint) as rows_loaded,
      cast(sum(coalesce(rows_quarantined, 0)) as bigint) as rows_quarantined
    from ({RUNS})
""")
def run_kpis(spark, sf):
    found = monitor.run_kpis(runs(spark, sf))
    return found.withColumn("success_rate", F.round("success_rate", 6))


@query(f"""
    select run_id, case when cast(run_id as bigint) % 11 = 0 then 0.0
      else cast(rows_quarantined * 61 + 0.25 as double) end as duration_seconds from ({RUNS})
""")
def run_duration(spark, sf):
    finished = (
        "case when cast(run_id as bigint) % 11 <> 0 then "
        "timestampadd(MICROSECOND, rows_quarantined * 61000000 + 250000, started_at) end"
    )
    timed = runs(spark, sf).withColumn("finished_at", F.expr(finished))
    return monitor.run_duration(timed).select("run_id", "duration_seconds")


@query(f"""
    select run_id, stage_name, rows_quarantined,
      round(coalesce(rows_quarantined / nullif(rows_extracted, 0), 0), 6) as quarantine_rate
    from ({STAGES})
""")
def quarantine_rate(spark, sf):
    rated = monitor.quarantine_rate(stages(spark, sf))
    rate = F.round("quarantine_rate", 6).alias("quarantine_rate")
    return rated.select("run_id", "stage_name", "rows_quarantined", rate)


@query(f"""
    select run_id, metric, rows from (
      select run_id, 'rows_extracted' as metric, rows_extracted as rows from ({RUNS})
      union all select run_id, 'rows_loaded', rows_loaded from ({RUNS})
      union all select run_id, 'rows_quarantined', rows_quarantined from ({RUNS}))
""")
def volume_unpivot(spark, sf):
    return monitor.volume_by_metric(runs(spark, sf), ["run_id"])


@query(f"""
    select run_id, status, rows_extracted from ({RUNS}) order by started_at desc, run_id limit 100
""")
def recent_runs(spark, sf):
    return history.recent_runs(runs(spark, sf)).select("run_id", "status", "rows_extracted")


STAGE_ORDER = "started_at desc, run_id, stage_name, rows_extracted, rows_loaded, rows_quarantined"


@query(f"""
    select run_id, stage_name, status, rows_extracted from
      (select * from ({STAGES}) order by {STAGE_ORDER} limit 500)
    union all
    select run_id, stage_name, status, rows_extracted from ({STAGES}) where run_id = '7'
""")
def stage_runs_read(spark, sf):
    df = stages(spark, sf)
    ties = ["run_id", "stage_name", "rows_extracted", "rows_loaded", "rows_quarantined"]
    columns = ["run_id", "stage_name", "status", "rows_extracted"]
    newest = history.stage_runs(df, ties=ties).select(*columns)
    return newest.unionByName(history.stage_runs(df, "7").select(*columns))


@query(f"""
    select run_id, pipeline_name, status from ({RUNS}) where cast(run_id as bigint) % 3 <> 0
    union all
    select run_id, 'again', 'running' from ({RUNS})
    where cast(run_id as bigint) % 2 = 0 and cast(run_id as bigint) % 3 = 0
""")
def runs_insert_absent(spark, sf):
    df = runs(spark, sf).select("run_id", "pipeline_name", "status")
    key = F.col("run_id").cast("bigint")
    new = df.where(key % 2 == 0).select(
        "run_id", F.lit("again").alias("pipeline_name"), F.lit("running").alias("status")
    )
    return history.insert_absent(df.where(key % 3 != 0), new)


@query("""
    with events as (
      select cast(o_orderkey as varchar) as run_id, 'running' as status, o_orderdate as event_at from orders
      union all
      select cast(o_orderkey as varchar), o_orderstatus, o_orderdate + interval 1 hour from orders
      where o_orderkey % 5 <> 0)
    select run_id, arg_max(status, event_at) as status from events group by run_id
""")
def runs_latest_state(spark, sf):
    orders = table(spark, sf, "orders")
    started = orders.selectExpr(
        "cast(o_orderkey as string) as run_id", "'running' as status", "o_orderdate as event_at"
    )
    finished = orders.where("o_orderkey % 5 <> 0").selectExpr(
        "cast(o_orderkey as string)", "o_orderstatus", "o_orderdate + interval 1 hour"
    )
    return history.latest_state(started.unionAll(finished)).select("run_id", "status")


# -- quality history: line items checked per return flag (data set) and year (run) ----------

#: The row-level rules of the rule set, with the violation share each tolerates.
TOLERANCES = {"quantity": 0.1, "return_flag": 0.0, "discount": 0.048, "low_tax": 0.11}

CHECKED = """
    select cast(year(l_shipdate) as int) as y, l_returnflag as dataset, count(*) as n,
      count(*) filter (where l_quantity < 1 or l_quantity > 45) as quantity,
      count(*) filter (where l_returnflag not in ('A', 'N')) as return_flag,
      count(*) filter (where not l_discount <= 0.09) as discount,
      count(*) filter (where l_tax > 0.07) as low_tax
    from lineitem group by all
"""
METRICS = " union all ".join(
    f"""
    select cast(y as varchar) as run_id, dataset as stage_name, dataset, 'line_items' as rule_set,
      {i} as position, '{name}' as expectation_name, '{kind}' as expectation_type,
      '{severity}' as severity, {name} <= {TOLERANCES[name]} * n as success,
      {name} || ' of ' || n as message, n as row_count, make_timestamp(y, 12, 31, 0, 0, 0) as recorded_at
    from ({CHECKED})
    """
    for i, (name, kind, severity) in enumerate(
        [("quantity", "range", "error"), ("return_flag", "allowed_values", "error"),
         ("discount", "business_rule", "error"), ("low_tax", "range", "warning")]
    )
)
SCORES = f"""
    select run_id, stage_name, dataset, rule_set, count(*) as total,
      count(*) filter (where success) as passed, count(*) filter (where not success) as failed,
      round(count(*) filter (where success) / count(*), 4) as score, any_value(row_count) as row_count,
      any_value(recorded_at) as recorded_at
    from ({METRICS}) group by all
"""


def checked_rules(df: DataFrame) -> dict[str, tuple]:
    """Rules with a row predicate, warnings included."""
    hard = replace(
        LINE_RULES,
        expectations=[replace(e, severity="error") for e in LINE_RULES.expectations
                      if e.name in TOLERANCES],
    )
    severities = {e.name: e.severity for e in LINE_RULES.expectations}
    found = compile_row_rules(df, hard).values()
    return {rule.name: (rule, severities[rule.name], check.violation) for rule, check in found}


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Rule results per return flag and year: one aggregate, then one row per rule."""
    df = table(spark, sf, "lineitem")
    rules = checked_rules(df)
    counts = [F.count_if(violation).alias(name) for name, (_, _, violation) in rules.items()]
    checked = df.groupBy(F.year("l_shipdate").alias("y"), F.col("l_returnflag").alias("dataset")).agg(
        F.count("*").alias("n"), *counts
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("expectation_name"),
            F.lit(rule.type).alias("expectation_type"), F.lit(severity).alias("severity"),
            (F.col(name) <= F.lit(TOLERANCES[name]) * F.col("n")).alias("success"),
            F.concat(F.col(name), F.lit(" of "), F.col("n")).alias("message"),
        )
        for i, (name, (rule, severity, _)) in enumerate(rules.items())
    ]
    at = F.make_timestamp_ntz("y", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0))
    return checked.select(
        F.col("y").cast("string").alias("run_id"), F.col("dataset").alias("stage_name"), "dataset",
        F.lit("line_items").alias("rule_set"), F.inline(F.array(*entries)),
        F.col("n").alias("row_count"), at.alias("recorded_at"),
    )


def scores(spark: SparkSession, sf: str) -> DataFrame:
    passed = F.count_if("success")
    total = F.count("*")
    return metrics(spark, sf).groupBy("run_id", "stage_name", "dataset", "rule_set").agg(
        total.alias("total"), passed.alias("passed"), (total - passed).alias("failed"),
        F.bround(passed / total, 4).alias("score"), F.any_value("row_count").alias("row_count"),
        F.any_value("recorded_at").alias("recorded_at"),
    )


SCORE_COLUMNS = "run_id, dataset, rule_set, total, passed, failed, score, row_count"


@query(f"""
    (select {SCORE_COLUMNS} from ({SCORES}) order by recorded_at desc, run_id, stage_name limit 500)
    union all (select {SCORE_COLUMNS} from ({SCORES}) where dataset = 'A')
""")
def scores_read(spark, sf):
    df, columns = scores(spark, sf), SCORE_COLUMNS.split(", ")
    everything = history.quality_scores(df).select(*columns)
    return everything.unionByName(history.quality_scores(df, "A").select(*columns))


METRIC_COLUMNS = "run_id, dataset, expectation_name, expectation_type, severity, success, message"


@query(f"""
    (select {METRIC_COLUMNS} from ({METRICS})
     order by recorded_at desc, run_id, stage_name, expectation_name limit 1000)
    union all (select {METRIC_COLUMNS} from ({METRICS}) where run_id = '1995')
""")
def metrics_read(spark, sf):
    df, columns = metrics(spark, sf), METRIC_COLUMNS.split(", ")
    everything = history.quality_metrics(df).select(*columns)
    return everything.unionByName(history.quality_metrics(df, "1995").select(*columns))


@query(f"""
    select event_id, key as alert_key, severity from ({EVENT_ALERTS})
    order by ts desc, event_id limit 200
""")
def logs_read(spark, sf):
    newest = history.log_rows(event_alerts(spark, sf), "ts", ties=["event_id"])
    return newest.select("event_id", F.col("key").alias("alert_key"), "severity")


@query("""
    select distinct o_orderpriority as pipeline_name, o_orderstatus as stage_name, 'orders' as source_name,
      'parquet' as source_type, 'warehouse' as target_name, lower(o_orderstatus) as target_table
    from orders
""")
def lineage_distinct(spark, sf):
    edges = table(spark, sf, "orders").selectExpr(
        "o_orderkey as run_id", "o_orderpriority as pipeline_name", "o_orderstatus as stage_name",
        "'orders' as source_name", "'parquet' as source_type", "'warehouse' as target_name",
        "lower(o_orderstatus) as target_table",
    )
    return history.lineage_edges(edges)


@query(f"select dataset, arg_max(score, recorded_at) as score from ({SCORES}) group by dataset")
def latest_score(spark, sf):
    return monitor.latest_score(scores(spark, sf))


@query("""
    with s as (select o_custkey as dataset, o_orderdate as recorded_at, o_orderkey as k,
        case when o_orderkey % 23 = 0 then null else round(o_totalprice / 1e6, 6) end as score from orders)
    select k, dataset, score, lag(score) over w as previous_score, round(score - lag(score) over w, 6) as drift
    from s window w as (partition by dataset order by recorded_at, k)
""")
def score_trend(spark, sf):
    """Order values as scores of their customers, in time order."""
    df = table(spark, sf, "orders").selectExpr(
        "o_custkey as dataset", "o_orderdate as recorded_at", "o_orderkey as k",
        "case when o_orderkey % 23 = 0 then null else round(o_totalprice / 1e6, 6) end as score",
    )
    trend = monitor.score_trend(df, ties=["k"])
    return trend.select("k", "dataset", "score", "previous_score", F.round("drift", 6).alias("drift"))


# Snapshots: each order is a run of its priority's data set; its number decides the columns.
SNAPSHOT_TYPES = {
    0: {"id": "bigint", "name": "string"},
    1: {"id": "bigint", "name": "string", "price": "double"},
    2: {"id": "string", "name": "string"},
}


def _snapshot_list(kind: int, entry: str) -> str:
    return ", ".join(entry.format(c, t) for c, t in SNAPSHOT_TYPES[kind].items())


def _snapshot_case(build: str, entry: str) -> str:
    whens = " ".join(
        f"when {k} then {build.format(_snapshot_list(k, entry))}" for k in SNAPSHOT_TYPES
    )
    return f"case (o_custkey * 7 + o_orderkey) % 3 {whens} end"


@query(f"""
    with s as (select o_orderkey as k, o_orderpriority as dataset, o_orderdate as recorded_at,
        {_snapshot_case("[{}]", "'{0}:{1}'")} as entries,
        {_snapshot_case("[{}]", "'{0}'")} as names from orders),
    p as (select *, lag(entries) over w as old_entries, lag(names) over w as old_names
      from s window w as (partition by dataset order by recorded_at, k))
    select k, dataset, case when old_entries is null then 'initial'
        when len(list_intersect(names, old_names)) < len(names) then 'added'
        when len(list_intersect(names, old_names)) < len(old_names) then 'removed'
        when entries <> old_entries then 'changed' else 'unchanged' end as change_type
    from p
""")
def schema_change(spark, sf):
    snapshot = _snapshot_case("map({})", "'{0}', '{1}'")
    df = table(spark, sf, "orders").selectExpr(
        "o_orderkey as k", "o_orderpriority as dataset", "o_orderdate as recorded_at",
        f"{snapshot} as schema_snapshot",
    )
    return monitor.schema_changes(df, ties=["k"]).select("k", "dataset", "change_type")


# -- alerts ---------------------------------------------------------------------------------


@query(f"""
    with failed as (select *, row_number() over (partition by run_id, stage_name order by position) as place
      from ({METRICS}) where not success and severity = 'error'),
    listed as (select run_id, stage_name, count(*) as failures,
        string_agg('- ' || expectation_name || ' (' || expectation_type || '): ' || message, chr(10) order by place)
          filter (where place <= 10) as lines
      from failed group by all)
    select run_id, stage_name, 'quality:retail:' || stage_name as key,
      'Data quality failure in retail/' || stage_name as subject,
      'Pipeline: retail' || chr(10) || 'Stage: ' || stage_name || chr(10) || 'Run: ' || run_id || chr(10)
        || 'Quality score: ' || printf('%.2f', score * 100) || '%' || chr(10)
        || 'Failed expectations (' || failures || '):' || chr(10) || lines as body, 'error' as severity
    from listed join (select run_id, stage_name, score from ({SCORES})) using (run_id, stage_name)
""")
def alert_messages(spark, sf):
    return alerts.quality_alerts(metrics(spark, sf), scores(spark, sf), F.lit("retail"))


@query(f"""
    with failed as (select run_id, count(*) as failures,
        string_agg('- ' || stage_name || ': ' || error_message, chr(10)
          order by '- ' || stage_name || ': ' || error_message) as lines
      from ({STAGES}) where status = 'failed' group by run_id)
    select r.run_id, 'run:' || pipeline_name as key,
      'Pipeline ' || pipeline_name || ' finished with status ' || status as subject,
      'Pipeline: ' || pipeline_name || chr(10) || 'Run: ' || r.run_id || chr(10) || 'Status: ' || status
        || chr(10) || 'Failed stages (' || coalesce(failures, 0) || '):' || chr(10) || coalesce(lines, '') as body,
      'error' as severity
    from ({RUNS}) r left join failed f on r.run_id = f.run_id where status in ('partial', 'failed')
""")
def run_failure_alerts(spark, sf):
    return alerts.run_failure_alerts(runs(spark, sf), stages(spark, sf))


GREEDY = """
    with recursive ordered as (select event_id, {key} as key, epoch_us(ts) as us,
        row_number() over (partition by {key} order by ts, event_id) as i from events),
    sent as (
      select key, i, us from ordered where i = 1
      union all
      select s.key, n.i, n.us from sent s, lateral (
        select o.i, o.us from ordered o where o.key = s.key and o.us > s.us + {minutes} * 60000000::bigint
        order by o.i limit 1) n)
    select o.event_id, s.i is null as suppressed from ordered o left join sent s on o.key = s.key and o.i = s.i
"""


@query(GREEDY.format(key="event_type || ':' || user_id", minutes=30))
def alert_suppression(spark, sf):
    flagged = alerts.suppress_repeats(
        event_alerts(spark, sf), key="key", at="ts", id_column="event_id"
    )
    return flagged.select("event_id", "suppressed")


@query(f"""
    with flagged as ({GREEDY.format(key="event_type", minutes=240)}),
    loud as (select event_id, suppressed, severity from flagged join ({EVENT_ALERTS}) using (event_id)
      where severity in ('error', 'critical', 'strange'))
    select event_id, severity, suppressed, 'all' as channel from loud where suppressed
    union all
    select event_id, severity, suppressed, channel from loud, (values ('email'), ('slack')) c(channel)
    where not suppressed
""")
def alert_log_rows(spark, sf):
    df = table(spark, sf, "events").selectExpr(
        "event_id", "event_type as key", f"{SEVERITY} as severity", "ts"
    )
    rows = alerts.dispatch(df, ["email", "slack"], at="ts", id_column="event_id", minutes=240)
    return rows.select("event_id", "severity", "suppressed", "channel")


#: A customer's orders as the stages of a run; each waits for the two before the last.
STAGE_ORDERS = """
    select o_custkey as run_id, o_orderkey as stage_name, case when o_totalprice < 40000 then 'failed' else 'success' end as status,
      lag(o_orderkey, 2) over w as one, lag(o_orderkey, 3) over w as two
    from orders window w as (partition by o_custkey order by o_orderkey)
"""


@query(f"""
    with recursive stages as ({STAGE_ORDERS}),
    edges as (
      select run_id, stage_name, one as after from stages where one is not null
      union select run_id, stage_name, two from stages where two is not null),
    reach as (
      select run_id, stage_name, 0 as distance from stages where status = 'failed'
      union select e.run_id, e.stage_name, r.distance + 1 from reach r join edges e on e.run_id = r.run_id and e.after = r.stage_name)
    select run_id, stage_name, cast(min(distance) as int) as distance from reach group by run_id, stage_name having min(distance) > 0
""")
def failure_reach(spark, sf):
    stages = spark.sql(STAGE_ORDERS.replace("from orders", "from {orders}"), orders=table(spark, sf, "orders"))
    dependencies = stages.select("run_id", "stage_name", F.array_compact(F.array("one", "two")).alias("depends_on"))
    return monitor.failure_reach(stages, dependencies)


@query("""
    select strftime(o_orderdate, '%Y-%m') as month, cast(count(*) as bigint) as row_count,
      cast(count(*) - count(o_totalprice) as bigint) as missing,
      cast(min(o_totalprice) as double) as least, cast(max(o_totalprice) as double) as most,
      true as quantiles_hold, true as distinct_holds
    from orders group by 1
""")
def profile_trend(spark, sf):
    """Sketches of every day, merged by month, and whether they keep to their stated errors."""
    orders = table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    days = profiles.profile(orders, ["o_totalprice"], ["month", "o_orderdate"])
    found = profiles.estimates(profiles.merged(days, ["month"]), (0.25, 0.5, 0.75))
    value, quantile = F.col("o_totalprice").cast("double"), F.col("quantiles")
    shares = [(F.avg((value <= quantile[i]).cast("int")), p) for i, p in enumerate((0.25, 0.5, 0.75))]
    # the stated errors are passed in one case of a hundred, three times as much practically never
    within = [F.abs(share - p) <= 3 * profiles.RANK_ERROR + F.try_divide(F.lit(1), F.count("o_totalprice")) for share, p in shares]
    known = F.count_distinct("o_totalprice")
    exact = orders.join(found.select("month", "quantiles", "distinct_values"), "month").groupBy("month").agg(
        (within[0] & within[1] & within[2]).alias("quantiles_hold"),
        (F.abs(F.max("distinct_values") - known) <= 6 * profiles.DISTINCT_ERROR * known + 1).alias("distinct_holds"),
    )
    return found.select("month", "row_count", "missing", "least", "most").join(exact, "month")
