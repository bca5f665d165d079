"""Expectations, rule sets, the row splitter and whole stages."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.expectations import allowed_values
from ..operators.rules import Expectation, ExpectationResult, RuleSet
from ..operators.split import Split, split
from ..operators.split import violations_by_rule as count_violations
from ..operators.validate import (
    register_expectation,
    score_rows,
    unexpected_values,
    unregister_expectation,
    validate,
)
from ..plans.history import History
from ..plans.stage import Places, Stage, run_pipeline, run_stage
from ..session import ROW, fresh_path
from ..sinks.quarantine import quarantine_rows as store_quarantine
from ..sinks.quarantine import quarantine_sample as sample_quarantine
from ..sinks.quarantine import quarantine_summary as summarise_quarantine
from ..sinks.tables import Table
from ..sources import Source
from .base import query, table
from .transforms import DIRTY_PARTS, KEY, ORDER, dirty_parts, step

AT = "2024-02-01 00:00:00"


def observed(spark: SparkSession, df: DataFrame, *rules: dict) -> DataFrame:
    """The numbers and verdicts of rules on ``df``."""
    return validate(df, RuleSet.of("rules", rules)).observed_df(spark)


@query("""
    with has as (select column_name as c, column_type as t from (describe orders)),
    families(kind, types) as (values ('int', ['TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT']), ('float', ['FLOAT', 'DOUBLE']),
      ('string', ['VARCHAR']), ('datetime', ['TIMESTAMP', 'TIMESTAMP_NS', 'TIMESTAMP WITH TIME ZONE'])),
    wanted(name, c, kind, strict) as (values ('types', 'o_orderkey', 'int', false), ('types', 'o_totalprice', 'float', false),
      ('types', 'o_orderstatus', 'string', false), ('types', 'o_orderdate', 'datetime', false),
      ('absent', 'o_orderkey', 'string', false), ('absent', 'x', 'int', false), ('extra', 'o_orderkey', null, true)),
    judged as (select w.*, h.t, h.c is null as missing,
        h.c is not null and kind is not null and not list_contains(types, h.t) as mistyped
      from wanted w left join has h using (c) left join families using (kind)),
    extra as (select w.name, h.c from (select distinct name from wanted where strict) w, has h
      where h.c not in (select c from wanted where name = w.name)),
    counted as (select name, count(*) filter (where missing) as missing, count(*) filter (where mistyped) as mistyped,
        (select count(*) from extra e where e.name = j.name) as unexpected from judged j group by name)
    select name as expectation_name, missing + mistyped + unexpected = 0 as success, missing, mistyped, unexpected,
      (select count(*) from orders) as row_count from counted
""")
def exp_schema(spark, sf):
    types = {"o_orderkey": "int", "o_totalprice": "float", "o_orderstatus": "string",
             "o_orderdate": "datetime"}
    rules = RuleSet.of("schema", [
        {"name": "types", "type": "schema", "params": {"columns": types}},
        {"name": "absent", "type": "schema", "params": {"columns": {"o_orderkey": "string", "x": "int"}}},
        {"name": "extra", "type": "schema", "columns": ["o_orderkey"], "params": {"allow_extra": False}},
    ])
    report = validate(table(spark, sf, "orders"), rules)
    rows = F.lit(report.row_count).cast("bigint").alias("row_count")
    found = F.from_json("observed", "missing array<string>, type_mismatches map<string,string>, unexpected array<string>")
    counts = [F.size(found[c]).cast("bigint").alias(n) for c, n in
              (("missing", "missing"), ("type_mismatches", "mistyped"), ("unexpected", "unexpected"))]
    return report.to_df(spark).select("expectation_name", "success", *counts, rows)


@query(f"""
    with rates as (
      select round(avg(case when price is null then 1.0 else 0 end), 4) as price,
        round(avg(case when brand is null then 1.0 else 0 end), 4) as brand
      from ({DIRTY_PARTS})),
    columns as (select column_name from (describe {DIRTY_PARTS})),
    wanted as (select * from (values ('price'), ('brand'), ('absent')) w(column_name)),
    listed as (select 'price' as column_name, price as value from rates
      union all select 'brand', brand from rates),
    broken as (select column_name, value from listed where value > 0
      union all select column_name, 1.0 from wanted where column_name not in (select column_name from columns)),
    strict as (select (select count(*) from broken) = 0 as success),
    lenient as (select max(value) <= 0.5 as success from listed)
    select 'strict' as expectation_name, column_name, 'null_rates' as metric, value, success from listed, strict
    union all select 'strict', column_name, 'violations', value, success from broken, strict
    union all select 'strict', null, 'threshold', 0.0, success from strict
    union all select 'lenient', column_name, 'null_rates', value, success from listed, lenient
    union all select 'lenient', null, 'threshold', 0.5, success from lenient
""")
def exp_not_null(spark, sf):
    return observed(
        spark, dirty_parts(spark, sf),
        {"name": "strict", "type": "not_null", "columns": ["price", "brand", "absent"]},
        {"name": "lenient", "type": "completeness", "columns": ["price", "brand"],
         "params": {"max_null_rate": 0.5}},
    )


DUPLICATES = """
    select coalesce(sum(n), 0)::double as value from
      (select count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
"""


@query(f"""
    select 'lines' as expectation_name, null::varchar as column_name, 'duplicate_rows' as metric,
      value, value = 0 as success from ({DUPLICATES})
    union all select 'all', null, 'duplicate_rows', 0.0, true
""")
def exp_unique(spark, sf):
    df = table(spark, sf, "lineitem")
    return observed(
        spark, df,
        {"name": "lines", "type": "unique", "columns": KEY},
        {"name": "all", "type": "unique", "columns": df.columns},
    )


@query(f"""
    with keyed as (select c_custkey, nullif(c_nationkey, 3) as nation from customer),
    facts as (
      select 'customer' as name, (select coalesce(sum(n), 0)::double from
          (select count(*) as n from keyed group by c_custkey having count(*) > 1)) as dup,
        (select count(*)::double from keyed where c_custkey is null) as nulls
      union all select 'nation', (select coalesce(sum(n), 0)::double from
          (select count(*) as n from keyed group by nation having count(*) > 1)),
        (select count(*)::double from keyed where nation is null))
    select name as expectation_name, null::varchar as column_name, 'duplicate_rows' as metric,
      dup as value, dup + nulls = 0 as success from facts
    union all select name, null, 'null_key_rows', nulls, dup + nulls = 0 from facts
    union all select 'nation_soft', null, 'duplicate_rows', dup, dup = 0 from facts where name = 'nation'
""")
def exp_primary_key(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey", "nullif(c_nationkey, 3) as nation")
    primary = {"primary_key": True}
    return observed(
        spark, df,
        {"name": "customer", "type": "primary_key", "columns": ["c_custkey"], "params": primary},
        {"name": "nation", "type": "primary_key", "columns": ["nation"], "params": primary},
        {"name": "nation_soft", "type": "primary_key", "columns": ["nation"]},
    )


@query(f"""
    with counts as (select count(*) as n,
        count(*) filter (where price < 1000 or price > 1500) as price,
        count(*) filter (where try_cast(price_text as double) < 1000
          or try_cast(price_text as double) > 1500) as price_text
      from ({DIRTY_PARTS})),
    listed as (select 'price' as column_name, price as v, n from counts
      union all select 'price_text', price_text, n from counts),
    strict as (select sum(v) = 0 as success from listed),
    loose as (select v / n <= 1.0 as success from listed where column_name = 'price')
    select 'strict' as expectation_name, column_name, 'violations' as metric, v::double as value, success from listed, strict
    union all select 'strict', column_name, 'violation_rate', round(v / n, 4), success from listed, strict
    union all select 'loose', column_name, 'violations', v, success from listed, loose where column_name = 'price'
    union all select 'loose', column_name, 'violation_rate', round(v / n, 4), success from listed, loose where column_name = 'price'
""")
def exp_range(spark, sf):
    bounds = {"min": 1000, "max": 1500}
    return observed(
        spark, dirty_parts(spark, sf),
        {"name": "strict", "type": "range", "columns": ["price", "price_text"], "params": bounds},
        {"name": "loose", "type": "range", "columns": ["price"],
         "params": {**bounds, "max_violation_rate": 1.0}},
    )


@query(f"""
    select 'brands' as expectation_name, 'brand' as column_name, 'violation_rate' as metric,
      round(count(*) filter (where brand not in ('Brand#12', 'Brand#13')) / count(brand), 4) as value,
      false as success
    from ({DIRTY_PARTS})
    union all
    select 'segments', 'brand', 'violation_rate', round(count(*) filter (where brand = 'Brand#12') / count(brand), 4),
      count(*) filter (where brand = 'Brand#12') <= 0.2 * count(brand)
    from ({DIRTY_PARTS})
""")
def exp_allowed_values(spark, sf):
    df = dirty_parts(spark, sf)
    others = [f"Brand#{i}" for i in range(1, 26) if i != 12]
    return observed(
        spark, df,
        {"name": "brands", "type": "allowed_values", "columns": ["brand"],
         "params": {"values": ["Brand#12", "Brand#13"]}},
        {"name": "segments", "type": "categorical", "columns": ["brand"],
         "params": {"values": others, "max_violation_rate": 0.2}},
    )


@query("""
    select distinct cast(l_suppkey as varchar) as value from lineitem
    where l_suppkey not in (1, 2, 3) order by value limit 20
""")
def exp_unexpected_top20(spark, sf):
    """The sample an allowed-values rule reports: its first 20 unexpected values."""
    df = table(spark, sf, "lineitem")
    rule = Expectation("suppliers", "allowed_values", ["l_suppkey"], {"values": [1, 2, 3]})
    return unexpected_values(df, allowed_values(df, rule).samples["l_suppkey"])


def _outlier_sql(name: str, column: str, source: str, far: str, stats: str, limit: float) -> str:
    return f"""
    select '{name}' as expectation_name, '{column}' as column_name, metric,
      case metric when 'outliers' then n else round(n / total, 4) end as value,
      n / total <= {limit} as success
    from (select count(*) filter (where {far})::double as n, count(*) as total
          from {source}, (select {stats} from {source})),
      (values ('outliers'), ('outlier_rate')) m(metric)
    """


def _iqr_sql(name: str, column: str, source: str, limit: float) -> str:
    far = f"{column} < q1 - 1.5 * (q3 - q1) or {column} > q3 + 1.5 * (q3 - q1)"
    stats = f"quantile_cont({column}, 0.25) as q1, quantile_cont({column}, 0.75) as q3"
    return _outlier_sql(name, column, source, far, stats, limit)


def _zscore_sql(name: str, column: str, source: str, limit: float) -> str:
    far = f"abs({column} - m) / s > 3"
    return _outlier_sql(name, column, source, far, f"avg({column}) as m, stddev_pop({column}) as s", limit)


@query(_iqr_sql("value", "value", "events", 0.05))
def exp_outliers_iqr(spark, sf):
    rule = {"name": "value", "type": "outliers", "columns": ["value"]}
    return observed(spark, table(spark, sf, "events"), rule)


@query(
    _zscore_sql("value", "value", "events", 0.01)
    + " union all "
    + _zscore_sql("chars", "n_chars", "documents", 0.05)
)
def exp_outliers_zscore(spark, sf):
    params = {"method": "zscore", "max_outlier_rate": 0.01}
    value = {"name": "value", "type": "outliers", "columns": ["value"], "params": params}
    chars = {"name": "chars", "type": "outliers", "columns": ["n_chars"],
             "params": {"method": "zscore"}}
    return observed(spark, table(spark, sf, "events"), value).unionAll(
        observed(spark, table(spark, sf, "documents"), chars)
    )


@query("""
    with age as (select round(epoch_us(timestamp '2024-01-31' - max(ts)) / 3600e6, 2) as hours from events)
    select 'day' as expectation_name, null::varchar as column_name, 'age_hours' as metric, hours as value, hours <= 24 as success from age
    union all select 'day', null, 'max_age_hours', 24.0, hours <= 24 from age
    union all select 'year', null, 'age_hours', hours, true from age
    union all select 'year', null, 'max_age_hours', 8760.0, true from age
""")
def exp_freshness(spark, sf):
    reference = {"reference": "2024-01-31"}
    return observed(
        spark, table(spark, sf, "events"),
        {"name": "day", "type": "freshness", "columns": ["ts"], "params": reference},
        {"name": "year", "type": "freshness", "columns": ["ts"],
         "params": {**reference, "max_age_hours": 8760}},
    )


@query(f"""
    with bad as (select count(*) as total,
        count(*) filter (where not coalesce(price < 1500 and size > 5, false)) as n
      from ({DIRTY_PARTS}))
    select 'cheap' as expectation_name, null::varchar as column_name, 'violations' as metric, n::double as value, false as success from bad
    union all select 'cheap', null, 'violation_rate', round(n / total, 4), false from bad
    union all select 'any', null, 'violations', 0.0, true
    union all select 'any', null, 'violation_rate', 0.0, true
""")
def exp_custom(spark, sf):
    return observed(
        spark, dirty_parts(spark, sf),
        {"name": "cheap", "type": "custom", "params": {"expression": "price < 1500 and size > 5"}},
        {"name": "any", "type": "business_rule", "params": {"expression": "p_partkey >= 0"}},
        {"name": "wrong", "type": "custom", "params": {"expression": "no_such_column > 1"}},
    )


@query("""
    select 'priced' as expectation_name, null::varchar as column_name, 'negative_rows' as metric,
      count(*) filter (where c_acctbal < 0)::double as value, false as success from customer
""")
def exp_registered(spark, sf):
    def expect_credit(df: DataFrame, rule: Expectation) -> ExpectationResult:
        bad = df.where(F.col(rule.columns[0]) < 0).count()
        return ExpectationResult(rule.name, rule.type, bad == 0, observed={"negative_rows": bad})

    register_expectation("credit", expect_credit)
    try:
        rule = {"name": "priced", "type": "credit", "columns": ["c_acctbal"]}
        return observed(spark, table(spark, sf, "customer"), rule)
    finally:
        unregister_expectation("credit")


# -- a rule set on line items ---------------------------------------------------------------

LINE_RULES = RuleSet.of("line_items", [
    {"name": "types", "type": "schema",
     "params": {"columns": {"l_orderkey": "int", "l_quantity": "float", "l_returnflag": "string"}}},
    {"name": "line_key", "type": "primary_key", "columns": KEY, "params": {"primary_key": True}},
    {"name": "quantity", "type": "range", "columns": ["l_quantity"], "params": {"min": 1, "max": 45}},
    {"name": "return_flag", "type": "allowed_values", "columns": ["l_returnflag"],
     "params": {"values": ["A", "N"]}},
    {"name": "discount", "type": "business_rule",
     "params": {"expression": "l_discount <= 0.09", "max_violation_rate": 0.5}},
    {"name": "low_tax", "type": "range", "columns": ["l_tax"], "severity": "warning",
     "params": {"max": 0.07}},
    {"name": "price_outliers", "type": "outliers", "columns": ["l_extendedprice"],
     "severity": "warning"},
    {"name": "shipped", "type": "freshness", "columns": ["l_shipdate"], "severity": "warning",
     "params": {"reference": "1970-01-01"}},
], dataset="lineitem")

MARKED = f"""
    select *, concat_ws(',',
      case when rn > 1 then 'line_key' end,
      case when l_quantity < 1 or l_quantity > 45 then 'quantity' end,
      case when l_returnflag not in ('A', 'N') then 'return_flag' end,
      case when not l_discount <= 0.09 then 'discount' end) as broken
    from (select *, row_number() over (
        partition by {", ".join(KEY)} order by {", ".join(ORDER)}) as rn from lineitem)
"""
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
LINES = ", ".join(LINE_COLUMNS)

VERDICTS = """
    select 'types' as expectation_name, 'schema' as expectation_type, 'error' as severity, true as success
    union all select 'line_key', 'primary_key', 'error', count(*) = count(distinct (l_orderkey, l_linenumber)) from lineitem
    union all select 'quantity', 'range', 'error', count(*) filter (where l_quantity < 1 or l_quantity > 45) = 0 from lineitem
    union all select 'return_flag', 'allowed_values', 'error', count(*) filter (where l_returnflag not in ('A', 'N')) = 0 from lineitem
    union all select 'discount', 'business_rule', 'error', count(*) filter (where l_discount > 0.09) <= 0.5 * count(*) from lineitem
    union all select 'low_tax', 'range', 'warning', count(*) filter (where l_tax > 0.07) = 0 from lineitem
    union all select 'price_outliers', 'outliers', 'warning',
      count(*) filter (where l_extendedprice < q1 - 1.5 * (q3 - q1) or l_extendedprice > q3 + 1.5 * (q3 - q1)) <= 0.05 * count(*)
      from lineitem, (select quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.75) as q3 from lineitem)
    union all select 'shipped', 'freshness', 'warning', max(l_shipdate) + interval 24 hours >= timestamp '1970-01-01' from lineitem
"""


def line_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem", row_id=True)


def split_lines(spark: SparkSession, sf: str) -> Split:
    return split(line_items(spark, sf), LINE_RULES, ORDER)


#: Two rules that cannot be evaluated, and one whose set holds a truth value among numbers.
ODD_RULES = RuleSet.of("odd", [
    {"name": "no columns", "type": "unique"},
    {"name": "no time", "type": "freshness", "columns": ["l_shipdate"], "params": {"reference": "garbage"}},
    {"name": "mixed set", "type": "allowed_values", "columns": ["l_linenumber"],
     "params": {"values": [True, 2, 3, 4, 5, 6, 7]}},
])


@query(f"""
    {VERDICTS}
    union all select 'no columns', 'unique', 'error', false
    union all select 'no time', 'freshness', 'error', false
    union all select 'mixed set', 'allowed_values', 'error', count(*) filter (where l_linenumber not in (1, 2, 3, 4, 5, 6, 7)) = 0
      from lineitem
""")
def validate_rule_set(spark, sf):
    rules = replace(LINE_RULES, expectations=[*LINE_RULES.expectations, *ODD_RULES.expectations])
    report = validate(table(spark, sf, "lineitem"), rules)
    return report.to_df(spark).select(
        "expectation_name", "expectation_type", "severity", "success"
    )


@query(f"""
    select 'lineitem' as dataset, 'line_items' as rule_set, count(*) as total,
      count(*) filter (where success) as passed, count(*) filter (where not success) as failed,
      count(*) filter (where not success and severity = 'error') as error_failures,
      count(*) filter (where not success and severity = 'warning') as warning_failures,
      round(count(*) filter (where success) / count(*), 4) as score
    from ({VERDICTS})
""")
def quality_score(spark, sf):
    return score_rows(validate(table(spark, sf, "lineitem"), LINE_RULES).to_df(spark))


@query(f"select {LINES} from ({MARKED}) where broken = ''")
def split_valid(spark, sf):
    return split_lines(spark, sf).valid.select(*LINE_COLUMNS)


@query(f"""
    select {LINES}, broken from ({MARKED}) where broken <> ''
""")
def split_quarantined(spark, sf):
    broken = F.concat_ws(",", "_violations").alias("broken")
    return split_lines(spark, sf).quarantined.select(*LINE_COLUMNS, broken)


@query(f"""
    select unnest(string_split(broken, ',')) as expectation_name, count(*) as violations
    from ({MARKED}) where broken <> '' group by 1
""")
def violations_by_rule(spark, sf):
    return count_violations(split_lines(spark, sf).annotated)


# -- quarantine -----------------------------------------------------------------------------


def _quarantined(spark: SparkSession, sf: str) -> str:
    root = fresh_path(spark, "quarantine")
    rows = split_lines(spark, sf).quarantined.drop(ROW)
    store_quarantine(rows, root, "retail", "lines", "run-1", AT)
    return root


@query(f"""
    select {LINES}, broken as _quarantine_reason,
      epoch_us(timestamp '{AT}') as quarantined_us, 'retail' as _pipeline, 'lines' as _stage,
      'run-1' as _run_id
    from ({MARKED}) where broken <> ''
""")
def quarantine_rows(spark, sf):
    rows = spark.read.parquet(_quarantined(spark, sf))
    at = F.unix_micros("_quarantined_at").alias("quarantined_us")
    return rows.select(*LINE_COLUMNS, "_quarantine_reason", at, "_pipeline", "_stage", "_run_id")


@query(f"""
    select 'retail' as pipeline_name, 'lines' as stage_name, 'run-1' as run_id, count(*) as row_count
    from ({MARKED}) where broken <> ''
""")
def quarantine_summary(spark, sf):
    return summarise_quarantine(spark, _quarantined(spark, sf))


SAMPLE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query(f"""
    select {LINES} from ({MARKED}) where broken <> '' order by {", ".join(SAMPLE_ORDER)} limit 200
""")
def quarantine_sample(spark, sf):
    root = _quarantined(spark, sf)
    found = sample_quarantine(spark, root, "retail", "lines", "run-1", order_by=SAMPLE_ORDER)
    return found.select(*LINE_COLUMNS)


# -- stages ---------------------------------------------------------------------------------


def fresh_places(spark: SparkSession) -> Places:
    base = fresh_path(spark, "stage")
    return Places(f"{base}/warehouse", f"{base}/quarantine", f"{base}/history")


def line_source(sf: str) -> Source:
    return Source("lineitem", "parquet", {"path": f"{sf}/lineitem.parquet"})


def line_stage(sf: str, *extra: dict) -> Stage:
    steps = [
        step("derive", column="revenue", expression="l_extendedprice * (1 - l_discount)"),
        *extra,
    ]
    return Stage("lines", line_source(sf), LINE_RULES, steps, order_by=ORDER)


BY_FLAG = [
    step("aggregate", group_by=["l_returnflag"],
         aggregations={"revenue": "sum", "l_quantity": ["sum", "count"]}),
    step("derive", column="revenue", expression="round(revenue, 2)"),
]


@query(f"""
    select l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue,
      sum(l_quantity) as l_quantity_sum, count(l_quantity) as l_quantity_count
    from ({MARKED}) where broken = '' group by l_returnflag
""")
def stage_end_to_end(spark, sf):
    """Check line items, quarantine bad ones, derive revenue, aggregate and load."""
    places = fresh_places(spark)
    run_stage(spark, line_stage(sf, *BY_FLAG), places, run_id="run-1")
    return Table(spark, f"{places.warehouse}/lines").read()


def run_with_history(spark: SparkSession, sf: str) -> History:
    places = fresh_places(spark)
    run_stage(spark, line_stage(sf), places, "retail", run_id="run-1")
    return History(spark, places.history)


@query(f"""
    with duplicates as (select coalesce(sum(n), 0) as n from (
      select count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1)),
    counted as (select count(*) filter (where l_quantity < 1 or l_quantity > 45) as quantity,
      count(*) filter (where l_discount > 0.09) as discount, count(*) filter (where l_tax > 0.07) as low_tax from lineitem),
    texts(expectation_type, good, bad) as (values ('schema', 'Schema valid', 'Schema validation failed'),
      ('primary_key', 'Values unique', 'Found ' || (select n from duplicates) || ' duplicate rows'),
      ('range', 'Values within range', 'Range violations exceeded threshold'),
      ('allowed_values', 'Categorical values valid', 'Unexpected categorical values found'),
      ('business_rule', 'Business rule satisfied', 'Business rule violated'),
      ('outliers', 'Outliers within threshold', 'Outlier rate exceeded threshold'),
      ('freshness', 'Data is fresh', 'Data is stale'))
    select 'run-1' as run_id, 'lines' as stage_name, 'lines' as dataset, 'line_items' as rule_set,
      expectation_name, expectation_type, severity, success, if(success, good, bad) as message,
      case expectation_name when 'quantity' then quantity when 'discount' then discount when 'low_tax' then low_tax
        when 'line_key' then (select n from duplicates) end::bigint as observed
    from ({VERDICTS}) join texts using (expectation_type), counted
""")
def quality_metrics_rows(spark, sf):
    places = {"quantity": "$.l_quantity.violations", "discount": "$.violations",
              "low_tax": "$.l_tax.violations", "line_key": "$.duplicate_rows"}
    numbers = [F.when(F.col("expectation_name") == n, F.get_json_object("observed", p)) for n, p in places.items()]
    return run_with_history(spark, sf).table("quality_metrics").select(
        "run_id", "stage_name", "dataset", "rule_set", "expectation_name", "expectation_type",
        "severity", "success", "message", F.coalesce(*numbers).cast("bigint").alias("observed"),
    )


@query(f"""
    select 'run-1' as run_id, 'lines' as stage_name, 'success' as status, 'full' as load_strategy,
      'lines' as target_table, count(*) as rows_extracted,
      count(*) filter (where broken = '') as rows_loaded,
      count(*) filter (where broken <> '') as rows_quarantined
    from ({MARKED})
""")
def stage_rows(spark, sf):
    return run_with_history(spark, sf).table("stage_runs").select(
        "run_id", "stage_name", "status", "load_strategy", "target_table", "rows_extracted",
        "rows_loaded", "rows_quarantined",
    )


@query("""
    select distinct 'run-1' as run_id, 'retail' as pipeline_name, 'lines' as stage_name,
      'lineitem' as source_name, 'parquet' as source_type, 'lines' as target_table from lineitem
""")
def lineage_rows(spark, sf):
    return run_with_history(spark, sf).table("lineage").select(
        "run_id", "pipeline_name", "stage_name", "source_name", "source_type", "target_table"
    )


# -- the retail star ------------------------------------------------------------------------

PARTS = [
    "p_partkey as `product-id`",
    "p_name as productName",
    "case when p_partkey % 29 = 0 then null else p_type end as category",
    "case when p_partkey % 50 = 0 then cast(-p_retailprice as string) "
    "when p_partkey % 70 = 0 then 'n/a' else cast(p_retailprice as string) end as unitPrice",
]
PRODUCT_RULES = RuleSet.of("parts on offer", [
    {"name": "one row a part", "type": "primary_key", "columns": ["product-id"],
     "params": {"primary_key": True}},
    {"name": "named", "type": "not_null", "columns": ["productName"]},
    {"name": "typed", "type": "not_null", "columns": ["category"], "severity": "warning"},
    {"name": "retail price", "type": "range", "columns": ["unitPrice"], "params": {"min": 1, "max": 5000}},
])
CUSTOMER_RULES = RuleSet.of("buyers outside building", [
    {"name": "one row a buyer", "type": "primary_key", "columns": ["customer_id"],
     "params": {"primary_key": True}},
    {"name": "market segment given", "type": "not_null", "columns": ["segment"]},
    {"name": "market segment served", "type": "allowed_values", "columns": ["segment"],
     "params": {"values": ["AUTOMOBILE", "MACHINERY", "HOUSEHOLD"]}},
    {"name": "not in debt", "type": "range", "columns": ["balance"], "severity": "warning",
     "params": {"min": 0}},
])
SALES_RULES = RuleSet.of("sales", [
    {"name": "line_key", "type": "primary_key", "columns": KEY, "params": {"primary_key": True}},
    {"name": "quantity", "type": "range", "columns": ["l_quantity"], "params": {"min": 2, "max": 49}},
    {"name": "consistent", "type": "business_rule", "severity": "warning",
     "params": {"expression": "abs(l_extendedprice - l_quantity) > 0.01"}},
])
INVENTORY_RULES = RuleSet.of("parts by supplier", [
    {"name": "first line of part and supplier", "type": "unique", "columns": ["l_partkey", "l_suppkey"]},
    {"name": "counted", "type": "not_null", "columns": ["on_hand"]},
    {"name": "not below nothing", "type": "range", "columns": ["on_hand"], "params": {"min": 0}},
])


def star(spark: SparkSession, sf: str, wanted: str) -> DataFrame:
    """Run the stages the wanted table needs, and read the table."""
    products = Stage(
        "products",
        table(spark, sf, "part").selectExpr(*PARTS),
        PRODUCT_RULES,
        [step("rename_lower"), step("cast", columns={"unit_price": "float"}),
         step("drop_duplicates", subset=["product_id"], keep="first")],
        target_table="dim_product",
    )
    customers = Stage(
        "customers",
        table(spark, sf, "customer").selectExpr(
            "c_custkey as customer_id", "nullif(c_mktsegment, 'BUILDING') as segment",
            "case when c_custkey % 17 = 0 then 'none' else cast(c_acctbal as string) end as balance",
        ),
        CUSTOMER_RULES,
        [step("cast", columns={"balance": "float"})],
        target_table="dim_customer",
    )
    inventory = Stage(
        "inventory",
        line_items(spark, sf).selectExpr(
            "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate",
            "case when l_orderkey % 31 = 0 then null when l_orderkey % 37 = 0 then -l_quantity "
            "else l_quantity + 0.5 end as on_hand", ROW,
        ),
        INVENTORY_RULES,
        [step("cast", columns={"on_hand": "int"})],
        target_table="fact_inventory",
        depends_on=["products"],
        order_by=["l_orderkey", "l_linenumber", "l_shipdate", "on_hand"],
    )
    sales = Stage(
        "transactions",
        line_source(sf),
        SALES_RULES,
        [step("derive", column="revenue", expression="round(l_quantity * l_extendedprice, 4)")],
        target_table="fact_sales",
        load_strategy="incremental",
        incremental_key="l_orderkey",
        depends_on=["products"],
        order_by=ORDER,
    )
    needed = {
        "dim_product": [products],
        "dim_customer": [customers],
        "fact_inventory": [products, inventory],
        "fact_sales": [products, sales],
    }[wanted]
    places = fresh_places(spark)
    result = run_pipeline(spark, "retail", needed, places)
    if result.status != "success":
        raise RuntimeError(f"{[s.error for s in result.stages]}")
    return Table(spark, f"{places.warehouse}/{wanted}").read()


@query("""
    select p_partkey as product_id, p_name as product_name,
      case when p_partkey % 29 = 0 then null else p_type end as category,
      case when p_partkey % 70 = 0 then null else p_retailprice end as unit_price
    from part where p_partkey % 50 <> 0
""")
def star_dim_product(spark, sf):
    return star(spark, sf, "dim_product")


@query("""
    select c_custkey as customer_id, c_mktsegment as segment,
      case when c_custkey % 17 = 0 then null else c_acctbal end as balance
    from customer where c_mktsegment in ('AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD')
""")
def star_dim_customer(spark, sf):
    return star(spark, sf, "dim_customer")


@query("""
    with stock as (select l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate,
        case when l_orderkey % 31 = 0 then null when l_orderkey % 37 = 0 then -l_quantity
             else l_quantity + 0.5::double end as on_hand from lineitem),
    ranked as (select *, row_number() over (partition by l_partkey, l_suppkey
        order by l_orderkey, l_linenumber, l_shipdate, on_hand nulls first) as rn from stock)
    select l_partkey, l_suppkey, l_orderkey, l_linenumber,
      cast(round_even(on_hand, 0) as bigint) as on_hand
    from ranked where rn = 1 and on_hand >= 0
""")
def star_fact_inventory(spark, sf):
    return star(spark, sf, "fact_inventory").drop("l_shipdate")


@query(f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
      round(l_quantity * l_extendedprice, 4) as revenue
    from ({MARKED}) where rn = 1 and l_quantity between 2 and 49
""")
def star_fact_sales(spark, sf):
    return star(spark, sf, "fact_sales").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "revenue",
    )
