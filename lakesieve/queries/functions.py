"""Expressions rule authors write, and the scalar functions of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json_path import json_text_at
from ..functions.naming import snake_case_text
from ..operators.transforms import apply_steps
from ..plans import alerts
from ..plans.history import schema_snapshot as snapshot_of
from .base import query, table


def derived(df: DataFrame, keep: list[str], **expressions: str) -> DataFrame:
    """Keep some columns and add derived ones through the transform step."""
    steps = [
        {"type": "derive", "params": {"column": name, "expression": e}}
        for name, e in expressions.items()
    ]
    return apply_steps(df, steps).select(*keep, *expressions)


@query("""
    select p_partkey, round(p_retailprice + p_size, 4) as plus, round(p_retailprice - p_size, 4) as minus,
      round(p_retailprice * p_size, 4) as times, -p_size as negative, power(p_size, 2) as squared
    from part
""")
def fn_arithmetic(spark, sf):
    return derived(
        table(spark, sf, "part"), ["p_partkey"],
        plus="round(p_retailprice + p_size, 4)", minus="round(p_retailprice - p_size, 4)",
        times="round(p_retailprice * p_size, 4)", negative="-p_size",
        squared="power(p_size, 2)",
    )


@query("""
    select p_partkey, round(p_retailprice / nullif(p_size - 10, 0), 6) as quotient,
      cast(floor((p_size - 10) / 3.0) as bigint) as whole,
      (p_size - 10) % 3 + case when (p_size - 10) % 3 < 0 then 3 else 0 end as remainder
    from part
""")
def fn_division(spark, sf):
    return derived(
        table(spark, sf, "part"), ["p_partkey"],
        quotient="round(try_divide(p_retailprice, p_size - 10), 6)",
        whole="floor(try_divide(p_size - 10, 3))",
        remainder="pmod(p_size - 10, 3)",
    )


@query("""
    select p_partkey, p_size < 20 as lt, p_size <= 20 as le, p_size > 20 as gt, p_size >= 20 as ge,
      p_size = 20 as eq, p_size <> 20 as ne, 10 < p_size and p_size < 30 as chained
    from part
""")
def fn_compare(spark, sf):
    return derived(
        table(spark, sf, "part"), ["p_partkey"],
        lt="p_size < 20", le="p_size <= 20", gt="p_size > 20", ge="p_size >= 20",
        eq="p_size == 20", ne="p_size != 20", chained="10 < p_size and p_size < 30",
    )


@query("""
    select p_partkey, p_size > 10 and p_retailprice > 1200 as both, p_size > 10 or p_retailprice > 1200 as either,
      not p_size > 10 as neither
    from part
""")
def fn_boolean(spark, sf):
    return derived(
        table(spark, sf, "part"), ["p_partkey"],
        both="p_size > 10 and p_retailprice > 1200",
        either="p_size > 10 or p_retailprice > 1200", neither="not p_size > 10",
    )


@query("""
    select p_partkey, p_size in (1, 5, 9) as inside, p_size not in (1, 5, 9) as outside,
      coalesce(nullif(p_brand, 'Brand#11') in ('Brand#11', 'Brand#12'), false) as known
    from part
""")
def fn_membership(spark, sf):
    return derived(
        table(spark, sf, "part"), ["p_partkey"],
        inside="p_size in (1, 5, 9)", outside="p_size not in (1, 5, 9)",
        known="coalesce(nullif(p_brand, 'Brand#11') in ('Brand#11', 'Brand#12'), false)",
    )


@query("""
    select p_partkey, abs(p_size - 25) as absolute, round(sqrt(p_retailprice), 6) as root,
      round(exp(p_size / 10.0::double), 6) as e, round(exp(p_size / 100.0::double) - 1, 6) as em1,
      round(ln(p_retailprice), 6) as l, round(ln(1 + p_size::double), 6) as l1p,
      round(log10(p_retailprice), 6) as l10,
      cast(floor(p_retailprice) as bigint) as down, cast(ceil(p_retailprice) as bigint) as up
    from part
""")
def fn_math(spark, sf):
    return derived(
        table(spark, sf, "part"), ["p_partkey"],
        absolute="abs(p_size - 25)", root="round(sqrt(p_retailprice), 6)",
        e="round(exp(p_size / 10), 6)", em1="round(expm1(p_size / 100), 6)",
        l="round(ln(p_retailprice), 6)", l1p="round(log1p(p_size), 6)",
        l10="round(log10(p_retailprice), 6)",
        down="floor(p_retailprice)", up="ceil(p_retailprice)",
    )


@query("""
    select p_partkey, round(sin(p_size::double), 8) as s, round(cos(p_size::double), 8) as c,
      round(asin(p_size / 100.0::double), 8) as a_s, round(acos(p_size / 100.0::double), 8) as a_c,
      round(atan(p_size::double), 8) as a_t, round(atan2(p_size::double, 3.0::double), 8) as a_t2,
      round(sinh(p_size / 10.0::double), 6) as s_h, round(cosh(p_size / 10.0::double), 6) as c_h,
      round(tanh(p_size / 10.0::double), 8) as t_h, round(asinh(p_size::double), 8) as as_h,
      round(acosh(p_size + 1.0::double), 8) as ac_h, round(atanh(p_size / 100.0::double), 8) as at_h
    from part
""")
def fn_trig(spark, sf):
    return derived(
        table(spark, sf, "part"), ["p_partkey"],
        s="round(sin(p_size), 8)", c="round(cos(p_size), 8)",
        a_s="round(asin(p_size / 100), 8)", a_c="round(acos(p_size / 100), 8)",
        a_t="round(atan(p_size), 8)", a_t2="round(atan2(p_size, 3), 8)",
        s_h="round(sinh(p_size / 10), 6)", c_h="round(cosh(p_size / 10), 6)",
        t_h="round(tanh(p_size / 10), 8)", as_h="round(asinh(p_size), 8)",
        ac_h="round(acosh(p_size + 1), 8)", at_h="round(atanh(p_size / 100), 8)",
    )


@query("""
    select doc_id, regexp_matches(text, '[0-9]{3}') as has_digits, starts_with(text, 'T') as begins,
      suffix(text, '.') as finishes, length(text) as n, md5(lower(text)) as lowered,
      md5(upper(source)) as raised, trim('  ' || lang || ' ') as stripped,
      regexp_matches(text, '^[A-Z]') as capital
    from documents
""")
def fn_string(spark, sf):
    return derived(
        table(spark, sf, "documents"), ["doc_id"],
        has_digits="text rlike '[0-9]{3}'", begins="startswith(text, 'T')",
        finishes="endswith(text, '.')", n="cast(length(text) as bigint)",
        lowered="md5(cast(lower(text) as binary))", raised="md5(cast(upper(source) as binary))",
        stripped="trim(concat('  ', lang, ' '))", capital="text rlike '^[A-Z]'",
    )


@query("""
    select c_custkey, nullif(c_mktsegment, 'BUILDING') is null as missing,
      nullif(c_mktsegment, 'BUILDING') is not null as present, c_acctbal between 0 and 5000 as inside
    from customer
""")
def fn_null_between(spark, sf):
    return derived(
        table(spark, sf, "customer"), ["c_custkey"],
        missing="nullif(c_mktsegment, 'BUILDING') is null",
        present="nullif(c_mktsegment, 'BUILDING') is not null",
        inside="c_acctbal between 0 and 5000",
    )


@query("""
    select event_id, cast(year(ts) as int) as y, cast(month(ts) as int) as m, cast(day(ts) as int) as d,
      cast(hour(ts) as int) as h, cast(isodow(ts) - 1 as int) as dow
    from events
""")
def fn_date(spark, sf):
    return derived(
        table(spark, sf, "events"), ["event_id"],
        y="year(ts)", m="month(ts)", d="day(ts)", h="hour(ts)", dow="weekday(ts)",
    )


@query(r"""
    select p_partkey, lower(regexp_replace(regexp_replace(trim(
      'Part-' || p_brand || ' unitPrice ' || p_type), '[\s-]+', '_', 'g'),
      '([a-z0-9])([A-Z])', '\1_\2', 'g')) as name
    from part
""")
def fn_snake_case(spark, sf):
    text = F.concat(F.lit(" Part-"), "p_brand", F.lit(" unitPrice "), "p_type", F.lit("\t "))
    return table(spark, sf, "part").select("p_partkey", snake_case_text(text).alias("name"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def fn_json_path(spark, sf):
    k = json_text_at(F.col("props"), "k").try_cast("bigint")
    return table(spark, sf, "events").select("event_id", k.alias("k"))


# -- alert functions ------------------------------------------------------------------------

SEVERITY = (
    "case event_type when 'error' then 'critical' when 'purchase' then 'warning' "
    "when 'signup' then 'error' when 'click' then 'info' else 'strange' end"
)


def event_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Events as alerts: keyed by type and user."""
    return table(spark, sf, "events").selectExpr(
        "event_id", "concat(event_type, ':', user_id) as key", f"{SEVERITY} as severity", "ts"
    )


EVENT_ALERTS = f"""
    select event_id, event_type || ':' || user_id as key, {SEVERITY} as severity, ts from events
"""


@query(f"""
    select event_id, key || ':' || substr(sha1(key || '|' || severity), 1, 16) as alert_key
    from ({EVENT_ALERTS})
""")
def alert_dedup_key(spark, sf):
    df = event_alerts(spark, sf)
    return df.select(
        "event_id", alerts.dedup_key(F.col("key"), F.col("severity")).alias("alert_key")
    )


@query(f"""
    select event_id, severity from ({EVENT_ALERTS}) where severity in ('error', 'critical', 'strange')
""")
def alert_threshold(spark, sf):
    return alerts.above_threshold(event_alerts(spark, sf), "error").select("event_id", "severity")


@query("""
    with types as (select table_name, column_name, data_type from (values
        ('orders', 'o_orderkey', 'bigint'), ('orders', 'o_custkey', 'bigint'),
        ('orders', 'o_orderstatus', 'string'), ('orders', 'o_totalprice', 'double'),
        ('orders', 'o_orderdate', 'timestamp_ntz'), ('orders', 'o_orderpriority', 'string')
      ) v(table_name, column_name, data_type))
    select o_orderstatus as dataset, column_name, data_type, count(*) as rows
    from orders, types group by all
""")
def schema_snapshot(spark, sf):
    """The snapshot of orders, per order status, with the rows it describes."""
    df = table(spark, sf, "orders")
    pairs = F.create_map(*[F.lit(x) for pair in snapshot_of(df).items() for x in pair])
    counted = df.groupBy(F.col("o_orderstatus").alias("dataset")).agg(F.count("*").alias("rows"))
    return counted.select("dataset", "rows", F.explode(pairs).alias("column_name", "data_type"))
