"""Transform steps, row predicates and aggregation on the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import RuleSet
from ..operators.transforms import STEPS, apply_steps, register_transform
from ..operators.uniqueness import first_of_duplicates, flag_later_copies
from ..operators.validate import compile_row_rules
from .base import query, table


def step(kind: str, **params) -> dict:
    return {"type": kind, "params": params}


def dirty_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with unreadable numbers, odd flags and gaps, made by fixed expressions."""
    return table(spark, sf, "part").selectExpr(
        "p_partkey",
        "case when p_partkey % 50 = 0 then 'n/a' when p_partkey % 50 = 1 then null "
        "else cast(p_size as string) end as size_text",
        "case when p_partkey % 40 = 0 then 'unknown' else cast(p_retailprice as string) end "
        "as price_text",
        "p_size + 0.5 as half",
        "case when p_partkey % 30 = 0 then 'someday' else concat('2024-01-', "
        "lpad(cast(p_partkey % 28 + 1 as string), 2, '0')) end as day_text",
        "cast(p_partkey % 2 as int) as flag",
        "nullif(p_size, 10) as size",
        "nullif(p_brand, 'Brand#11') as brand",
        "case when p_partkey % 9 = 0 then double('nan') else p_retailprice end as price",
    )


DIRTY_PARTS = """
    select p_partkey,
      case when p_partkey % 50 = 0 then 'n/a' when p_partkey % 50 = 1 then null
           else cast(p_size as varchar) end as size_text,
      case when p_partkey % 40 = 0 then 'unknown' else cast(p_retailprice as varchar) end
        as price_text,
      p_size + 0.5::double as half,
      case when p_partkey % 30 = 0 then 'someday' else '2024-01-' ||
        lpad(cast(p_partkey % 28 + 1 as varchar), 2, '0') end as day_text,
      cast(p_partkey % 2 as int) as flag,
      nullif(p_size, 10) as size,
      nullif(p_brand, 'Brand#11') as brand,
      case when p_partkey % 9 = 0 then null else p_retailprice end as price
    from part
"""


@query("select p_partkey as product_id, p_name as name, p_size from part")
def tf_rename(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    names = {"p_partkey": "product_id", "p_name": "name", "absent": "x"}
    return apply_steps(df, [step("rename", columns=names)])


@query('select p_partkey as part_key, p_name as part_name, p_size as unit_size from part')
def tf_rename_lower(spark, sf):
    df = table(spark, sf, "part").selectExpr(
        "p_partkey as partKey", "p_name as ` Part-Name`", "p_size as `Unit  Size`"
    )
    return apply_steps(df, [step("rename_lower")])


@query(f"""
    select p_partkey, cast(try_cast(size_text as double) as bigint) as size_text,
      cast(round_even(half, 0) as bigint) as half
    from ({DIRTY_PARTS})
""")
def tf_cast_int(spark, sf):
    df = dirty_parts(spark, sf).select("p_partkey", "size_text", "half")
    return apply_steps(df, [step("cast", columns={"size_text": "int", "half": "int", "x": "int"})])


@query(f"select p_partkey, try_cast(price_text as double) as price_text from ({DIRTY_PARTS})")
def tf_cast_float(spark, sf):
    df = dirty_parts(spark, sf).select("p_partkey", "price_text")
    return apply_steps(df, [step("cast", columns={"price_text": "float"})])


@query(f"""
    select p_partkey, epoch_us(try_cast(day_text as timestamp)) as micros from ({DIRTY_PARTS})
""")
def tf_cast_datetime(spark, sf):
    df = dirty_parts(spark, sf).select("p_partkey", "day_text")
    steps = [
        step("cast", columns={"day_text": "datetime"}),
        step("derive", column="micros", expression="unix_micros(day_text)"),
        step("drop_columns", columns=["day_text"]),
    ]
    return apply_steps(df, steps)


@query("select cast(p_partkey as varchar) as p_partkey, cast(p_size as varchar) as p_size from part")
def tf_cast_string(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size")
    return apply_steps(df, [step("cast", columns={"p_partkey": "str", "p_size": "string"})])


@query(f"select p_partkey, flag = 1 as flag from ({DIRTY_PARTS})")
def tf_cast_bool(spark, sf):
    df = dirty_parts(spark, sf).select("p_partkey", "flag")
    return apply_steps(df, [step("cast", columns={"flag": "bool"})])


@query("""
    select l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) as revenue
    from lineitem
""")
def tf_derive(spark, sf):
    df = table(spark, sf, "lineitem")
    revenue = "round(l_extendedprice * (1 - l_discount), 4)"
    return apply_steps(df, [step("derive", column="revenue", expression=revenue)]).select(
        "l_orderkey", "l_linenumber", "revenue"
    )


@query("select p_partkey, p_name, p_brand, p_type from part")
def tf_drop_columns(spark, sf):
    df = table(spark, sf, "part")
    return apply_steps(df, [step("drop_columns", columns=["p_size", "p_retailprice", "absent"])])


@query("select p_partkey, 'retail' as src, 7 as batch from part")
def tf_add_constant(spark, sf):
    df = table(spark, sf, "part").select("p_partkey")
    steps = [
        step("add_constant", column="src", value="retail"),
        step("add_constant", column="batch", value=7),
    ]
    return apply_steps(df, steps)


@query(f"""
    select p_partkey, coalesce(size, 0) as size, coalesce(brand, 'none') as brand,
      coalesce(price, -1.0) as price
    from ({DIRTY_PARTS})
""")
def tf_fillna_map(spark, sf):
    df = dirty_parts(spark, sf).select("p_partkey", "size", "brand", "price")
    values = {"size": 0, "brand": "none", "price": -1.0, "absent": 1}
    return apply_steps(df, [step("fillna", values=values)])


@query(f"""
    select p_partkey, coalesce(size, 0) as size, brand, coalesce(price, 0) as price
    from ({DIRTY_PARTS})
""")
def tf_fillna_value(spark, sf):
    df = dirty_parts(spark, sf).select("p_partkey", "size", "brand", "price")
    return apply_steps(df, [step("fillna", value=0)])


@query("""
    select l_orderkey, l_linenumber, l_quantity from lineitem
    where l_quantity > 30 and l_returnflag = 'R' and l_discount between 0.02 and 0.05
""")
def tf_filter(spark, sf):
    keep = "l_quantity > 30 and l_returnflag = 'R' and l_discount between 0.02 and 0.05"
    df = apply_steps(table(spark, sf, "lineitem"), [step("filter", expression=keep)])
    return df.select("l_orderkey", "l_linenumber", "l_quantity")


@query("""
    select l_orderkey, round(sum(l_extendedprice), 2) as l_extendedprice, 'x' as mark
    from lineitem where l_quantity >= 10 group by l_orderkey
""")
def tf_registered(spark, sf):
    def mark(df: DataFrame, params) -> DataFrame:
        return df.withColumn("mark", F.lit(params["text"]))

    register_transform("mark", mark)
    try:
        return apply_steps(
            table(spark, sf, "lineitem"),
            [
                step("filter", expression="l_quantity >= 10"),
                step("aggregate", group_by=["l_orderkey"], aggregations={"l_extendedprice": "sum"}),
                step("derive", column="l_extendedprice", expression="round(l_extendedprice, 2)"),
                step("mark", text="x"),
            ],
        )
    finally:
        del STEPS["mark"]


# -- duplicates -----------------------------------------------------------------------------

ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]
KEY = ["l_orderkey", "l_linenumber"]
RANKED = f"""
    select *, row_number() over (partition by {", ".join(KEY)} order by {", ".join(ORDER)}) as rn,
      row_number() over (partition by {", ".join(KEY)} order by {" desc, ".join(ORDER)} desc) as rd,
      count(*) over (partition by {", ".join(KEY)}) as n
    from lineitem
"""
PICKED = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


def _deduplicated(spark, sf, keep):
    df = table(spark, sf, "lineitem")
    steps = [step("drop_duplicates", subset=KEY, keep=keep, order_by=ORDER)]
    return apply_steps(df, steps).select(*PICKED.split(", "))


@query(f"select {PICKED} from ({RANKED}) where rn = 1")
def tf_dedup_first(spark, sf):
    return _deduplicated(spark, sf, "first")


@query(f"select {PICKED} from ({RANKED}) where rd = 1")
def tf_dedup_last(spark, sf):
    return _deduplicated(spark, sf, "last")


@query(f"select {PICKED} from ({RANKED}) where n = 1")
def tf_dedup_none(spark, sf):
    return _deduplicated(spark, sf, False)


@query(f"select {PICKED}, rn > 1 as violated from ({RANKED})")
def viol_duplicate(spark, sf):
    df = table(spark, sf, "lineitem", row_id=True)
    firsts = first_of_duplicates(df, KEY, ORDER)
    flagged = flag_later_copies(df, firsts, KEY, "violated")
    return flagged.select(*PICKED.split(", "), "violated")


# -- row predicates -------------------------------------------------------------------------


def violated(df: DataFrame, **rule) -> DataFrame:
    """``df`` with the rule's row predicate."""
    rules = RuleSet.of("rows", [{"name": "rule", **rule}])
    _, check = compile_row_rules(df, rules)[0]
    return df.withColumn("violated", check.violation)


@query(f"select p_partkey, price is null or brand is null as violated from ({DIRTY_PARTS})")
def viol_not_null(spark, sf):
    df = dirty_parts(spark, sf)
    return violated(df, type="not_null", columns=["price", "brand", "absent"]).select(
        "p_partkey", "violated"
    )


@query(f"""
    select p_partkey, coalesce(price < 1000 or price > 1500, false)
      or coalesce(try_cast(price_text as double) not between 1000 and 1500, false) as violated
    from ({DIRTY_PARTS})
""")
def viol_range(spark, sf):
    df = dirty_parts(spark, sf)
    rule = {"type": "range", "columns": ["price", "price_text"],
            "params": {"min": 1000, "max": 1500}}
    return violated(df, **rule).select("p_partkey", "violated")


@query(f"""
    select p_partkey, (brand is not null and brand not in ('Brand#12', 'Brand#13'))
      or (size is not null and size not in (1, 2, 3)) as violated
    from ({DIRTY_PARTS})
""")
def viol_allowed_values(spark, sf):
    values = ["Brand#12", "Brand#13", 1, 2, 3]
    df = dirty_parts(spark, sf)
    rule = {"type": "allowed_values", "columns": ["brand", "size"], "params": {"values": values}}
    return violated(df, **rule).select("p_partkey", "violated")


@query(f"""
    select p_partkey, not coalesce(price < 1500 and size > 5, false) as violated
    from ({DIRTY_PARTS})
""")
def viol_custom(spark, sf):
    df = dirty_parts(spark, sf).withColumn("price", F.expr("nanvl(price, null)"))
    rule = {"type": "custom", "params": {"expression": "price < 1500 and size > 5"}}
    return violated(df, **rule).select("p_partkey", "violated")


@query(f"select p_partkey, size is null or price is null as violated from ({DIRTY_PARTS})")
def viol_primary_key(spark, sf):
    df = dirty_parts(spark, sf)
    rule = {"type": "primary_key", "columns": ["size", "price"], "params": {"primary_key": True}}
    return violated(df, **rule).select("p_partkey", "violated")


# -- aggregation ----------------------------------------------------------------------------


def _grouped(spark, sf, by, digits=None, **aggregations):
    """Aggregate line items with gaps; round the named results."""
    df = table(spark, sf, "lineitem").withColumns(
        {
            "l_linestatus": F.expr("nullif(l_linestatus, 'X')"),
            "l_returnflag": F.expr("case when l_orderkey % 13 = 0 then null else l_returnflag end"),
            "l_tax": F.expr("case when l_quantity = 7 then double('nan') else l_tax end"),
        }
    )
    result = apply_steps(df, [step("aggregate", group_by=by, aggregations=aggregations)])
    return result.withColumns({c: F.round(c, d) for c, d in (digits or {}).items()})


GAPS = """
    select * replace (
      case when l_orderkey % 13 = 0 then null else l_returnflag end as l_returnflag,
      case when l_quantity = 7 then null else l_tax end as l_tax)
    from lineitem
"""
KNOWN = f"select * from ({GAPS}) where l_returnflag is not null"


@query(f"""
    select l_returnflag, round(sum(l_quantity), 2) as l_quantity, count(l_tax) as l_tax
    from ({KNOWN}) group by l_returnflag
""")
def tf_aggregate(spark, sf):
    return _grouped(spark, sf, ["l_returnflag"], {"l_quantity": 2}, l_quantity="sum", l_tax="count")


@query(f"""
    select l_returnflag, l_linestatus, l_suppkey, round(sum(l_extendedprice), 2) as l_extendedprice
    from ({KNOWN}) group by l_returnflag, l_linestatus, l_suppkey
""")
def tf_aggregate_multi(spark, sf):
    by = ["l_returnflag", "l_linestatus", "l_suppkey"]
    return _grouped(spark, sf, by, {"l_extendedprice": 2}, l_extendedprice="sum")


@query(f"""
    select l_returnflag, round(coalesce(sum(l_tax), 0), 2) as l_tax_sum,
      round(avg(l_tax), 8) as l_tax_mean
    from ({KNOWN}) group by l_returnflag
""")
def tf_agg_sum_mean(spark, sf):
    digits = {"l_tax_sum": 2, "l_tax_mean": 8}
    return _grouped(spark, sf, ["l_returnflag"], digits, l_tax=["sum", "mean"])


@query(f"""
    select l_returnflag, min(l_tax) as l_tax_min, max(l_tax) as l_tax_max,
      count(l_tax) as l_tax_count, count(*) as l_tax_size
    from ({KNOWN}) group by l_returnflag
""")
def tf_agg_minmax_count(spark, sf):
    return _grouped(spark, sf, ["l_returnflag"], l_tax=["min", "max", "count", "size"])


@query(f"""
    select l_returnflag, count(distinct l_suppkey) as l_suppkey, count(distinct l_tax) as l_tax
    from ({KNOWN}) group by l_returnflag
""")
def tf_agg_nunique(spark, sf):
    return _grouped(spark, sf, ["l_returnflag"], l_suppkey="nunique", l_tax="nunique")


@query(f"""
    select l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) as l_extendedprice_median,
      round(stddev_samp(l_extendedprice), 4) as l_extendedprice_std,
      round(var_samp(l_tax), 10) as l_tax_var,
      round(stddev_samp(l_tax) / sqrt(count(l_tax)), 10) as l_tax_sem
    from ({KNOWN}) group by l_returnflag
""")
def tf_agg_median_std(spark, sf):
    digits = {"l_extendedprice_median": 4, "l_extendedprice_std": 4,
              "l_tax_var": 10, "l_tax_sem": 10}
    wanted = {"l_extendedprice": ["median", "std"], "l_tax": ["var", "sem"]}
    return _grouped(spark, sf, ["l_returnflag"], digits, **wanted)


@query(f"""
    select l_suppkey, arg_min(l_tax, row(l_orderkey, {", ".join(KEY[1:] + ORDER)}))
        filter (where l_tax is not null) as l_tax_first,
      arg_max(l_tax, row(l_orderkey, {", ".join(KEY[1:] + ORDER)}))
        filter (where l_tax is not null) as l_tax_last
    from ({GAPS}) group by l_suppkey
""")
def tf_agg_first_last(spark, sf):
    df = table(spark, sf, "lineitem").withColumn(
        "l_tax", F.expr("case when l_quantity = 7 then double('nan') else l_tax end")
    )
    steps = [step("aggregate", group_by="l_suppkey", aggregations={"l_tax": ["first", "last"]},
                  order_by=KEY + ORDER)]
    return apply_steps(df, steps)


@query(f"""
    select l_returnflag, bool_or(l_discount <> 0) as l_discount_any,
      bool_and(l_discount <> 0) as l_discount_all,
      round(skewness(l_extendedprice), 6) as l_extendedprice_skew,
      count(l_linenumber) as l_linenumber_count
    from ({KNOWN}) group by l_returnflag
""")
def tf_agg_misc(spark, sf):
    wanted = {"l_discount": ["any", "all"], "l_extendedprice": ["skew"], "l_linenumber": ["count"]}
    digits = {"l_extendedprice_skew": 6}
    return _grouped(spark, sf, ["l_returnflag"], digits, **wanted)


@query("""
    select l_orderkey, round(product(l_linenumber), 0) as l_linenumber from lineitem
    group by l_orderkey
""")
def tf_agg_prod(spark, sf):
    steps = [step("aggregate", group_by="l_orderkey", aggregations={"l_linenumber": "prod"})]
    return apply_steps(table(spark, sf, "lineitem"), steps).withColumn(
        "l_linenumber", F.round("l_linenumber", 0)
    )
