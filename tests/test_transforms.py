"""Transform steps and aggregation, against stated values and against pandas."""

import pandas as pd
import pytest
from conftest import rows_of

from lakesieve import apply_steps, register_transform
from lakesieve.functions.naming import snake_case
from lakesieve.operators.transforms import STEPS


def run(df, *steps):
    return apply_steps(df, [{"type": kind, "params": params} for kind, params in steps])


@pytest.mark.parametrize("name, expected", [
    ("Product Name", "product_name"), ("UnitPrice", "unit_price"), ("  a - b\t", "a_b"),
    ("store-ID", "store_id"), ("already_ok", "already_ok"), ("item2Code", "item2_code"),
    ("HTTPServer", "httpserver"),
])
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_rename_lower_and_collisions(frame):
    df = frame("`Product Name` string, UnitPrice double", ("x", 1.0))
    assert run(df, ("rename_lower", {})).columns == ["product_name", "unit_price"]
    with pytest.raises(ValueError):
        run(frame("`a b` int, `a-b` int"), ("rename_lower", {}))


def test_rename_can_swap_and_ignores_unknown_names(frame):
    df = run(frame("a int, b int", (1, 2)), ("rename", {"columns": {"a": "b", "b": "a", "x": "y"}}))
    assert df.columns == ["b", "a"]
    assert rows_of(df) == [(1, 2)]


def test_cast_is_tolerant(frame):
    df = frame("a string, d string, f double, b int",
               ("1", "2024-01-01", 2.5, 1), ("2.5", "x", 3.5, 0), ("3.5", None, None, 7),
               ("n/a", "2024-02-30", -0.5, None))
    cast = run(df, ("cast", {"columns": {"a": "int", "d": "datetime", "f": "integer", "b": "bool",
                                         "absent": "int"}}))
    assert dict(cast.dtypes) == {"a": "bigint", "d": "timestamp", "f": "bigint", "b": "boolean"}
    assert sorted(rows_of(cast, "a", "f", "b"), key=str) == sorted(
        [(1, 2, True), (2, 4, False), (4, None, None), (None, 0, None)], key=str)
    assert [r[0] is None for r in cast.orderBy("a").select("d").collect()].count(True) == 3


def test_cast_keeps_long_whole_numbers(frame):
    df = frame("a string", ("9007199254740993",), ("-9223372036854775808",), ("1e30",), ("inf",))
    cast = run(df, ("cast", {"columns": {"a": "int"}}))
    assert rows_of(cast) == [(None,), (None,), (-(2**63),), (9007199254740993,)]


def test_steps_see_what_earlier_ones_made(frame):
    """A derived column feeds a filter, a second column and a third that replaces the first; null is no match."""
    df = frame("depot string, weight double, crates int", ("north", 2.5, 4), ("south", 1.0, 3), ("east", None, 8), ("west", 9.0, 0))
    out = run(
        df,
        ("derive", {"column": "load", "expression": "weight * crates"}),
        ("filter", {"expression": "load > 0 and depot <> 'south'"}),
        ("derive", {"column": "heavy", "expression": "load >= 10"}),
        ("derive", {"column": "load", "expression": "concat(depot, ':', cast(load as int))"}),
    )
    assert rows_of(out) == [("north", 2.5, 4, "north:10", True)]


def test_rows_alike_in_two_columns_and_absent_columns(frame):
    """Only both columns together make a copy; nulls agree; dropping an absent column is no error."""
    df = frame("site string, day string, note string",
               ("x", "mon", "a"), ("x", "tue", "a"), ("x", "mon", "a"), (None, "mon", "a"), (None, "mon", "a"), ("y", None, "a"))
    out = run(df, ("drop_duplicates", {"subset": ["site", "day"]}), ("drop_columns", {"columns": ["note", "never there"]}))
    assert rows_of(out) == [(None, "mon"), ("x", "mon"), ("x", "tue"), ("y", None)]


def test_drop_duplicates_keep(frame):
    df = frame("k string, o int, v string", ("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"),
               ("b", 1, "w"), (None, 1, "n"), (None, 2, "m"))
    order = {"subset": ["k"], "order_by": ["o"]}
    assert rows_of(run(df, ("drop_duplicates", order)), "v") == [("n",), ("w",), ("x",)]
    assert rows_of(run(df, ("drop_duplicates", {**order, "keep": "last"})), "v") == [
        ("m",), ("w",), ("y",)]
    assert rows_of(run(df, ("drop_duplicates", {**order, "keep": False})), "v") == [("w",)]
    assert run(df, ("drop_duplicates", {})).count() == 6
    with pytest.raises(ValueError):
        run(df, ("drop_duplicates", {**order, "keep": "some"}))


def test_drop_duplicates_of_rows_that_have_no_order(frame):
    df = frame("k int, o int, m map<string,int>", (1, 2, {"a": 1}), (1, 1, {"b": 2}), (2, 1, None))
    out = run(df, ("drop_duplicates", {"subset": ["k"], "order_by": ["o"]}))
    assert sorted((r["k"], r["m"]) for r in out.collect()) == [(1, {"b": 2}), (2, None)]


def test_fillna_and_constant(frame):
    df = frame("a double, b string, n int", (1.0, None, None), (None, "x", 2))
    out = run(df, ("fillna", {"values": {"a": 0, "n": 0.5, "zzz": 1}}),
              ("add_constant", {"column": "src", "value": "retail"}))
    assert rows_of(out) == [(0.0, "x", 2.0, "retail"), (1.0, None, 0.5, "retail")]
    assert rows_of(run(df, ("fillna", {"value": 0}))) == [(0.0, "x", 2), (1.0, None, 0)]


def test_unknown_step_raises(sample):
    with pytest.raises(ValueError, match="Unknown transform type: nope"):
        run(sample, ("nope", {}))


def test_registered_step(sample):
    register_transform("first_two", lambda df, params: df.where("id <= 2"))
    try:
        assert run(sample, ("first_two", {})).count() == 2
    finally:
        del STEPS["first_two"]


def test_aggregate(frame):
    df = frame("g string, v int", ("x", 1), ("x", 2), ("y", 3), (None, 4))
    out = run(df, ("aggregate", {"group_by": ["g"], "aggregations": {"v": "sum"}}))
    assert rows_of(out) == [("x", 3), ("y", 3)]


FUNCTIONS = ["sum", "mean", "min", "max", "count", "size", "nunique", "median", "std", "var",
             "first", "last", "prod", "sem"]


def grouped_sample():
    return pd.DataFrame({
        "g": ["x", "x", "x", "y", "y", "z", None, "x"],
        "o": range(8),
        "v": [1.5, None, 4.0, 2.0, 2.0, None, 9.0, -3.0],
    })


def test_aggregate_functions_agree_with_pandas(spark, ranges):
    pdf = grouped_sample()
    expected = pdf.groupby("g")["v"].agg(FUNCTIONS).sort_index()
    df = spark.createDataFrame(pdf)
    out = run(df, ("aggregate", {"group_by": "g", "aggregations": {"v": FUNCTIONS},
                                 "order_by": ["o"]}))
    got = out.toPandas().set_index("g").sort_index()
    for name in FUNCTIONS:
        for key in expected.index:
            a, b = got.loc[key, f"v_{name}"], expected.loc[key, name]
            assert (pd.isna(a) and pd.isna(b)) or a == pytest.approx(b), (name, key)


def test_any_all_and_skew(spark):
    pdf = pd.DataFrame({"g": [1, 1, 1, 1, 2], "f": [True, False, True, True, False],
                        "v": [1.0, 2.0, 4.0, 9.0, 1.0]})
    out = run(spark.createDataFrame(pdf), ("aggregate", {
        "group_by": ["g"], "aggregations": {"f": ["any", "all"], "v": ["skew"]}}))
    rows = {r["g"]: r for r in out.collect()}
    assert (rows[1]["f_any"], rows[1]["f_all"], rows[2]["f_any"]) == (True, False, False)
    assert rows[1]["v_skew"] == pytest.approx(pdf[pdf.g == 1].v.skew())
    assert rows[2]["v_skew"] is None


def test_unknown_aggregate_function(sample):
    with pytest.raises(ValueError, match="mode"):
        run(sample, ("aggregate", {"group_by": ["id"], "aggregations": {"amount": "mode"}}))
