"""Every registered query against its SQL counterpart on the smallest sample."""

import os

import oracle
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert oracle.difference(df, duck, SQL[name]) is None
    else:
        assert df.count() >= 0


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "revenue" in df.columns


def test_loads_hold_every_order(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    both = orders.where("year(o_orderdate) = 1996").count()
    assert both > 0
    assert QUERIES["load_two_stages_all"](spark, SF_DIR).count() == orders.count()
    counts = {r.strategy: r["count"] for r in QUERIES["load_replayed_all"](spark, SF_DIR).groupBy("strategy").count().collect()}
    assert counts["append"] == orders.count() + both
    assert orders.count() <= counts["upsert"] < counts["append"]
