"""Distributed ranking gives the same quantiles as sorting everything in one place."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakesieve.operators.quantiles import column_quantiles, ranked_quantiles

WANTED = {"low": 0.0, "q1": 0.25, "mid": 0.5, "p": 0.937, "high": 1.0}


@pytest.mark.parametrize("seed, partitions", [(1, 1), (2, 5), (3, 40)])
def test_against_numpy(spark, seed, partitions):
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(3000) < 0.4, 7.25, np.round(rng.normal(0, 50, 3000), 2))
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 3000, p=[0.8, 0.19, 0.01]), "v": hot})
    df = spark.createDataFrame(pdf)
    found = ranked_quantiles(df, F.col("v"), WANTED, ["g"], partitions=partitions).toPandas()
    for _, row in found.iterrows():
        values = pdf[pdf.g == row["g"]].v
        for name, p in WANTED.items():
            assert row[name] == pytest.approx(values.quantile(p)), (row["g"], name)
    assert len(found) == 3
    overall = ranked_quantiles(df, F.col("v"), WANTED, partitions=partitions).first()
    for name, p in WANTED.items():
        assert overall[name] == pytest.approx(pdf.v.quantile(p))


def test_whole_columns(spark):
    df = spark.range(1, 11).selectExpr("cast(id * id as double) as v", "id as w", "cast(null as double) as n")
    found = column_quantiles(df, {c: F.col(c) for c in "vwn"}, [0.25, 0.75])
    assert found == {"v": [10.75, 60.25], "w": [3.25, 7.75]}
    assert column_quantiles(df, {}, [0.5]) == {}


def test_one_value_in_nearly_all_rows_beside_the_quartile(spark, ranges):
    values = np.concatenate([np.full(19_800, 5.0), np.arange(100) / 100, 6 + np.arange(100)])
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    probabilities = [0.004, 0.005, 0.25, 0.995, 0.996]
    found = column_quantiles(df, {"v": F.col("v")}, probabilities)["v"]
    assert found == pytest.approx(list(np.quantile(values, probabilities)))
