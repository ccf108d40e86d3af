import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardgrid.operators.quantiles import evenly, nearest_ranks, percentiles, values_at


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_against_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.lognormal(0, 4, 900), -rng.lognormal(1, 2, 500), np.zeros(50), np.round(rng.normal(80, 5, 1500))])
    keys = rng.integers(0, 4, len(values))
    keys[keys == 3] = 0  # one hot key
    df = spark.createDataFrame([(int(k) if k else None, float(v)) for k, v in zip(keys, values)], "k long, v double").repartition(7)
    at = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r["k"]: (r["n"], r["p"]) for r in percentiles(df, ["k"], "v", at).collect()}
    many = {r["k"]: r["p"] for r in evenly(df, ["k"], "v", 101).collect()}
    ranks = {r["k"]: r["values"] for r in nearest_ranks(df, ["k"], "v", 10).collect()}
    for k in (0, 1, 2):
        mine = np.sort(values[keys == k])
        n, p = got[k or None]
        assert n == len(mine) and p == pytest.approx(np.quantile(mine, at).tolist(), rel=1e-12)
        assert many[k or None] == pytest.approx(np.quantile(mine, np.linspace(0, 1, 101)).tolist(), rel=1e-9)
        assert ranks[k or None] == [mine[((n - 1) * 2 * i + 10) // 20] for i in range(1, 10)]


def test_copies_and_odd_values(spark):
    rows = [(1, 5.0, 3), (1, 7.0, 1), (1, 9.0, 0), (1, None, 4), (1, 8.0, None), (2, math.inf, 1), (2, -math.inf, 1), (2, 5e-324, 1), (3, math.nan, 1), (3, 1.0, 1), (4, None, 1)]
    df = spark.createDataFrame(rows, "k long, v double, c int")
    got = {r["k"]: (r["n"], r["values"]) for r in values_at(df, ["k"], "v", lambda n: F.sequence(F.lit(0).cast("long"), n - 1), F.col("c")).collect()}
    assert got[1] == (4, [5.0, 5.0, 5.0, 7.0]) and got[2] == (3, [-math.inf, 5e-324, math.inf])
    assert got[3][1][0] == 1.0 and math.isnan(got[3][1][1]) and 4 not in got
    assert percentiles(df.filter("false"), ["k"], "v", [0.5]).count() == 0
    one = percentiles(df.filter("k = 1 and v = 7"), ["k"], "v", [0.0, 0.5, 1.0]).first()
    assert (one["n"], one["p"]) == (1, [7.0, 7.0, 7.0])
    assert evenly(df.filter("k = 1 and v = 7"), ["k"], "v", 5).first()["p"] == [7.0] * 5


def test_no_plan_holds_a_keys_values(spark):
    df = spark.createDataFrame([(1, 2.0)], "k long, v double")
    plan = percentiles(df, ["k"], "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
