"""Exact quantiles against a plain computation, with ties, NULLs, NULL groups and hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from paypanel.operators.quantiles import Quantile, group_stats, median, nearest


def linear(xs, p):
    xs = sorted(xs)
    pos = (len(xs) - 1) * p
    lo = int(pos)
    hi = min(lo + 1, len(xs) - 1)
    return xs[lo] + (xs[hi] - xs[lo]) * (pos - lo)


def nearest_rank(xs, p):
    xs = sorted(xs)
    return xs[int((len(xs) - 1) * p + 0.5)]


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_python(spark, seed):
    rng = random.Random(seed)
    data = []
    for g, n in [("a", 1), ("b", 2), ("c", 4), ("d", 5), (None, 400), ("hot", 3000)]:
        for _ in range(n):
            v = rng.choice([None, 0.0, -3.25, rng.uniform(-1e6, 1e9), float(rng.randint(1, 20)), 1e-9 * rng.random()])
            data.append((g, v))
    df = spark.createDataFrame(data, "g string, v double")
    want_p = {"lin10": Quantile("v", 0.1), "med": median("v"), "near25": nearest("v", 0.25), "near75": nearest("v", 0.75)}
    got = {r["g"]: r for r in group_stats(df, ["g"], [F.count("*").alias("n")], want_p).collect()}
    for g in {x[0] for x in data}:
        xs = [v for k, v in data if k == g and v is not None]
        assert got[g]["n"] == sum(k == g for k, _ in data)
        if not xs:
            assert got[g]["med"] is None
            continue
        assert got[g]["lin10"] == pytest.approx(linear(xs, 0.1), rel=1e-9, abs=1e-15)
        assert got[g]["med"] == pytest.approx(linear(xs, 0.5), rel=1e-9, abs=1e-15)
        assert got[g]["near25"] == nearest_rank(xs, 0.25)
        assert got[g]["near75"] == nearest_rank(xs, 0.75)


def test_without_groups_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "v double")
    assert group_stats(df, [], [F.count("*").alias("n")], {"m": median("v")}).first().asDict() == {"n": 3, "m": 2.0}
    assert group_stats(df.where("v > 99").withColumn("g", F.lit(1)), ["g"], [F.count("*").alias("n")], {"m": median("v")}).count() == 0


def test_no_window_over_a_whole_group(spark):
    df = spark.createDataFrame([("a", 1.0)], "g string, v double")
    plan = group_stats(df, ["g"], [F.count("*").alias("n")], {"m": median("v")})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "percentile" not in text and "collect" not in text
