"""Response weights, matching imputation and pooling."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paypanel.operators import estimators as est


@pytest.mark.parametrize("p, df, want", [(0.975, 1, 12.7062), (0.975, 4, 2.7764), (0.975, 30, 2.0423), (0.975, 1e9, 1.95996), (0.95, 10, 1.8125)])
def test_student_quantile(p, df, want):
    assert est.student_quantile(p, df) == pytest.approx(want, abs=1e-4)


def test_rubin(spark):
    d = spark.createDataFrame([(1, 10.0, 1.0), (2, 12.0, 3.0)], "m int, estimation double, variance double")
    r = est.pool_rubin(d).first()
    assert (r["moyenne"], r["intra"], r["inter"]) == (11.0, 2.0, 2.0)
    assert r["variance_totale"] == pytest.approx(5.0)
    assert r["ddl"] == pytest.approx((1 + 2 / 3) ** 2)
    half = est.student_quantile(0.975, r["ddl"]) * math.sqrt(5)
    assert r["ic_haut"] - r["moyenne"] == pytest.approx(half)
    n = est.pool_rubin(d, normal=True).first()
    assert n["ic_haut"] == pytest.approx(11 + 1.96 * math.sqrt(3.0))


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    data = []
    for i in range(600):
        sex, job, age = rng.choice("HF"), rng.choice(["a", "b", "c"]), 20 + rng.random() * 40
        pay = math.exp(11 + 0.02 * age + (0.3 if sex == "H" else 0) + rng.gauss(0, 0.1))
        r = int(rng.random() < 1 / (1 + math.exp(-(-3 + 0.09 * age))))
        data.append((i, f"e{i % 20}", i % 6 + 1, sex, job, age, pay if r else None, r, 10.0 + i % 20, "s" + str(i % 2)))
    return spark.createDataFrame(
        data, "row_id bigint, ent string, mois int, sexe string, job string, age double, salaire double, R int, taille double, secteur string"
    )


def test_weights(spark, frame):
    w = est.ipw_weights(frame, "R", ["sexe", "job"], ["age"])
    assert w.where("R = 0 and w_ipw <> 0").count() == 0
    young = w.where("R = 1").agg(F.corr("age", "w_ipw")).first()[0]
    assert young < -0.7  # the young answer less, so they weigh more
    cap = w.where("R = 1").agg(F.max("w_ipw"), F.percentile("w_ipw", 0.99)).first()
    assert cap[0] <= cap[1] * 1.01


def test_pmm_values_come_from_donors_and_repeat(spark, frame):
    d = frame.withColumn("y", F.log("salaire"))
    a = est.pmm_impute(d, "y", "row_id", ["sexe"], ["age"], 4)
    assert a.count() == 4 * 600 and a.where("valeur is null").count() == 0
    assert a.join(d.select(F.col("y").alias("valeur")).distinct(), "valeur", "left_anti").count() == 0
    b = est.pmm_impute(d, "y", "row_id", ["sexe"], ["age"], 4)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    # imputations stay near the model: correlation with age is kept among the imputed
    got = a.join(d.where("y is null").select("row_id", "age", "sexe"), "row_id").where("sexe = 'H'").agg(F.corr("age", "valeur")).first()[0]
    assert got > 0.6


@pytest.mark.parametrize("k, ties", [(1, 1), (5, 1), (5, 40), (3, 7)])
def test_donors_are_the_nearest(spark, monkeypatch, k, ties):
    monkeypatch.setattr(est, "CHUNK", 16)  # many edges
    monkeypatch.setattr(est, "ROWS_A_RANGE", 100)
    rng = random.Random(k * ties)
    preds = [round(rng.gauss(0, 3), 6) for _ in range(400 // ties)] * ties
    donors = [(i, p, float(i)) for i, p in enumerate(preds)]
    asked = [(1000 + i, m, rng.choice([rng.gauss(0, 4), rng.choice(preds), 99.0, -99.0])) for i in range(150) for m in (1, 2)]
    d = spark.createDataFrame(donors, "id long, pred double, value double")
    a = spark.createDataFrame(asked, "id long, m int, target double")
    got = {(r["id"], r["m"]): r["value"] for r in est.nearest_donors(d, a, k).collect()}
    assert len(got) == len(asked)
    for i, m, t in asked:
        reach = sorted(abs(p - t) for p in preds)[k - 1]
        assert abs(preds[int(got[i, m])] - t) <= reach
    # all donors of a tie are in use
    if ties == 40:
        assert len(set(got.values())) > 60


def test_parameters_are_drawn_around_the_fit(spark):
    from pyspark.ml.functions import array_to_vector

    rng = random.Random(5)
    rows = [(x := [rng.gauss(0, 1), rng.random(), 1.0], 3 + 2 * x[0] - x[1] + rng.gauss(0, 0.5)) for _ in range(500)]
    d = spark.createDataFrame(rows, "a array<double>, y double").withColumn("_x", array_to_vector("a"))
    fitted, draws = est.draw_parameters(d, "y", 200, 1)
    x = np.array([[1.0, *a] for a, _ in rows])
    y = np.array([b for _, b in rows])
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose(x @ fitted, x @ want, atol=1e-8)  # the constant is in twice
    assert len({tuple(b) for b in draws}) == 200
    reduced = x[:, :3]
    spread = ((y - x @ want) ** 2).sum() / (500 - 3) * np.linalg.inv(reduced.T @ reduced)
    assert np.allclose(draws[:, 1:3].std(0), np.sqrt(np.diag(spread))[1:], rtol=0.25)
    assert np.allclose(draws[:, 1:3].mean(0), want[1:3], atol=5 * np.sqrt(np.diag(spread))[1:] / math.sqrt(200) + 1e-3)


def test_estimates_bracket_the_mean(spark, frame):
    r = est.individual_estimate(frame, "salaire", "R", "row_id", ["sexe", "job"], ["age"], 5).first()
    naive = frame.agg(F.avg("salaire")).first()[0]
    assert r["ic_bas"] < r["moyenne"] < r["ic_haut"] and r["moyenne"] < naive
    # an employer that never declares
    late = frame.withColumn("R", F.when((F.col("ent") == "e7") | (F.col("mois") == 2), 0).otherwise(F.col("R")))
    base = est.employer_month_base(late, "ent", "mois", "salaire", "R", "age", "sexe", "F", "taille", "secteur")
    e = est.employer_estimate(base, "ent", "mois", 4).first()
    assert e["ic_bas"] <= e["moyenne"] <= e["ic_haut"]
    t = est.two_stage_estimate(late, base, "ent", "mois", "salaire", "R", ["sexe", "job"], ["age"]).first()
    assert t["ic_bas"] < t["moyenne"] < t["ic_haut"] and t["n_entreprises"] == 19


def test_every_donor_can_be_drawn(spark):
    """Plain predictors put all rows into few intervals; still all donors' values are in use."""
    d = spark.range(4_000).select(
        F.col("id").alias("row"),
        (F.col("id") % 2).cast("string").alias("cat"),
        F.lit(1.0).alias("num"),
        F.when(F.col("id") < 1_000, F.col("id").cast("double")).alias("v"),
    )
    done = est.pmm_impute(d, "v", "row", ["cat"], ["num"], 3)
    drawn = done.where("row >= 1000")
    assert drawn.count() == 9_000 and done.count() == 12_000
    assert drawn.select("valeur").distinct().count() > 900
