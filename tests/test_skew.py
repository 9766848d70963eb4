"""Chunked ordered operators give the same answer as plain ones, whatever the chunk size."""

import random

import pytest
from pyspark.sql import functions as F

from paypanel.operators import coherence, imputation, persons, skew, windows


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    data = []
    for key, n in [("hot", 400), ("warm", 40), ("one", 1), (None, 30)]:
        for _ in range(n):
            value = rng.choice([None, None, float(rng.randint(1, 9))])
            data.append((key, rng.randint(1, 30) + 202000, len(data), value))
    rng.shuffle(data)
    return spark.createDataFrame(data, "matricule string, periode int, row_id bigint, v double")


def expected(frame):
    by_key = {}
    for r in frame.collect():
        by_key.setdefault(r["matricule"] if r["matricule"] is not None else ("alone", r["row_id"]), []).append(r)
    out = {}
    for rs in by_key.values():
        rs.sort(key=lambda r: (r["periode"], r["row_id"]))
        for i, r in enumerate(rs):
            fwd = next((x["v"] for x in reversed(rs[: i + 1]) if x["v"] is not None), None)
            bwd = next((x["v"] for x in rs[i:] if x["v"] is not None), None)
            out[r["row_id"]] = (fwd, bwd, rs[i - 1]["v"] if i else None, i + 1, len(rs))
    return out


@pytest.mark.parametrize("hot_rows, bits", [(10**6, 20), (20, 2), (20, 5), (0, 0)])
def test_chunks_do_not_change_results(frame, hot_rows, bits):
    want = expected(frame)
    kw = {"hot_rows": hot_rows, "bits": bits}
    filled = {r["row_id"]: (r["v__fwd"], r["v__bwd"]) for r in skew.fill_along(frame, "matricule", ["v"], **kw).collect()}
    prev = {r["row_id"]: r["v__prev"] for r in skew.with_previous(frame, "matricule", ["v"], **kw).collect()}
    rank = {r["row_id"]: (r["rang"], r["effectif"]) for r in skew.with_rank(frame, "matricule", **kw).collect()}
    assert len(filled) == len(prev) == len(rank) == len(want)
    for i, (f, b, p, r, n) in want.items():
        assert filled[i] == (f, b) and prev[i] == p and rank[i] == (r, n)


def test_chunks_are_bounded(frame):
    d, any_hot = skew.with_chunks(frame, "matricule", hot_rows=20, bits=3)
    assert any_hot
    sizes = d.where("_chunk is not null").groupBy("_key", "_chunk").count()
    assert sizes.where("count > 8").count() == 0
    assert d.where("matricule = 'hot' and _chunk is null").count() == 0
    assert d.where("matricule = 'one' and _chunk is not null").count() == 0


@pytest.mark.parametrize("listed", [10_000, 100])
def test_many_hot_keys_and_sparse_ids(spark, monkeypatch, listed):
    """1 500 hot keys, ids far apart and in clusters: all keys are cut into bounded chunks, with equal rows."""
    monkeypatch.setattr(skew.with_chunks, "__defaults__", (*skew.with_chunks.__defaults__[:-1], listed))
    d = spark.range(1500 * 6).select(
        F.format_string("k%04d", F.col("id") % 1500).alias("k"),
        (F.lit(202001) + (F.col("id") / 4500).cast("int")).alias("periode"),
        F.when(F.col("id") % 2 == 0, F.col("id") * (1 << 40)).otherwise(F.col("id")).alias("row_id"),
        F.when(F.xxhash64("id") % 3 == 0, F.col("id").cast("double")).alias("v"),
    )
    chunked, any_hot = skew.with_chunks(d, "k", hot_rows=5, bits=8)
    assert any_hot and chunked.where("_chunk is null").count() == 0
    assert chunked.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 256
    plain = [sorted(map(tuple, f(d, "k", hot_rows=10**6).collect(), ), key=str) for f in (skew.with_rank,)]
    cut = [sorted(map(tuple, f(d, "k", hot_rows=5, bits=8).collect()), key=str) for f in (skew.with_rank,)]
    assert plain == cut
    for f in (skew.fill_along, skew.with_previous):
        a = sorted(map(tuple, f(d, "k", ["v"], hot_rows=10**6).collect()), key=str)
        assert a == sorted(map(tuple, f(d, "k", ["v"], hot_rows=5, bits=8).collect()), key=str)


def test_no_hot_key_means_one_shuffle(spark, frame):
    plan = skew.fill_along(frame, "matricule", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_no_key_gets_no_value(spark):
    d = spark.createDataFrame([(None, 1, 1, 5.0), (None, 2, 2, None)], "k string, periode int, row_id bigint, v double")
    got = windows.locf_forward(d, "k", "v", "f").where("row_id = 2").first()
    assert got["f"] is None


def test_dedup_limits_rows_before_the_shuffle(spark, frame):
    plan = windows.dedup_panel(frame, ["matricule", "periode"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_jumps_on_a_hot_person(spark):
    data = [("p", 202001 + i, i, v) for i, v in enumerate([100.0, 50.0, 49.0, 98.0, 197.0, None, 10.0, 0.0, 5.0])]
    d = spark.createDataFrame(data, "matricule string, periode int, row_id bigint, montant_net double")
    for hot in (10**6, 1):
        r = {x["row_id"]: (x["FLAG_MONTANT_BAISSE_FORTE"], x["FLAG_MONTANT_HAUSSE_FORTE"]) for x in coherence.jump_flags(d, hot_rows=hot).collect()}
        # exactly half and exactly double are no jump; a NULL or missing previous amount is none either
        assert r == {0: (0, 0), 1: (0, 0), 2: (0, 0), 3: (0, 0), 4: (0, 1), 5: (0, 0), 6: (0, 0), 7: (1, 0), 8: (0, 1)}


def test_rank_based_service_age_matches_on_hot_person(spark):
    import datetime as dt

    data = [("p", 200001 + i, i, dt.date(2000, 1 + i, 1), 30.0, dt.date(1990, 1, 1)) for i in range(6)]
    d = spark.createDataFrame(data, "matricule string, periode int, row_id bigint, collecte date, age double, prise_service_corrigee date")
    a = persons.age_service_stable(d, "age").first()
    b = persons.age_service_stable(d, "age", hot_rows=1).first()
    assert a == b and a["AGE_SERVICE_METHODE"] == "PREMIERE_OBS"


def test_salary_imputation_with_hot_post(spark):
    data = []
    for i in range(60):
        data.append(("hot", 202001 + i % 12, i, "J", "A1", "O", 100.0 + i if i % 7 == 3 else None, None))
    d = spark.createDataFrame(data, "cle_unique string, periode int, row_id bigint, CODE_EMPLOI string, GRADE string, CODE_ORGANISME string, montant_brut double, montant_net double")
    a = sorted(map(tuple, imputation.impute_salaries(d).select("row_id", "montant_brut", "montant_brut_SOURCE").collect()))
    b = sorted(map(tuple, imputation.impute_salaries(d, hot_rows=5).select("row_id", "montant_brut", "montant_brut_SOURCE").collect()))
    assert a == b and {x[2] for x in a} == {"OBSERVE", "LOCF_FWD", "LOCF_BWD"}
