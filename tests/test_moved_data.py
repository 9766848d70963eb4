"""What is broadcast, and what the written cuts hold: tables of uncounted size stay off the driver, rows meet short lookups in place."""

import pytest
from pyspark.sql import functions as F

from checks import q_quality
from paypanel.operators import coherence as coh
from paypanel.operators import imputation as imp
from paypanel.operators import joins, silver, skew, windows
from paypanel.operators.estimators import within_reach
from paypanel.operators.quantiles import group_quantiles, median


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


PAY = "row_id bigint, cle_unique string, periode int, CODE_EMPLOI string, GRADE string, CODE_ORGANISME string, montant_brut double, montant_net double"


@pytest.fixture()
def pay(spark):
    rows = [(i, f"k{i % 7}", 202401, "J", "A1", None if i % 5 else "O", None if i % 3 else 10.0 * i, 1.0 * i) for i in range(60)]
    return spark.createDataFrame(rows, PAY)


def test_groups_of_uncounted_number_are_not_broadcast(spark, pay):
    q = group_quantiles(pay, ["GRADE", "CODE_ORGANISME"], {"m": median("montant_net")})
    assert "BroadcastHashJoin" not in final_plan(q)
    for out in (imp.impute_salaries(pay), imp.impute_by_median(pay)):
        assert "BroadcastHashJoin" not in final_plan(out)


def test_join_back_matches_null_groups_and_keeps_rows(spark):
    d = spark.createDataFrame([(1, "a", None), (2, None, 3), (3, None, None), (3, None, None), (4, "b", 1)], "i int, k string, j int")
    s = spark.createDataFrame([("a", None, 1.0), (None, 3, 2.0), (None, None, 3.0)], "k string, j int, v double")
    for joined in (skew.join_back, skew.lookup_back):
        out = joined(d, s, ["k", "j"])
        assert out.columns == ["i", "k", "j", "v"]
        assert sorted((r["i"], r["v"]) for r in out.collect() if r["v"]) == [(1, 1.0), (2, 2.0), (3, 3.0), (3, 3.0)]
        assert out.count() == 5


def test_short_lookups_leave_the_rows_in_place_and_long_ones_do_not_reach_the_driver(spark, pay, monkeypatch):
    rows = spark.read.schema(pay.schema).parquet(_stored(pay))
    few = imp.group_mode_fill(rows, "montant_brut", ["CODE_ORGANISME", "GRADE"], "o")
    want = sorted(few.select("row_id", "o").collect())
    assert "Exchange hashpartitioning" not in final_plan(few)
    monkeypatch.setattr(skew, "LISTED_KEYS", 1)
    many = imp.group_mode_fill(rows, "montant_brut", ["CODE_ORGANISME", "GRADE"], "o")
    assert "BroadcastHashJoin" not in final_plan(many) and sorted(many.select("row_id", "o").collect()) == want


def _stored(df):
    return skew.written(df, "test").inputFiles()[0].rpartition("/")[0]


def test_cuts_hold_only_what_the_variables_and_flags_need(spark, sf):
    assert not {"nom", "organisme", "emploi", "statut_fonctionnaire", "montant_brut"} & set(q_quality.variables(spark, sf).columns)
    assert not {"nom", "organisme", "emploi", "statut_fonctionnaire", "montant_brut"} & set(q_quality.flag_input(spark, sf).columns)


def test_month_and_year_flags_meet_the_rows_in_one_join(spark):
    data = [  # (row, person, year, month, marital status, situation)
        (1, "p", 2020, 1, "celibataire", "en activite"), (2, "p", 2020, 2, "marie", "en activite"), (3, "p", 2020, 3, "veuf", "retraite"),
        (4, "p", 2020, 3, "veuf", None), (5, "p", 2021, 1, "marie", None), (6, None, 2021, 1, "marie", "deces"), (7, "q", None, None, None, None),
    ]
    d = spark.createDataFrame(data, "row_id bigint, matricule string, annee int, mois int, situation_matrimoniale string, situation string")
    d = d.selectExpr(
        "*", "coalesce(annee, 0) * 100 + coalesce(mois, 0) AS periode", "'M' AS sexe", "30 AS AGE", "20 AS AGE_PS", "10.0 AS ANCIENNETE", "0 AS ENFANTS", "'fonctionnaire' AS STATUT_DEF"
    )
    out = coh.coherence_flags(d)
    got = {r["row_id"]: (r["FLAG_SITMAT_VARIATIONS"], r["FLAG_STATUT_MULTI"], r["FLAG_STATUT_TROU"]) for r in out.collect()}
    assert got == {1: (1, 0, 0), 2: (1, 0, 0), 3: (1, 1, 0), 4: (1, 1, 0), 5: (0, 0, 1), 6: (0, 0, 0), 7: (0, 0, 1)}
    assert final_plan(out).count("HashJoin") + final_plan(out).count("SortMergeJoin") == 1


def test_reach_of_a_target_is_found_once_a_row(spark):
    near = "from_json('[{\"pred\":1,\"start\":0,\"n\":2},{\"pred\":2,\"start\":2,\"n\":2},{\"pred\":4,\"start\":4,\"n\":1},{\"pred\":9,\"start\":5,\"n\":7}]', 'array<struct<pred: double, start: bigint, n: bigint>>')"
    d = spark.createDataFrame([(3.0,), (1.0,)], "at double").selectExpr(f"{near} AS near", "at")
    out = d.withColumn("usable", within_reach(3)).select("at", F.aggregate("usable", F.lit(0).cast("long"), lambda a, b: a + b.n).alias("many"))
    assert {r["at"]: r["many"] for r in out.collect()} == {3.0: 3, 1.0: 4}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan or plan.index("array_sort") < plan.index("filter(")


def test_code_tables_meet_the_rows_in_place(spark, monkeypatch):
    rows = _stored(spark.createDataFrame([(1, " métier a"), (2, "METIER A"), (3, "x"), (4, None)], "row_id bigint, emploi string"))
    d = spark.read.schema("row_id bigint, emploi string").parquet(rows)
    dim = spark.createDataFrame([("metier a", "7", "u"), ("Métier A", "5", "v"), (None, "9", "w")], "libelle string, code string, more string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.enrich_code(d, dim, "emploi", "c", ["more"])
        assert out.columns == ["row_id", "emploi", "c", "more"]
        assert "Exchange hashpartitioning" not in final_plan(out)
        want = [(1, "5", "v"), (2, "5", "v"), (3, None, None), (4, None, None)]
        assert sorted(map(tuple, out.select("row_id", "c", "more").collect())) == want
        monkeypatch.setattr(skew, "LISTED_KEYS", 0)
        many = joins.enrich_code(d, dim, "emploi", "c", ["more"])
        assert "BroadcastHashJoin" not in final_plan(many)
        assert sorted(map(tuple, many.select("row_id", "c", "more").collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_panel_is_sorted_in_tasks_of_bounded_rows(spark):
    data = [(i, None if i % 9 == 0 else f"p{i % 5}", f"m{i % 4}" if i % 7 else None) for i in range(90)] * 2
    d = spark.createDataFrame(data, "row_id bigint, matricule string, mois_annee string")
    want = sorted({(m, t): i for i, m, t in reversed(data)}.values())
    keys = ["matricule", "mois_annee"]
    out = windows.dedup_panel(d, keys, bits=4)
    assert out.rdd.getNumPartitions() == (len(data) >> 4) + 1
    assert final_plan(out).count("Sort [") == 1
    for hot_rows in (10**6, 30, 1):
        got = windows.dedup_panel(d, keys, hot_rows=hot_rows, bits=4)
        assert got.columns == d.columns and sorted(r["row_id"] for r in got.collect()) == want


def test_gross_pay_hashes_the_sums_and_sorts_no_rows(spark):
    d = spark.createDataFrame([(1, 10.0, "a"), (2, 20.0, "b"), (None, 30.0, "c"), (2, 20.0, "b")], "row_id bigint, montant_brut double, nom string")
    items = spark.createDataFrame([(1, "x", 1.0), (1, "x", 2.0), (None, "x", 9.0), (2, "z", 5.0)], "row_id bigint, code string, montant double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = silver.brut_from_components(d, items, ["row_id"], ["x"])
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.columns == ["row_id", "montant_brut", "nom", "SALAIRE_BRUT"]
    assert sorted(((r["nom"], r["SALAIRE_BRUT"]) for r in out.collect())) == [("a", 3.0), ("b", 20.0), ("b", 20.0), ("c", 30.0)]
