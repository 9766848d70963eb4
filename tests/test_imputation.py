"""Grade and salary cascades, winsorisation: hand-worked cases and invariants."""

import pytest
from pyspark.sql import functions as F

from paypanel.operators import imputation as imp
from paypanel.operators import windows as win
from paypanel.operators.aggregates import aggregate_revenue, count_posts, growth_verdict, kpis, posts_bucket, year_end_growth


def grades(spark, data):
    return spark.createDataFrame(data, "row_id bigint, emploi string, annee int, mois int, GRADE string")


def test_cascade_levels_and_ties(spark):
    d = grades(
        spark,
        [
            (1, "medecin", 2024, 1, "A3"), (2, "medecin", 2024, 1, "A4"), (3, "medecin", 2024, 1, "B7"),  # tie: smallest
            (4, "medecin", 2024, 2, "B7"), (5, "medecin", 2023, 1, "A"), (6, "medecin", 2024, 3, "A4"),
            (7, "inconnu", 2024, 1, "C"), (8, "agent", 2024, 1, "NF"), (9, None, 2024, 1, "D"), (10, None, 2024, 1, "D1"),
        ],
    )
    got = {r["row_id"]: (r["GRADE"], r["GRADE_SOURCE"]) for r in imp.impute_grades(d).collect()}
    assert got[3] == ("A3", "IMPUTE")  # month level, tie to the smallest
    assert got[4] == ("A4", "IMPUTE")  # year level: A4 twice
    assert got[5] == ("A4", "IMPUTE")  # job level
    assert got[7] == ("C", "NF_NON_IMPUTABLE") and got[8] == ("NF", "NF_NON_IMPUTABLE")
    assert got[9] == ("D", "NF_NON_IMPUTABLE")  # a NULL job matches nothing
    assert got[1] == ("A3", "OBSERVE") and len(got) == 10


def test_invalid_grades_never_vote(spark):
    d = grades(spark, [(1, "x", 2024, 1, "B7"), (2, "x", 2024, 1, "B7"), (3, "x", 2024, 1, "B2")])
    assert {r["GRADE"] for r in imp.impute_grades(d).collect()} == {"B2"}


SAL = "row_id bigint, cle_unique string, periode int, CODE_EMPLOI string, GRADE string, CODE_ORGANISME string, montant_brut double, montant_net double"


def test_locf_across_years_both_directions(spark):
    d = spark.createDataFrame(
        [
            (1, "k", 202311, "J", "A1", "O", None, None), (2, "k", 202312, "J", "A1", "O", 10.0, None),
            (3, "k", 202401, "J", "A1", "O", None, None), (4, "m", 202401, "J", "A1", "O", None, 7.0),
        ],
        SAL,
    )
    got = {r["row_id"]: r for r in imp.impute_salaries(d).collect()}
    assert [got[i]["montant_brut_SOURCE"] for i in (1, 2, 3)] == ["LOCF_BWD", "OBSERVE", "LOCF_FWD"]
    assert got[3]["montant_brut"] == 10.0 and got[4]["montant_brut"] is None
    assert got[4]["montant_brut_SOURCE"] == "NON_IMPUTABLE" and got[4]["montant_net"] == 7.0


@pytest.mark.parametrize("n, level", [(5, "IMPUTE_L1"), (4, "IMPUTE_L3"), (2, "NON_IMPUTABLE")])
def test_median_level_needs_enough_observations(spark, n, level):
    data = [(i, f"p{i}", 202401, "J", "A1", "O", 100.0 * (i + 1), 1.0) for i in range(n)]
    d = spark.createDataFrame([*data, (99, "new", 202401, "J", "A1", "O", None, 1.0)], SAL)
    r = imp.impute_salaries(d).where("row_id = 99").first()
    assert r["montant_brut_SOURCE"] == level
    if n == 5:
        assert r["montant_brut"] == 300.0


def test_null_code_skips_its_level(spark):
    data = [(i, f"p{i}", 202401, None, "A1", "O", 100.0, 1.0) for i in range(6)]
    d = spark.createDataFrame([*data, (99, "new", 202401, None, "A1", "O", None, 1.0)], SAL)
    assert imp.impute_salaries(d).where("row_id = 99").first()["montant_brut_SOURCE"] == "IMPUTE_L3"


def test_rows_without_post_are_not_carried_and_rows_are_kept(spark):
    d = spark.createDataFrame(
        [(1, None, 202401, "J", "A1", "O", 5.0, 5.0), (2, None, 202402, "J", "A1", "O", None, 5.0), (3, "k", 202402, "J", "A1", "O", None, None),
         (4, "k", 202402, "J", "A1", "O", 8.0, 1.0), (5, "k", 202402, "J", "A1", "O", None, None)],
        SAL,
    )
    out = imp.impute_salaries(d)
    got = {r["row_id"]: r["montant_brut_SOURCE"] for r in out.collect()}
    assert got == {1: "OBSERVE", 2: "NON_IMPUTABLE", 3: "LOCF_BWD", 4: "OBSERVE", 5: "LOCF_FWD"}
    again = imp.impute_salaries(out.drop("montant_brut_SOURCE", "montant_net_SOURCE"))
    seen = again.join(out.select("row_id", F.col("montant_brut").alias("b")), "row_id").where("b is not null and b <> montant_brut")
    assert seen.count() == 0


def test_median_and_mode_fill(spark):
    d = spark.createDataFrame([(1, "a", 1.0, "M"), (2, "a", 2.0, "F"), (3, "a", None, None), (4, "b", None, None), (5, "c", 9.0, "F")], "i int, g string, v double, s string")
    got = {r["i"]: (r["o"], r["m"]) for r in imp.group_mode_fill(imp.group_median_fill(d, "v", ["g"], "o"), "s", ["g"], "m").collect()}
    assert got == {1: (1.0, "M"), 2: (2.0, "F"), 3: (2.0, "F"), 4: (2.0, None), 5: (9.0, "F")}  # 1.5 rounds to even 2


def test_winsorize_thresholds_and_nulls(spark):
    data = [(i, "g", "c", float(i)) for i in range(100)] + [(200, "g", "d", 1000.0), (201, "g", "c", None)]
    d = spark.createDataFrame(data, "i int, g string, c string, v double")
    got = {r["i"]: r["w"] for r in win.winsorize(d, "v", ["g", "c"], ["g"], "w", 0.05, 100).collect()}
    # 101 rows in the fine group (the NULL counts), bounds from its 100 values
    assert got[0] == 5.0 and got[99] == 94.0 and got[50] == 50.0 and got[201] is None
    assert got[200] == 95.0  # coarse bound: 101 values, rank 1 + floor(100 * 0.95 + 0.5)


def test_principal_row_and_posts(spark):
    d = spark.createDataFrame(
        [(1, 2024, 1, "p", "p|2", "B1", 10.0), (2, 2024, 1, "p", "p|1", "A3", 5.0), (3, 2024, 1, "p", "p|0", "A3", 1.0), (4, 2024, 1, "q", "q|1", "D1", 0.0)],
        "row_id bigint, annee int, mois int, matricule string, cle_unique string, GRADE string, SALAIRE_BRUT double",
    )
    d = count_posts(d.withColumn("GRADE_SOURCE", F.col("cle_unique")), ["annee", "mois", "matricule"])
    got = aggregate_revenue(d).collect()
    assert len(got) == 1 and got[0]["REVENU_TOTAL"] == 16.0 and got[0]["NB_POSTES"] == 3
    assert (got[0]["GRADE_PRINCIPAL"], got[0]["GRADE_SOURCE_PRINCIPAL"]) == ("A3", "p|0")
    assert aggregate_revenue(d, include_zero=True).count() == 2


def test_buckets_and_verdicts(spark):
    d = spark.createDataFrame([(1,), (4,), (5,), (9,)], "n int")
    assert [r[0] for r in d.select(posts_bucket("n")).collect()] == ["1", "4", "5+", "5+"]

    def verdict(values):
        t = spark.createDataFrame([("k", 2020 + i, v) for i, v in enumerate(values)], "k string, annee int, t double")
        return growth_verdict(year_end_growth(t, ["k"], "t")).first()[0]

    assert verdict([1.0, 2.0, 3.0]) == "evolue" and verdict([1.0, 1.0]) == "constant"
    assert verdict([2.0, 1.0]) == "decroit" and verdict([1.0, 1.0, 2.0]) == "decroit" and verdict([1.0]) == "evolue"


def test_kpis_without_earlier_year(spark):
    d = spark.createDataFrame([("a", 2020, 10.0), ("a", 2020, 20.0)], "matricule string, annee int, montant_brut double")
    r = kpis(d, 2020, 2020).first()
    assert r["masse"] == 30.0 and r["n_agents"] == 1 and r["delta_masse_pct"] is None
