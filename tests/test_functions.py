"""Scalar rules with hand-worked values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paypanel.functions import dates, grades, people, text
from paypanel.operators import schema


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, want",
    [
        (None, None), ("", None), ("   ", None), (" .,;- ", None), ("médecin", "MEDECIN"), ("Éducation", "EDUCATION"),
        ("demi-solde", "DEMI SOLDE"), ("ministère   de   la  santé", "MINISTERE DE LA SANTE"),
        ("Santé, Éducation (nord)/sud", "SANTE EDUCATION NORD SUD"), ("l’école d'Abc", "L ECOLE D ABC"), ("Œuvre", "ŒUVRE"),
    ],
)
def test_norm_label(spark, value, want):
    assert one(spark, value, text.norm_label) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("EN ACTIVITE", "en_activite"), (" activité ", "en_activite"), ("DEMI-SOLDE", "demi_solde"), ("1/2 SOLDE", "demi_solde"),
        ("Régul.  indemnités", "regul_indemnites"), ("REGUL INDEMNITES", "regul_indemnites"), ("RETRAITE", "autre"), (None, "autre"), ("", "autre"),
    ],
)
def test_situation(spark, value, want):
    assert one(spark, value, people.normalize_situation) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("Catégorie A3", "A3"), ("categorie b2", "B2"), ("CATÉGORIE C1", "C1"), ("Fonctionnaire Catégorie  D", "D"), ("Catégorie B7", "B7"),
        ("Contractuel", "NF"), (None, "NF"), ("", "NF"), ("Catégorie E1", "NF"),
    ],
)
def test_extract_grade(spark, value, want):
    assert one(spark, value, grades.extract_grade) == want


def test_valid_grades_are_21():
    assert len(grades.VALID_GRADES) == 21 and not set(grades.VALID_GRADES) & set(grades.INVALID_GRADES)


@pytest.mark.parametrize("value, want", [("A7", 87), ("B1", 71), ("C5", 65), ("D3", 53), ("A", 0), ("NF", 0)])
def test_grade_order(spark, value, want):
    assert one(spark, value, grades.grade_order) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("1990-02-28", dt.date(1990, 2, 28)), ("1990-02-29", None), ("31/12/1960", dt.date(1960, 12, 31)), ("12:30", None), ("00/00/0000", None),
        ("0000-00-00", None), ("25000", dt.date(1968, 6, 11)), ("60001", None), ("0", None), (" ", None), ("nan", None), (None, None),
    ],
)
def test_clean_date(spark, value, want):
    assert one(spark, value, dates.clean_date) == want


@pytest.mark.parametrize(
    "value, want", [("012024", (2024, 1)), ("2024-01", (2024, 1)), ("2024/01", (2024, 1)), ("2024_01", (2024, 1)), (None, (None, None)), ("13", (None, None))]
)
def test_period(spark, value, want):
    d = spark.createDataFrame([(value,)], "c string")
    y, m = dates.period_parts("c")
    got = d.select(y, m).first()
    if value == "13":
        assert got[1] is None
    else:
        assert tuple(got) == want


def test_age_is_birthday_exact(spark):
    d = spark.createDataFrame([(dt.date(2000, 2, 29), dt.date(2024, 2, 28)), (dt.date(2000, 3, 1), dt.date(2024, 3, 1))], "b date, r date")
    assert [r[0] for r in d.select(dates.age_years("b", "r")).collect()] == [23, 24]


def test_months_inclusive(spark):
    d = spark.createDataFrame(
        [(dt.date(2020, 5, 31), dt.date(2020, 5, 1)), (dt.date(2019, 12, 1), dt.date(2020, 1, 1)), (dt.date(2020, 2, 1), dt.date(2020, 1, 1))],
        "a date, b date",
    )
    assert [r[0] for r in d.select(dates.months_inclusive("a", "b")).collect()] == [1, 2, 0]


@pytest.mark.parametrize("value, want", [("Masculin", "Homme"), (" féminin ", "Femme"), ("1", "Homme"), ("?", "Inconnu"), (None, "Inconnu")])
def test_std_sex(spark, value, want):
    assert one(spark, value, people.std_sex) == want


@pytest.mark.parametrize("value, want", [("x", True), (" NaN ", False), ("none", False), (None, False), ("0", True)])
def test_filled(spark, value, want):
    assert one(spark, value, text.filled) == want


def test_build_status(spark):
    nf = "Non Fonctionnaire"
    cases = [("x", "A", "B", "Fonctionnaire"), ("x", nf, "B", "Cas particulier"), (" ", nf, "A", "Cas particulier"), (None, nf, nf, nf), ("x", nf, nf, "Cas particulier")]
    d = spark.createDataFrame(cases, "j string, a string, b string, want string")
    assert all(r[0] == r[1] for r in d.select(people.build_status("j", "a", "b"), "want").collect())


@pytest.mark.parametrize(
    "value, want",
    [
        ("montant-brut", "MONTANT_BRUT"), ("montant brut", "MONTANT_BRUT"), ("Prénom", "PRENOM"), (None, "colonne_vide"), (float("nan"), "colonne_vide"),
        ("montant__brut", "MONTANT_BRUT"), ("ABC12.Grade", "GRADE"), ("", "colonne_vide"),
    ],
)
def test_column_names(value, want):
    assert schema.normalize_column_name(value) == want


def test_column_names_as_data(spark):
    names = ["montant-brut", "Prénom", "ABC12.Grade", "", None, "  a..b__c/ d ", "é̀té№", "ŽUPA ŐŘ ệ", "..", "T_1.T_2.x", "straße", "N° 5", "abc1.x"]
    d = spark.createDataFrame([(n,) for n in names], "n string").select("n", schema.normalize_column_name_expr(F.col("n")).alias("got"))
    for n, got in d.collect():
        assert got == schema.normalize_column_name(n), n
    assert schema.normalize_column_name("ŽUPA ŐŘ ệ") == "ZUPA_OR_E"


def test_column_mapping_first_hit_wins():
    got = schema.map_columns(["MATRICULE||CODE_ORGANISME", "Matricule", "GRADE", "GRADE 2", "Salaire net", "Ministère", "124", "Date prise service"])
    assert list(got.values()) == ["cle_unique", "matricule", "statut_fonctionnaire", "grade_2", "montant_net", "organisme", "124", "prise_service"]


def test_dedupe_names():
    assert schema.dedupe_names(["A", "B", "A", "A"]) == ["A", "B", "A_2", "A_3"]
    assert schema.dedupe_names(["x", "x"], "_dup") == ["x", "x_dup2"]


def test_standardize_and_strict_stack(spark):
    a = spark.createDataFrame([("1", "2")], ["Matricule", "Emploi"])
    assert schema.standardize(a).columns == ["matricule", "emploi"]
    with pytest.raises(ValueError):
        schema.stack_strict([a, a.drop("Emploi")])
    assert schema.stack_strict([a, a]).count() == 2
    assert schema.compare_columns(a, a.withColumnRenamed("Emploi", "z"))["only_right"] == ["z"]


def test_panel_projection_has_every_column(spark):
    d = spark.createDataFrame([("1", 2020)], "matricule string, annee int")
    out = schema.select_panel(d)
    assert out.columns == schema.PANEL_COLUMNS and len(set(c.lower() for c in out.columns)) == len(out.columns)
    assert dict(out.dtypes)["montant_brut"] == "double"


@pytest.mark.parametrize(
    "value, want", [("AGENT\u00a0DE BUREAU", "AGENT DE BUREAU"), ("Inge\u0301nieur", "INGENIEUR"), ("a\t\u2003b\u202f", "A B")]
)
def test_norm_label_of_other_scripts_blanks(spark, value, want):
    assert one(spark, value, text.norm_label) == want


def test_situation_and_sex_with_odd_blanks(spark):
    assert one(spark, "En\u00a0activite\u0301", people.normalize_situation) == "en_activite"
    assert one(spark, "M\t", people.std_sex) == "Homme"
    assert one(spark, "\u00a0 ab1\t", text.norm_id) == "AB1"
