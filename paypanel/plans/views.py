"""Reporting views over the deduplicated panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paypanel.functions.dates import first_of_month, period_label
from paypanel.functions.grades import (
    REPORT_GRADES,
    bareme_rules,
    citp_group,
    citp_label,
    grade_category,
)
from paypanel.functions.people import std_sex
from paypanel.functions.text import null_if_empty
from paypanel.operators.aggregates import count_rows
from paypanel.operators.quantiles import Quantile, group_stats, median, whole
from paypanel.operators.silver import filter_panel_base

MONTH = ["annee", "mois", "date_mois"]
REPORT_SEXES = ["Homme", "Femme"]
VALUE = "montant_brut"


def panel_base(df: DataFrame, first_year: int = 2015, last_year: int = 2099) -> DataFrame:
    """Base projection: paid rows with sex, category, job group, month date and pay scale."""
    sex = std_sex("sexe")
    return filter_panel_base(df, first_year, last_year).select(
        "matricule",
        F.when(sex == "Inconnu", "Autre").otherwise(sex).alias("sexe"),
        F.col("GRADE").alias("grade_principal"),
        grade_category("GRADE").alias("categorie_grade"),
        citp_group("Code_CITP").alias("citp_grand_groupe"),
        null_if_empty(F.trim("Code_CITP")).alias("code_citp"),
        null_if_empty(F.trim("Metier_CITP")).alias("metier_citp"),
        "annee",
        "mois",
        first_of_month("annee", "mois").alias("date_mois"),
        "montant_brut",
        "montant_net",
        "organisme",
        "emploi",
        bareme_rules("organisme", "emploi", "GRADE").alias("bareme"),
    )


def _indicators(base: DataFrame, keys: list[str], bounds: bool = True, extra: list[Column] | None = None) -> DataFrame:
    q = {"revenu_median": median(VALUE), "revenu_p25": Quantile(VALUE, 0.25), "revenu_p75": Quantile(VALUE, 0.75)}
    aggs = [count_rows("effectif"), whole(F.avg(VALUE)).alias("revenu_moyen"), *(extra or [])]
    if bounds:
        aggs += [whole(F.min(VALUE)).alias("revenu_min"), whole(F.max(VALUE)).alias("revenu_max")]
    return group_stats(base, keys, aggs, q).withColumns({c: whole(F.col(c)) for c in q})


def _graded(base: DataFrame) -> DataFrame:
    return base.where(F.col("grade_principal").isin(*REPORT_GRADES))


def _sexed(base: DataFrame) -> DataFrame:
    return base.where(F.col("sexe").isin(*REPORT_SEXES))


def indicators_global(base: DataFrame) -> DataFrame:
    return _indicators(base, MONTH)


def indicators_citp(base: DataFrame) -> DataFrame:
    known = base.where(F.col("citp_grand_groupe").isNotNull())
    return _indicators(known, [*MONTH, "citp_grand_groupe", "code_citp", "metier_citp"])


def indicators_citp_group(base: DataFrame) -> DataFrame:
    known = base.where(F.col("citp_grand_groupe").between(1, 9))
    out = _indicators(known, [*MONTH, "citp_grand_groupe"], bounds=False)
    return out.withColumn("libelle_citp", citp_label("citp_grand_groupe"))


def indicators_grade(base: DataFrame) -> DataFrame:
    return _indicators(_graded(base), [*MONTH, "grade_principal"])


def indicators_sex_grade(base: DataFrame) -> DataFrame:
    return _indicators(_sexed(_graded(base)), [*MONTH, "sexe", "grade_principal"])


def pay_gap(base: DataFrame) -> DataFrame:
    """Women's mean pay relative to men's, per month and grade."""
    cells = _sexed(_graded(base)).groupBy(*MONTH, "grade_principal", "sexe").agg(
        count_rows("effectif"), whole(F.avg(VALUE)).alias("revenu_moyen")
    )

    def of(sex: str, col: str) -> Column:
        return F.max(F.when(F.col("sexe") == sex, F.col(col)))

    men, women = F.col("salaire_moyen_homme"), F.col("salaire_moyen_femme")
    return (
        cells.groupBy(*MONTH, "grade_principal")
        .agg(
            of("Homme", "revenu_moyen").alias("salaire_moyen_homme"),
            of("Femme", "revenu_moyen").alias("salaire_moyen_femme"),
            of("Homme", "effectif").alias("effectif_homme"),
            of("Femme", "effectif").alias("effectif_femme"),
        )
        .withColumn("ecart_pct_hf", F.round((women - men) / F.nullif(men, F.lit(0.0)) * 100, 1))
    )


def indicators_bareme(base: DataFrame) -> DataFrame:
    return _indicators(base, [*MONTH, "bareme"])


def indicators_bareme_grade(base: DataFrame) -> DataFrame:
    return _indicators(_graded(base), [*MONTH, "bareme", "grade_principal"], bounds=False)


def indicators_bareme_sex(base: DataFrame) -> DataFrame:
    return _indicators(_sexed(base), [*MONTH, "bareme", "sexe"], bounds=False)


def _posts(base: DataFrame) -> DataFrame:
    return base.groupBy(*MONTH, "grade_principal", "matricule").agg(count_rows("nb_postes"))


def posts_by_grade(base: DataFrame) -> DataFrame:
    return _posts(base).groupBy(*MONTH, "grade_principal", "nb_postes").agg(count_rows("effectif"))


def multi_post_rate(base: DataFrame) -> DataFrame:
    """Agents and share of agents with several posts; one row per agent remains, so a count suffices."""
    agents = F.count("matricule")
    multi = F.count_if(F.col("nb_postes") > 1)
    return (
        _posts(_graded(base))
        .groupBy(*MONTH, "grade_principal")
        .agg(
            agents.alias("total_agents"),
            multi.alias("agents_multipostes"),
            F.round(multi * 100.0 / F.nullif(agents, F.lit(0)), 1).alias("taux_multipostes_pct"),
        )
    )


def yearly_kpis(base: DataFrame) -> DataFrame:
    extra = [
        F.count_distinct("matricule").alias("nb_agents_distincts"),
        whole(F.sum(VALUE)).alias("masse_salariale_brute"),
    ]
    keys = ["annee", "grade_principal", "bareme", "sexe"]
    return _indicators(base, keys, bounds=False, extra=extra).withColumnRenamed("effectif", "nb_observations")


def refresh_control(base: DataFrame) -> DataFrame:
    """Rows, first and last month, number of months."""
    return base.agg(
        count_rows("total_lignes"),
        F.min("date_mois").alias("periode_debut"),
        F.max("date_mois").alias("periode_fin"),
        F.count_distinct(period_label("annee", "mois")).alias("nb_mois"),
    )


def refresh_control_bareme(base: DataFrame) -> DataFrame:
    """Agents per pay scale in the last month."""
    last = base.agg(F.max("date_mois")).scalar()
    return base.where(F.col("date_mois") == last).groupBy("bareme").agg(F.count_distinct("matricule").alias("agents"))
