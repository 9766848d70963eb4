"""Longitudinal coherence flags and their reports.

All comparisons with the previous row of a person come from one ordered pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.functions.dates import first_of_month, years_between
from paypanel.functions.grades import lookup
from paypanel.functions.people import MARITAL_FLAG_CODES, sex_letter
from paypanel.functions.text import norm_label_lower
from paypanel.operators.aggregates import count_rows
from paypanel.operators.quality import duplicate_flag
from paypanel.operators.quantiles import Quantile, group_quantiles
from paypanel.operators.skew import HOT_ROWS, join_back, with_previous
from paypanel.plans.stages import written

KEY = "matricule"

# Known situation spellings and the final status each one implies.
KNOWN_STATUSES = [
    "en activite", "disponibilite", "detachement", "suspension", "fin de contrat", "fin d'engagement", "retraite",
    "retraite pour limite age", "retraite pour anciennete", "deces", "arret recensement 2011", "abandon de poste",
    "regul. indemnites", "sous controle // traitement", "arret police", "viol",
]
EXPECTED_STATUS = {
    (
        "en activite", "detachement", "disponibilite", "suspension", "retraite", "retraite pour limite age",
        "retraite pour anciennete",
    ): "fonctionnaire",
    "fin de contrat": "non-fonctionnaire",
}

FLAG_GROUPS = {
    "situation_matrimoniale": [
        "FLAG_SITMAT_INCONNU", "FLAG_SITMAT_NON_MAPPEE", "FLAG_SITMAT_AGE", "FLAG_SITMAT_ENFANTS",
        "FLAG_SITMAT_VARIATION", "FLAG_SITMAT_VARIATIONS",
    ],
    "enfants": [
        "FLAG_ENFANTS_AGE", "FLAG_ENFANTS_FERT_IRR", "FLAG_ENFANTS_NEGATIF", "FLAG_ENFANTS_OUTLIER",
        "FLAG_ENFANTS_MANQUANT", "FLAG_ENFANTS_DESCENTE",
    ],
    "sexe": ["FLAG_SEXE_INVALIDE", "FLAG_SEXE_INCONNU", "FLAG_SEXE_VARIATION"],
    "age": ["FLAG_AGE_OUTLIER", "FLAG_AGE_DECROIT", "FLAG_AGE_TROP_RAPIDE"],
    "prise_service": ["FLAG_AGE_PS_GE_AGE", "FLAG_AGE_PS_VARIATION", "FLAG_AGE_PS_OUTLIER", "FLAG_AGE_PS_NEGATIF"],
    "anciennete": ["FLAG_ANC_NEGATIVE", "FLAG_ANC_IDENTITE_IRR", "FLAG_ANC_BAISSE", "FLAG_ANC_VITESSE_IRR"],
    "statut": [
        "FLAG_STATUT_NON_MAPPE", "FLAG_STATUT_DEF_INCOHERENT", "FLAG_STATUT_DEF_INCONNU", "FLAG_AGE_RETRAITE_IRR",
        "FLAG_STATUT_VARIATION", "FLAG_STATUT_DEF_VARIATION", "FLAG_STATUT_MULTI", "FLAG_STATUT_TROU",
    ],
}
ALL_FLAGS = [f for flags in FLAG_GROUPS.values() for f in flags]


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def coherence_flags(
    df: DataFrame,
    age: str = "AGE",
    age_start: str = "AGE_PS",
    tenure: str = "ANCIENNETE",
    children: str = "ENFANTS",
    status: str = "situation",
    final_status: str = "STATUT_DEF",
    max_drift: float = 0.25,
    age_range: tuple[int, int] = (18, 75),
    start_range: tuple[int, int] = (14, 60),
    max_children: int = 12,
    retirement_age: int = 50,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All flags of ``FLAG_GROUPS`` as 0/1 columns on the rows."""
    marital = norm_label_lower("situation_matrimoniale")
    d = df.withColumns(
        {
            "_ref": first_of_month("annee", "mois"),
            "_mar_norm": marital,
            "_mar_code": lookup(marital, MARITAL_FLAG_CODES),
            "_sex": sex_letter("sexe"),
            "_st": norm_label_lower(status),
            "_sd": norm_label_lower(final_status),
        }
    ).withColumn("_mar", F.coalesce("_mar_code", F.lit("autres")))
    watched = ["_ref", "_mar", "_sex", "_st", "_sd", age, age_start, tenure, children]
    d = with_previous(d, KEY, watched, hot_rows=hot_rows)

    a, ps, anc, kids = (F.col(c) for c in (age, age_start, tenure, children))

    def prev(c: str) -> Column:
        return F.col(f"{c}__prev")

    def changed(c: str) -> Column:
        return F.col(c) != prev(c)

    elapsed = F.coalesce(years_between(prev("_ref"), F.col("_ref")), F.lit(0.0))
    expected = lookup(F.col("_st"), EXPECTED_STATUS, F.lit("cas particulier"))
    flags = {
        "FLAG_SITMAT_INCONNU": F.col("_mar_norm").isNull(),
        "FLAG_SITMAT_NON_MAPPEE": F.col("_mar_norm").isNotNull() & F.col("_mar_code").isNull(),
        "FLAG_SITMAT_AGE": (F.col("_mar") == "marie(e)") & (a < 18),
        "FLAG_SITMAT_ENFANTS": (F.col("_mar") == "celibataire") & (kids > 0),
        "FLAG_SITMAT_VARIATION": changed("_mar"),
        "FLAG_ENFANTS_AGE": (a < 15) & (kids > 0),
        "FLAG_ENFANTS_FERT_IRR": kids > a - 12,
        "FLAG_ENFANTS_NEGATIF": kids < 0,
        "FLAG_ENFANTS_OUTLIER": kids > max_children,
        "FLAG_ENFANTS_MANQUANT": kids.isNull(),
        "FLAG_ENFANTS_DESCENTE": kids < prev(children),
        "FLAG_SEXE_INVALIDE": F.col("_sex").isNull(),
        "FLAG_SEXE_INCONNU": F.col("_sex").isNull(),
        "FLAG_SEXE_VARIATION": changed("_sex"),
        "FLAG_AGE_OUTLIER": (a < age_range[0]) | (a > age_range[1]),
        "FLAG_AGE_DECROIT": a < prev(age),
        "FLAG_AGE_TROP_RAPIDE": a - prev(age) > elapsed + max_drift,
        "FLAG_AGE_PS_GE_AGE": ps >= a,
        "FLAG_AGE_PS_VARIATION": changed(age_start),
        "FLAG_AGE_PS_OUTLIER": (ps < start_range[0]) | (ps > start_range[1]),
        "FLAG_AGE_PS_NEGATIF": ps < 0,
        "FLAG_ANC_NEGATIVE": anc < 0,
        "FLAG_ANC_IDENTITE_IRR": F.abs(a - (ps + anc)) > 1.0,
        "FLAG_ANC_BAISSE": anc < prev(tenure),
        "FLAG_ANC_VITESSE_IRR": anc - prev(tenure) > elapsed + max_drift,
        "FLAG_STATUT_NON_MAPPE": ~F.col("_st").isin(*KNOWN_STATUSES),
        "FLAG_STATUT_DEF_INCOHERENT": F.col("_sd") != expected,
        "FLAG_STATUT_DEF_INCONNU": F.col("_sd").isNull(),
        "FLAG_AGE_RETRAITE_IRR": F.col("_st").contains("retraite") & (a < retirement_age),
        "FLAG_STATUT_VARIATION": changed("_st"),
        "FLAG_STATUT_DEF_VARIATION": changed("_sd"),
    }
    # read twice below, so the ordered pass is written once, without what only the flags above need
    helpers = ["_ref", "_mar_norm", "_mar_code", "_mar", "_sex", "_sd"]
    d = d.withColumns({name: _flag(cond) for name, cond in flags.items()}).drop(*helpers, *[f"{c}__prev" for c in watched])
    d = written(d, "flags")

    # empty and missing status count as one; the months of a (person, year) are few
    st, changes = F.coalesce("_st", F.lit("")), F.sum(F.sum("FLAG_SITMAT_VARIATION")).over(Window.partitionBy(KEY, "annee"))
    monthly = d.groupBy(KEY, "annee", "mois").agg(
        _flag(changes >= 2).alias("FLAG_SITMAT_VARIATIONS"),
        _flag(F.min(st) < F.max(st)).alias("FLAG_STATUT_MULTI"),
        _flag(F.count("_st") == 0).alias("FLAG_STATUT_TROU"),
    )
    return join_back(d, monthly, [KEY, "annee", "mois"]).drop("_st")


def amount_flags(
    df: DataFrame, value: str = "montant_net", brut: str = "montant_brut", low: float = 0.01, high: float = 0.995
) -> DataFrame:
    """Missing, extreme, negative, zero, net above gross and repeated (person, month)."""
    q = group_quantiles(df, [], {"lo": Quantile(value, low), "hi": Quantile(value, high)})
    lo, hi = q.select("lo").scalar(), q.select("hi").scalar()
    v = F.col(value)
    flags = {
        "FLAG_MONTANT_MANQUANT": v.isNull(),
        "FLAG_MONTANT_TRES_BAS": (v > 0) & (v < lo),
        "FLAG_MONTANT_TRES_ELEVE": v > hi,
        "FLAG_MONTANT_NEGATIF": v < 0,
        "FLAG_MONTANT_ZERO": v == 0,
        "FLAG_MONTANT_NET_SUP_BRUT": v > F.col(brut),
    }
    return duplicate_flag(df.withColumns({n: _flag(c) for n, c in flags.items()}), [KEY, "periode"])


def jump_flags(df: DataFrame, value: str = "montant_net", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Amount below half or above twice the person's previous one."""
    d = with_previous(df, KEY, [value], hot_rows=hot_rows)
    v, p = F.col(value), F.col(f"{value}__prev")
    return d.withColumns(
        {"FLAG_MONTANT_BAISSE_FORTE": _flag(v < p * 0.5), "FLAG_MONTANT_HAUSSE_FORTE": _flag(v > p * 2.0)}
    ).drop(f"{value}__prev")


def previous_change(df: DataFrame, col: str, out: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """1 where a value differs from the person's previous row, both known."""
    d = with_previous(df, KEY, [col], hot_rows=hot_rows)
    return d.withColumn(out, _flag(F.col(col) != F.col(f"{col}__prev"))).drop(f"{col}__prev")


def missing_years(df: DataFrame) -> DataFrame:
    """Persons absent for whole years between their first and last one, with both lists.

    The set of a person holds calendar years, so it is as short as the calendar.
    """
    years = df.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.sort_array(F.collect_set("annee")).alias("presentes"))
    gap = F.array_except(F.sequence(F.array_min("presentes"), F.array_max("presentes")), F.col("presentes"))
    return (
        years.withColumn("manquantes", gap)
        .where(F.size("manquantes") > 0)
        .select(
            KEY,
            F.concat_ws(",", F.col("presentes").cast("array<string>")).alias("annees_presentes"),
            F.concat_ws(",", F.col("manquantes").cast("array<string>")).alias("annees_manquantes"),
            F.size("manquantes").alias("nb_annees_manquantes"),
        )
    )


def missing_year_flag(df: DataFrame) -> DataFrame:
    gaps = missing_years(df).select(KEY, F.lit(1).alias("FLAG_ANNEE_MANQUANTE"))
    return join_back(df, gaps, [KEY]).withColumn(
        "FLAG_ANNEE_MANQUANTE", F.coalesce("FLAG_ANNEE_MANQUANTE", F.lit(0))
    )


def numeric_id_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("FLAG_MATRICULE_NUMERIQUE", _flag(F.col(KEY).rlike("^[0-9]+$")))


# ---------------------------------------------------------------- reports


def flag_kpis(df: DataFrame, flags: list[str]) -> DataFrame:
    """Flagged rows and rate per flag."""
    sums = df.agg(count_rows("_n"), *[F.sum(f).alias(f) for f in flags])
    long = sums.unpivot(["_n"], flags, "flag", "effectif")
    return long.select("flag", "effectif", F.round(F.col("effectif") * 100.0 / F.col("_n"), 2).alias("taux_pct"))


def _row_flags(flags: list[str]) -> Column:
    return reduce(lambda x, y: x + y, [F.col(f) for f in flags])


def flagged_persons(df: DataFrame, flags: list[str]) -> DataFrame:
    """Flagged rows and total flags per person."""
    n = _row_flags(flags)
    return df.groupBy(KEY).agg(
        F.count_if(n > 0).alias("nb_lignes_flaggees"), F.sum(n).alias("nb_flags_total")
    )


def category_extract(df: DataFrame, category: str, ids: list[str]) -> DataFrame:
    """Rows with at least one flag of the category, and how many."""
    flags = FLAG_GROUPS[category]
    return (
        df.withColumn("nb_flags_categorie", _row_flags(flags))
        .where(F.col("nb_flags_categorie") > 0)
        .select(*ids, *flags, "nb_flags_categorie")
    )


def flag_summary(df: DataFrame, flags: list[str]) -> DataFrame:
    return df.agg(
        count_rows("total_lignes"),
        F.lit(len(flags)).alias("total_flags_distincts"),
        F.count_distinct(KEY).alias("total_matricules"),
        F.count_if(_row_flags(flags) > 0).alias("lignes_avec_flag"),
    )


def context_export(df: DataFrame, flag: str, description: str, cols: list[str]) -> DataFrame:
    """Every row of the persons flagged at least once, with the description of the problem."""
    who = df.where(F.col(flag) == 1).select(KEY).distinct()
    return df.join(who, KEY, "left_semi").select(KEY, *cols, flag, F.lit(description).alias("description_probleme"))


def flag_intervals(df: DataFrame, flag: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Months between consecutive flagged rows of a person, one row per interval."""
    marked = df.where(F.col(flag) == 1).withColumn("_i", F.col("annee") * 12 + F.col("mois"))
    d = with_previous(marked.select(KEY, "periode", "row_id", "_i"), KEY, ["_i"], hot_rows=hot_rows)
    return d.where(F.col("_i__prev").isNotNull()).select(
        KEY, "periode", "row_id", (F.col("_i") - F.col("_i__prev")).alias("intervalle_mois")
    )


def flag_matrix(df: DataFrame, flag: str, value: str, years: list[int], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per flagged person: number of variations, interval statistics, and per year the first
    amount, whether a flag occurred and its first month."""
    gaps = flag_intervals(df, flag, hot_rows).groupBy(KEY).agg(
        F.round(F.avg("intervalle_mois"), 1).alias("intervalle_moyen"),
        F.min("intervalle_mois").alias("intervalle_min"),
        F.max("intervalle_mois").alias("intervalle_max"),
    )
    count = df.groupBy(KEY).agg(F.sum(flag).alias("nb_variations")).where(F.col("nb_variations") > 0)
    first = F.min_by(F.struct(F.col(value).alias("v")), F.struct("periode", "row_id")).getField("v")
    wide = (
        df.join(count.select(KEY), KEY, "left_semi")
        .groupBy(KEY)
        .pivot("annee", years)
        .agg(
            first.alias("montant"),
            F.max(flag).alias("flag"),
            F.min(F.when(F.col(flag) == 1, F.col("mois"))).alias("mois"),
        )
    )
    return count.join(gaps, KEY, "left").join(wide, KEY, "left")
