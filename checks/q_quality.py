"""Quality controls, person variables and coherence flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.frames import frame, graded, rounded, silver
from checks.q_scalars import cats
from checks.registry import define, register
from paypanel.functions.dates import age_at_start, age_years, clean_date, month_end, tenure_years
from paypanel.functions.text import norm_label
from paypanel.operators import coherence as coh
from paypanel.operators import persons as per
from paypanel.operators import quality as qua
from paypanel.plans.stages import layer, written

SRC = "panel_src"
KEYCOLS = ["matricule", "sexe", "CODE_ORGANISME", "CODE_EMPLOI", "montant_brut"]


@register(
    "q01_completeness",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS colonne, count({c}) AS non_nuls, count(*) AS total, round(count({c}) * 100.0::DOUBLE / count(*), 1) AS pct,
round(count({c}) * 100.0::DOUBLE / count(*), 1) < 95 AS alerte FROM silver"""
        for c in KEYCOLS
    ),
)
def _(spark, sf):
    return qua.completeness(silver(spark, sf), KEYCOLS)


@register(
    "q02_null_rates",
    " UNION ALL ".join(
        f"SELECT annee, '{c}' AS colonne, round(count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*), 1) AS pct_na FROM silver GROUP BY 1"
        for c in KEYCOLS
    ),
)
def _(spark, sf):
    return qua.null_rates(silver(spark, sf), KEYCOLS)


define(
    "patchy",
    """SELECT annee, CASE WHEN annee = 1996 THEN NULL ELSE sexe END AS a, CASE WHEN annee <> 1997 THEN NULL ELSE matricule END AS b FROM silver""",
)


@register(
    "q02_suspicious",
    """WITH r AS (SELECT annee, 'a' AS colonne, round(avg(CAST(a IS NULL AS INTEGER)) * 100, 1) AS p FROM patchy GROUP BY 1
  UNION ALL SELECT annee, 'b', round(avg(CAST(b IS NULL AS INTEGER)) * 100, 1) FROM patchy GROUP BY 1)
SELECT colonne, min(p) AS mini, max(p) AS maxi FROM r GROUP BY 1 HAVING max(p) > 95 AND min(p) < 5""",
)
def _(spark, sf):
    d = silver(spark, sf).select(
        "annee",
        F.when(F.col("annee") != 1996, F.col("sexe")).alias("a"),
        F.when(F.col("annee") == 1997, F.col("matricule")).alias("b"),
    )
    return qua.suspicious_columns(d, ["a", "b"])


@register("q03_duplicates", "SELECT matricule, mois_annee, count(*) AS n FROM silver GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, sf):
    return qua.duplicates(silver(spark, sf), ["matricule", "mois_annee"])


@register(
    "q03_duplicate_flag",
    """SELECT row_id, CAST((SELECT count(*) FROM silver k WHERE k.matricule = s.matricule AND k.periode = s.periode) > 1 AS INTEGER)
AS "FLAG_DOUBLON_STRICT" FROM silver s""",
)
def _(spark, sf):
    return qua.duplicate_flag(silver(spark, sf), ["matricule", "periode"]).select("row_id", "FLAG_DOUBLON_STRICT")


@register(
    "q04_net_above_brut",
    """SELECT count(*) FILTER (WHERE montant_net > montant_brut) AS n, count(*) AS total,
round(count(*) FILTER (WHERE montant_net > montant_brut) * 100.0::DOUBLE / count(*), 2) AS pct FROM silver""",
)
def _(spark, sf):
    return qua.net_above_brut(silver(spark, sf))


@register(
    "q05_situations",
    """SELECT situation_normalisee, count(*) AS nb, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM graded), 2) AS pct FROM graded GROUP BY 1""",
)
def _(spark, sf):
    return qua.situation_distribution(graded(spark, sf))


@register(
    "q06_match_rate_range",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS code, min(t) AS minimum, max(t) AS maximum, round(avg(t), 8) AS moyenne FROM (
SELECT round(count({c}) * 100.0::DOUBLE / count(*), 1) AS t FROM silver GROUP BY periode)"""
        for c in ("CODE_ORGANISME", "CODE_EMPLOI")
    ),
)
def _(spark, sf):
    return rounded(qua.match_rate_range(silver(spark, sf), ["CODE_ORGANISME", "CODE_EMPLOI"]), 8, "moyenne")


@register(
    "q07_not_exactly_one",
    """SELECT row_id FROM panel_src WHERE (montant_brut IS NULL AND montant_net IS NULL) OR (montant_brut IS NOT NULL AND montant_net IS NOT NULL)""",
)
def _(spark, sf):
    return qua.not_exactly_one(frame(spark, sf, SRC), ["montant_brut", "montant_net"]).select("row_id")


@register(
    "q08_exclusivity",
    """SELECT annee, count(*) AS lignes, 'montant' AS base, count(*) FILTER (WHERE montant_brut IS NOT NULL AND montant_net IS NOT NULL) AS violations
FROM silver GROUP BY 1 UNION ALL SELECT annee, count(*), 'code', count(*) FILTER (WHERE CODE_ORGANISME IS NOT NULL AND CODE_EMPLOI IS NOT NULL)
FROM silver GROUP BY 1""",
)
def _(spark, sf):
    groups = {"montant": ["montant_brut", "montant_net"], "code": ["CODE_ORGANISME", "CODE_EMPLOI"]}
    return qua.exclusivity(silver(spark, sf), groups)


define("items", "SELECT l_orderkey AS row_id, sum(l_extendedprice) FILTER (WHERE l_linenumber = 1) AS a, sum(l_extendedprice) FILTER (WHERE l_linenumber = 2) AS b FROM lineitem GROUP BY 1")


@register(
    "q09_sum_mismatch",
    """SELECT s.row_id, round(coalesce(a, 0) + coalesce(b, 0), 4) AS sum_all, s.montant_brut AS reference,
round(abs(coalesce(a, 0) + coalesce(b, 0) - s.montant_brut), 4) AS abs_diff,
round(abs(coalesce(a, 0) + coalesce(b, 0) - s.montant_brut) / s.montant_brut, 6) AS rel_diff
FROM silver s JOIN items i ON i.row_id = s.row_id WHERE (a IS NOT NULL OR b IS NOT NULL)
AND abs(coalesce(a, 0) + coalesce(b, 0) - s.montant_brut) > 1000 AND abs(coalesce(a, 0) + coalesce(b, 0) - s.montant_brut) / s.montant_brut > 0.25""",
)
def _(spark, sf):
    from paypanel.operators.silver import pivot_paycodes

    wide = pivot_paycodes(frame(spark, sf, "paycodes"), ["row_id"], ["124", "228"])
    d = silver(spark, sf).join(wide, "row_id")
    out = qua.sum_mismatch(d, ["124", "228"], "montant_brut", 1000.0, 0.25)
    out = out.select("row_id", "sum_all", "reference", "abs_diff", "rel_diff")
    return rounded(rounded(out, 4, "sum_all", "abs_diff"), 6, "rel_diff")


@register(
    "q10_ambiguous_codes",
    "SELECT CODE_EMPLOI AS code, count(DISTINCT organisme) AS n_libelles FROM silver WHERE CODE_EMPLOI IS NOT NULL GROUP BY 1 HAVING count(DISTINCT organisme) > 1",
)
def _(spark, sf):
    d = silver(spark, sf).select(F.col("CODE_EMPLOI").alias("code"), F.col("organisme").alias("libelle"))
    return qua.ambiguous_codes(d.where("code IS NOT NULL"), "code", "libelle")


@register(
    "q10_normalized_duplicates",
    """SELECT DISTINCT k, libelle, code FROM (SELECT *, trim(replace(upper(libelle), ' - ', '')) AS k FROM dim_organisme)
WHERE k IN (SELECT k FROM several)""",
)
def _(spark, sf):
    d = frame(spark, sf, "dim_organisme").withColumn("k", norm_label("libelle"))
    return qua.normalized_duplicates(d, "k", "libelle", "code")


@register(
    "q25_layer_trace",
    """SELECT 'bronze' AS couche, periode, count(*) AS lignes, count(*) FILTER (WHERE sexe IS NULL) AS sexe_nuls,
count(*) FILTER (WHERE CODE_EMPLOI IS NULL) AS "CODE_EMPLOI_nuls" FROM panel_src GROUP BY 2
UNION ALL SELECT 'silver', periode, count(*), count(*) FILTER (WHERE sexe IS NULL), count(*) FILTER (WHERE CODE_EMPLOI IS NULL) FROM silver GROUP BY 2""",
)
def _(spark, sf):
    return qua.layer_trace({"bronze": frame(spark, sf, SRC), "silver": silver(spark, sf)}, ["sexe", "CODE_EMPLOI"])


@register(
    "q25_kept_share",
    """WITH s AS (SELECT periode, count(*) AS lignes, count(*) FILTER (WHERE situation_normalisee <> 'autre') AS gardees,
  round(count(*) FILTER (WHERE situation_normalisee <> 'autre') * 100.0::DOUBLE / count(*), 2) AS pct FROM graded GROUP BY 1)
SELECT *, round(pct - (SELECT pct FROM s WHERE periode = 199601), 2) AS ecart_temoin FROM s""",
)
def _(spark, sf):
    return qua.kept_share(graded(spark, sf), F.col("situation_normalisee") != "autre", 199601)


@register(
    "q26_inconstant",
    "SELECT matricule, count(DISTINCT prise_service) AS n_valeurs FROM panel_src GROUP BY 1 HAVING count(DISTINCT prise_service) > 1",
)
def _(spark, sf):
    return qua.inconstant(frame(spark, sf, SRC), "matricule", "prise_service")


@register(
    "q27_conflicting_statuses",
    "SELECT matricule, annee, count(DISTINCT STATUT) AS nb_statuts FROM stat GROUP BY 1, 2 HAVING count(DISTINCT STATUT) > 1",
)
def _(spark, sf):
    return qua.conflicting_statuses(cats(spark, sf), ["matricule", "annee"], "STATUT")


@register(
    "q28_period_vs_date",
    """SELECT row_id, coalesce(date_trunc('month', debut) = make_date(annee, mois, 1), false) AS meme_mois,
CAST(datediff('month', make_date(annee, mois, 1), debut) AS INTEGER) AS ecart_mois,
CAST(debut - make_date(annee, mois, 1) AS INTEGER) AS ecart_jours FROM births""",
)
def _(spark, sf):
    d = graded(spark, sf).withColumn("debut", F.col("prise_service").cast("date"))
    return qua.period_vs_date(d, "debut").select("row_id", "meme_mois", "ecart_mois", "ecart_jours")


@register(
    "q29_headcount_anomaly",
    """WITH c AS (SELECT annee, mois, GRADE, count(*) AS effectif FROM silver GROUP BY 1, 2, 3),
  m AS (SELECT annee, GRADE, list_sort(list(effectif))[CAST(count(*) // 2 + 1 AS BIGINT)] AS mediane FROM c GROUP BY 1, 2)
SELECT c.*, m.mediane, c.effectif < m.mediane * 0.5::DOUBLE AS anomalie FROM c JOIN m ON m.annee = c.annee AND m.GRADE = c.GRADE""",
)
def _(spark, sf):
    return qua.headcount_anomaly(silver(spark, sf), 0.5)


@register(
    "q29_headcount_totals",
    """SELECT annee, coalesce(CAST(mois AS VARCHAR), 'TOTAL') AS mois, coalesce(GRADE, 'TOTAL') AS GRADE, count(*) AS effectif
FROM silver GROUP BY GROUPING SETS ((annee, mois, GRADE), (annee, mois), (annee, GRADE), (annee))""",
)
def _(spark, sf):
    return qua.headcount_totals(silver(spark, sf))


# ------------------------------------------------------------------ person variables

define(
    "sexed",
    """WITH x AS (SELECT *, CASE SEXE_STD WHEN 'Homme' THEN 'M' WHEN 'Femme' THEN 'F' END AS s FROM births),
  l AS (SELECT matricule, arg_max(s, periode * 10000000000 + row_id) FILTER (WHERE s IS NOT NULL) AS SEXE_CLEAN FROM x GROUP BY 1),
  y AS (SELECT x.*, l.SEXE_CLEAN FROM x JOIN l ON l.matricule = x.matricule),
  c AS (SELECT annee, mois, SEXE_CLEAN AS s, count(*) AS n FROM y WHERE SEXE_CLEAN IS NOT NULL GROUP BY 1, 2, 3),
  m AS (SELECT annee, mois, min(s) AS s FROM c a WHERE n = (SELECT max(n) FROM c b WHERE b.annee = a.annee AND b.mois = a.mois) GROUP BY 1, 2)
SELECT y.*, coalesce(y.SEXE_CLEAN, m.s) AS SEXE_IMPUTE FROM y LEFT JOIN m ON m.annee = y.annee AND m.mois = y.mois""",
)
define(
    "aged",
    """WITH l AS (SELECT matricule, arg_max(naissance, periode * 10000000000 + row_id) FILTER (WHERE naissance IS NOT NULL) AS n FROM sexed GROUP BY 1),
  a AS (SELECT s.*, year(collecte) - year(l.n) - CASE WHEN strftime(collecte, '%m%d') < strftime(l.n, '%m%d') THEN 1 ELSE 0 END AS AGE
    FROM sexed s JOIN l ON l.matricule = s.matricule)
SELECT *, CAST(CASE WHEN AGE BETWEEN 18 AND 70 THEN AGE END AS DOUBLE) AS AGE_VALIDE FROM a""",
)
define(
    "age_filled",
    """WITH g AS (SELECT annee, mois, SEXE_IMPUTE, quantile_cont(AGE_VALIDE, 0.5) AS m FROM aged GROUP BY 1, 2, 3),
  o AS (SELECT quantile_cont(AGE_VALIDE, 0.5) AS m FROM aged)
SELECT a.*, round_even(coalesce(AGE_VALIDE, g.m, (SELECT m FROM o)), 0) AS AGE_IMPUTE, coalesce(AGE_VALIDE, round_even(coalesce(g.m, (SELECT m FROM o)), 0)) AS age_base
FROM aged a LEFT JOIN g ON g.annee = a.annee AND g.mois = a.mois AND g.SEXE_IMPUTE = a.SEXE_IMPUTE""",
)
define(
    "age_stable",
    """SELECT a.*, (SELECT arg_max(AGE_IMPUTE, periode * 10000000000 + row_id) FROM age_filled b WHERE b.matricule = a.matricule) AS AGE_IMPUTE_STABLE
FROM age_filled a""",
)


def with_sex(spark, sf):
    return per.impute_sex(per.add_collection_date(graded(spark, sf)))


PERSON_COLS = ["row_id", "matricule", "periode", "annee", "mois", "mois_annee", "sexe", "date_naissance", "prise_service"]


def variables(spark, sf):
    """The person variables as a written layer; its cuts hold only the columns that the variables are made of."""
    return layer(spark, f"persons {sf}", lambda: per.person_variables(graded(spark, sf).select(*PERSON_COLS)))


@register("i12_impute_sex", "SELECT row_id, SEXE_CLEAN, SEXE_IMPUTE FROM sexed")
def _(spark, sf):
    return with_sex(spark, sf).select("row_id", "SEXE_CLEAN", "SEXE_IMPUTE")


@register(
    "i04_build_age",
    "SELECT row_id, CAST(AGE AS INTEGER) AS AGE, AGE_VALIDE, AGE_IMPUTE, AGE_IMPUTE_STABLE FROM age_stable",
)
def _(spark, sf):
    return variables(spark, sf).select("row_id", "AGE", "AGE_VALIDE", "AGE_IMPUTE", "AGE_IMPUTE_STABLE")


@register(
    "i04_age_stable_median",
    """SELECT matricule, quantile_cont(AGE_IMPUTE, 0.5) AS age_median FROM age_filled GROUP BY 1""",
)
def _(spark, sf):
    d = per.stabilize(variables(spark, sf), "AGE_IMPUTE", "age_median", "median")
    return d.select("matricule", "age_median").distinct()


define(
    "first_age",
    """SELECT matricule, arg_min(age_base, epoch(collecte) * 1000000 + row_id) AS a0, min(collecte) AS d0,
  arg_min(AGE_VALIDE, epoch(collecte) * 1000000 + row_id) FILTER (WHERE AGE_VALIDE IS NOT NULL) AS a1,
  min(collecte) FILTER (WHERE AGE_VALIDE IS NOT NULL) AS d1 FROM age_filled GROUP BY 1""",
)


@register(
    "i05_age_coherent",
    """SELECT a.row_id, round_even(coalesce(f.a1, f.a0) + (a.collecte - CASE WHEN f.a1 IS NULL THEN f.d0 ELSE f.d1 END) / 365.25::DOUBLE, 0) AS "AGE_COHERENT"
FROM age_filled a JOIN first_age f ON f.matricule = a.matricule""",
)
def _(spark, sf):
    return per.age_coherent(variables(spark, sf)).select("row_id", "AGE_COHERENT")


define(
    "served",
    """WITH l AS (SELECT matricule, max(periode * 10000000000 + row_id) AS k FROM age_stable GROUP BY 1),
  p AS (SELECT s.matricule, s.debut AS ps FROM age_stable s JOIN l ON l.matricule = s.matricule AND l.k = s.periode * 10000000000 + s.row_id)
SELECT s.*, p.ps, AGE_IMPUTE_STABLE - floor((collecte - p.ps) / 365.0::DOUBLE) AS AGE_AU_SERVICE FROM age_stable s JOIN p ON p.matricule = s.matricule""",
)
define(
    "served_filled",
    """WITH v AS (SELECT *, CASE WHEN AGE_AU_SERVICE BETWEEN 18 AND 40 THEN AGE_AU_SERVICE END AS AGE_AU_SERVICE_VALIDE FROM served),
  g AS (SELECT annee, mois, SEXE_IMPUTE, quantile_cont(AGE_AU_SERVICE_VALIDE, 0.5) AS m FROM v GROUP BY 1, 2, 3),
  o AS (SELECT quantile_cont(AGE_AU_SERVICE_VALIDE, 0.5) AS m FROM v)
SELECT v.*, round_even(coalesce(AGE_AU_SERVICE_VALIDE, g.m, (SELECT m FROM o)), 0) AS AGE_AU_SERVICE_IMPUTE
FROM v LEFT JOIN g ON g.annee = v.annee AND g.mois = v.mois AND g.SEXE_IMPUTE = v.SEXE_IMPUTE""",
)
define(
    "served_mode",
    """WITH c AS (SELECT matricule, AGE_AU_SERVICE_IMPUTE AS v, count(*) AS n FROM served_filled GROUP BY 1, 2)
SELECT matricule, min(v) FILTER (WHERE n = m) AS f, count(*) AS k FROM (SELECT *, max(n) OVER (PARTITION BY matricule) AS m FROM c) GROUP BY 1""",
)


@register(
    "i06_build_age_service",
    """SELECT s.row_id, s.AGE_AU_SERVICE, s.AGE_AU_SERVICE_VALIDE, s.AGE_AU_SERVICE_IMPUTE, CAST(m.k > 1 AS INTEGER) AS FLAG_MULTI_AGE_SERVICE,
m.f AS AGE_AU_SERVICE_FINAL FROM served_filled s JOIN served_mode m ON m.matricule = s.matricule""",
)
def _(spark, sf):
    cols = ["AGE_AU_SERVICE", "AGE_AU_SERVICE_VALIDE", "AGE_AU_SERVICE_IMPUTE", "FLAG_MULTI_AGE_SERVICE", "AGE_AU_SERVICE_FINAL"]
    return variables(spark, sf).select("row_id", *cols)


@register(
    "i11_status_final_month",
    """SELECT row_id, CASE WHEN EXISTS (SELECT 1 FROM stat k WHERE k.matricule = s.matricule AND k.periode = s.periode AND k.STATUT = 'Fonctionnaire') THEN 'Fonctionnaire'
WHEN EXISTS (SELECT 1 FROM stat k WHERE k.matricule = s.matricule AND k.periode = s.periode AND k.STATUT = 'Cas particulier') THEN 'Cas particulier'
ELSE 'Non Fonctionnaire' END AS "STATUT_DEF" FROM stat s""",
)
def _(spark, sf):
    return per.status_final(cats(spark, sf), ["matricule", "periode"]).select("row_id", "STATUT_DEF")


@register(
    "i11_status_final_year",
    """SELECT row_id, CASE WHEN EXISTS (SELECT 1 FROM stat k WHERE k.matricule = s.matricule AND k.annee = s.annee AND k.STATUT = 'Fonctionnaire') THEN 'Fonctionnaire'
WHEN EXISTS (SELECT 1 FROM stat k WHERE k.matricule = s.matricule AND k.annee = s.annee AND k.STATUT = 'Cas particulier') THEN 'Cas particulier'
ELSE 'Non Fonctionnaire' END AS "STATUT_DEF" FROM stat s""",
)
def _(spark, sf):
    return per.status_final(cats(spark, sf), ["matricule", "annee"]).select("row_id", "STATUT_DEF")


@register(
    "i17_age_service_stable",
    """WITH u AS (SELECT matricule, AGE_IMPUTE, ps, collecte, row_number() OVER (PARTITION BY matricule ORDER BY periode, row_id) AS r,
    count(*) OVER (PARTITION BY matricule) AS n FROM served_filled WHERE ps IS NOT NULL),
  v AS (SELECT matricule, r, n, AGE_IMPUTE - (collecte - ps) / 365.25::DOUBLE AS x FROM u),
  w AS (SELECT matricule, max(x) FILTER (WHERE r = 1) AS x1, max(x) FILTER (WHERE r = n // 2 + 1) AS x2, max(x) FILTER (WHERE r = n) AS x3 FROM v GROUP BY 1)
SELECT p.matricule, round(CASE WHEN x1 BETWEEN 14 AND 60 THEN x1 WHEN x2 BETWEEN 14 AND 60 THEN x2 WHEN x3 BETWEEN 14 AND 60 THEN x3
  ELSE greatest(x1, x2, x3) END, 6) AS "AGE_AU_SERVICE",
CASE WHEN x1 IS NULL THEN 'AUCUNE_DONNEE' WHEN x1 BETWEEN 14 AND 60 THEN 'PREMIERE_OBS' WHEN x2 BETWEEN 14 AND 60 THEN 'OBS_MEDIANE'
  WHEN x3 BETWEEN 14 AND 60 THEN 'DERNIERE_OBS' WHEN x1 >= x2 AND x1 >= x3 THEN 'PREMIERE_OBS_INVALIDE' WHEN x2 >= x3 THEN 'OBS_MEDIANE_INVALIDE'
  ELSE 'DERNIERE_OBS_INVALIDE' END AS "AGE_SERVICE_METHODE",
round(CASE WHEN x1 BETWEEN 14 AND 60 THEN x1 WHEN x2 BETWEEN 14 AND 60 THEN x2 WHEN x3 BETWEEN 14 AND 60 THEN x3 END, 6) AS "AGE_AU_SERVICE_VALIDE"
FROM (SELECT DISTINCT matricule FROM served_filled) p LEFT JOIN w ON w.matricule = p.matricule""",
)
def _(spark, sf):
    out = per.age_service_stable(variables(spark, sf), "AGE_IMPUTE")
    return rounded(out, 6, "AGE_AU_SERVICE", "AGE_AU_SERVICE_VALIDE")


@register(
    "q30_service_anomaly",
    """SELECT row_id, CASE WHEN a > 40 THEN 'Âge à la prise de service > 40 ans' WHEN a > AGE_IMPUTE THEN 'Âge à la prise de service > âge imputé'
WHEN a < 18 THEN 'Âge à la prise de service < 18 ans' WHEN debut <= naissance THEN 'Prise de service avant ou pendant la naissance' END AS type_anomalie
FROM (SELECT *, floor((debut - naissance) / 365.0::DOUBLE) AS a FROM age_filled)""",
)
def _(spark, sf):
    d = variables(spark, sf).withColumn("debut", F.col("prise_service").cast("date"))
    d = d.withColumn("a", age_at_start("naissance", "debut"))
    return d.select("row_id", qua.service_anomaly_type("naissance", "debut", "a", "AGE_IMPUTE").alias("type_anomalie"))


@register(
    "q31_imputation_exposure",
    """SELECT matricule, round(avg(CASE WHEN AGE_AU_SERVICE_VALIDE IS NULL THEN 1.0::DOUBLE ELSE 0 END), 6) AS part_imputee,
count(DISTINCT concat(annee, '-', mois, '-', SEXE_IMPUTE)) AS nb_groupes FROM served_filled GROUP BY 1""",
)
def _(spark, sf):
    missing = F.col("AGE_AU_SERVICE_VALIDE").isNull()
    d = qua.imputation_exposure(variables(spark, sf), "matricule", missing, ["annee", "mois", "SEXE_IMPUTE"])
    return rounded(d, 6, "part_imputee")


# ------------------------------------------------------------------ coherence flags


FLAG_COLS = [
    "row_id", "matricule", "periode", "annee", "mois", "mois_annee", "sexe", "situation", "situation_matrimoniale",
    "date_naissance", "prise_service", "nombre_enfant", "STATUT",
]


def flag_input(spark, sf):
    d = cats(spark, sf).select(*FLAG_COLS).withColumns(
        {
            "naissance": clean_date("date_naissance"),
            "debut": clean_date("prise_service"),
            "collecte": month_end("mois_annee"),
            "ENFANTS": F.col("nombre_enfant").try_cast("int"),
        }
    )
    d = d.withColumns(
        {
            "AGE": age_years("naissance", "collecte"),
            "AGE_PS": age_at_start("naissance", "debut"),
            "ANCIENNETE": tenure_years("debut", "collecte"),
        }
    )
    return per.status_final(d, ["matricule", "periode"])


def flagged(spark, sf):
    return layer(spark, f"flags {sf}", lambda: coh.coherence_flags(written(flag_input(spark, sf), "input")))


define(
    "fin",
    """WITH b AS (SELECT row_id, max(CASE STATUT WHEN 'Fonctionnaire' THEN 3 WHEN 'Cas particulier' THEN 2 ELSE 1 END) OVER (PARTITION BY matricule, periode) AS r FROM stat)
SELECT g.*, year(collecte) - year(naissance) - CASE WHEN strftime(collecte, '%m%d') < strftime(naissance, '%m%d') THEN 1 ELSE 0 END AS AGE,
floor((debut - naissance) / 365.0::DOUBLE) AS AGE_PS, round_even((collecte - debut) / 365.25::DOUBLE, 2) AS ANC, CAST(nombre_enfant AS INTEGER) AS ENF,
make_date(annee, mois, 1) AS ref, CASE SEXE_STD WHEN 'Homme' THEN 'M' WHEN 'Femme' THEN 'F' END AS sx,
CASE situation_matrimoniale WHEN 'Célibataire' THEN 'celibataire' WHEN 'Femme Mariée' THEN 'marie(e)' ELSE 'autres' END AS mar,
nullif(trim(regexp_replace(translate(lower(strip_accents(situation)), '-_''/.', '     '), '\\s+', ' ', 'g')), '') AS st,
CASE r WHEN 3 THEN 'fonctionnaire' WHEN 2 THEN 'cas particulier' ELSE 'non fonctionnaire' END AS sd
FROM births g JOIN b ON b.row_id = g.row_id""",
)
define(
    "prevd",
    """SELECT *, lag(mar) OVER w AS p_mar, lag(sx) OVER w AS p_sx, lag(st) OVER w AS p_st, lag(sd) OVER w AS p_sd, lag(AGE) OVER w AS p_age,
lag(AGE_PS) OVER w AS p_ps, lag(ANC) OVER w AS p_anc, lag(ENF) OVER w AS p_enf, coalesce((ref - lag(ref) OVER w) / 365.25::DOUBLE, 0) AS el
FROM fin WINDOW w AS (PARTITION BY matricule ORDER BY periode, row_id)""",
)
FLAG_SQL = {
    "FLAG_SITMAT_INCONNU": "situation_matrimoniale IS NULL",
    "FLAG_SITMAT_NON_MAPPEE": "situation_matrimoniale = 'Veuf / veuve'",
    "FLAG_SITMAT_AGE": "mar = 'marie(e)' AND AGE < 18",
    "FLAG_SITMAT_ENFANTS": "mar = 'celibataire' AND ENF > 0",
    "FLAG_SITMAT_VARIATION": "mar <> p_mar",
    "FLAG_ENFANTS_AGE": "AGE < 15 AND ENF > 0",
    "FLAG_ENFANTS_FERT_IRR": "ENF > AGE - 12",
    "FLAG_ENFANTS_NEGATIF": "ENF < 0",
    "FLAG_ENFANTS_OUTLIER": "ENF > 12",
    "FLAG_ENFANTS_MANQUANT": "ENF IS NULL",
    "FLAG_ENFANTS_DESCENTE": "ENF < p_enf",
    "FLAG_SEXE_INVALIDE": "sx IS NULL",
    "FLAG_SEXE_INCONNU": "sx IS NULL",
    "FLAG_SEXE_VARIATION": "sx <> p_sx",
    "FLAG_AGE_OUTLIER": "AGE NOT BETWEEN 18 AND 75",
    "FLAG_AGE_DECROIT": "AGE < p_age",
    "FLAG_AGE_TROP_RAPIDE": "AGE - p_age > el + 0.25::DOUBLE",
    "FLAG_AGE_PS_GE_AGE": "AGE_PS >= AGE",
    "FLAG_AGE_PS_VARIATION": "AGE_PS <> p_ps",
    "FLAG_AGE_PS_OUTLIER": "AGE_PS NOT BETWEEN 14 AND 60",
    "FLAG_AGE_PS_NEGATIF": "AGE_PS < 0",
    "FLAG_ANC_NEGATIVE": "ANC < 0",
    "FLAG_ANC_IDENTITE_IRR": "abs(AGE - (AGE_PS + ANC)) > 1",
    "FLAG_ANC_BAISSE": "ANC < p_anc",
    "FLAG_ANC_VITESSE_IRR": "ANC - p_anc > el + 0.25::DOUBLE",
    "FLAG_STATUT_NON_MAPPE": "st NOT IN ('en activite', 'retraite')",
    "FLAG_STATUT_DEF_INCOHERENT": "sd <> CASE WHEN st IN ('en activite', 'retraite') THEN 'fonctionnaire' ELSE 'cas particulier' END",
    "FLAG_STATUT_DEF_INCONNU": "sd IS NULL",
    "FLAG_AGE_RETRAITE_IRR": "st = 'retraite' AND AGE < 50",
    "FLAG_STATUT_VARIATION": "st <> p_st",
    "FLAG_STATUT_DEF_VARIATION": "sd <> p_sd",
    "FLAG_SITMAT_VARIATIONS": "(SELECT count(*) FROM prevd y WHERE y.matricule = p.matricule AND y.annee = p.annee AND y.mar <> y.p_mar) >= 2",
    "FLAG_STATUT_MULTI": "(SELECT count(DISTINCT coalesce(y.st, '')) FROM fin y WHERE y.matricule = p.matricule AND y.periode = p.periode) > 1",
    "FLAG_STATUT_TROU": "(SELECT count(y.st) FROM fin y WHERE y.matricule = p.matricule AND y.periode = p.periode) = 0",
}
_ORDER = {"situation_matrimoniale": 11, "enfants": 12, "sexe": 13, "age": 14, "prise_service": 15, "anciennete": 16, "statut": 17}
for _cat, _no in _ORDER.items():
    _flags = coh.FLAG_GROUPS[_cat]
    _sel = ", ".join(f'CAST(coalesce({FLAG_SQL[f]}, false) AS INTEGER) AS "{f}"' for f in _flags)

    def _run(spark, sf, flags=tuple(_flags)):
        return flagged(spark, sf).select("row_id", *flags)

    register(f"q{_no}_flags_{_cat}", f"SELECT row_id, {_sel} FROM prevd p")(_run)

define("flag_rows", "SELECT row_id, matricule, " + ", ".join(f'CAST(coalesce({FLAG_SQL[f]}, false) AS INTEGER) AS "{f}"' for f in coh.ALL_FLAGS) + " FROM prevd p")

Q18 = [
    "FLAG_MONTANT_MANQUANT", "FLAG_MONTANT_TRES_BAS", "FLAG_MONTANT_TRES_ELEVE", "FLAG_MONTANT_NEGATIF", "FLAG_MONTANT_ZERO",
    "FLAG_MONTANT_NET_SUP_BRUT", "FLAG_DOUBLON_STRICT",
]


@register(
    "q18_amount_flags",
    """WITH q AS (SELECT quantile_cont(montant_net, 0.01) AS lo, quantile_cont(montant_net, 0.995) AS hi FROM silver)
SELECT row_id, CAST(montant_net IS NULL AS INTEGER) AS "FLAG_MONTANT_MANQUANT",
CAST(coalesce(montant_net > 0 AND montant_net < (SELECT lo FROM q), false) AS INTEGER) AS "FLAG_MONTANT_TRES_BAS",
CAST(coalesce(montant_net > (SELECT hi FROM q), false) AS INTEGER) AS "FLAG_MONTANT_TRES_ELEVE",
CAST(coalesce(montant_net < 0, false) AS INTEGER) AS "FLAG_MONTANT_NEGATIF", CAST(coalesce(montant_net = 0, false) AS INTEGER) AS "FLAG_MONTANT_ZERO",
CAST(coalesce(montant_net > montant_brut, false) AS INTEGER) AS "FLAG_MONTANT_NET_SUP_BRUT",
CAST(count(*) OVER (PARTITION BY matricule, periode) > 1 AS INTEGER) AS "FLAG_DOUBLON_STRICT" FROM silver""",
)
def _(spark, sf):
    return coh.amount_flags(silver(spark, sf)).select("row_id", *Q18)


define("net_prev", "SELECT *, lag(montant_net) OVER (PARTITION BY matricule ORDER BY periode, row_id) AS p FROM silver")


@register(
    "q19_jump_flags",
    """SELECT row_id, CAST(coalesce(montant_net * 2 < p, false) AS INTEGER) AS "FLAG_MONTANT_BAISSE_FORTE",
CAST(coalesce(montant_net > p * 2, false) AS INTEGER) AS "FLAG_MONTANT_HAUSSE_FORTE" FROM net_prev""",
)
def _(spark, sf):
    d = coh.jump_flags(silver(spark, sf))
    return d.select("row_id", "FLAG_MONTANT_BAISSE_FORTE", "FLAG_MONTANT_HAUSSE_FORTE")


@register(
    "w10_prev_value_flags",
    """SELECT row_id, CAST(coalesce(emploi <> lag(emploi) OVER (PARTITION BY matricule ORDER BY periode, row_id), false) AS INTEGER) AS c1,
CAST(coalesce(cle_unique <> lag(cle_unique) OVER (PARTITION BY matricule ORDER BY periode, row_id), false) AS INTEGER) AS c2 FROM silver""",
)
def _(spark, sf):
    d = coh.previous_change(coh.previous_change(silver(spark, sf), "emploi", "c1"), "cle_unique", "c2")
    return d.select("row_id", "c1", "c2")


define("years_of", "SELECT DISTINCT matricule, annee FROM silver")


@register(
    "q20_missing_years",
    """WITH g AS (SELECT m.matricule, y FROM (SELECT matricule, min(annee) AS a, max(annee) AS z FROM years_of GROUP BY 1) m, range(1995, 2002) t(y)
  WHERE y BETWEEN m.a AND m.z AND NOT EXISTS (SELECT 1 FROM years_of o WHERE o.matricule = m.matricule AND o.annee = y))
SELECT matricule, (SELECT string_agg(CAST(annee AS VARCHAR), ',' ORDER BY annee) FROM years_of o WHERE o.matricule = g.matricule) AS annees_presentes,
string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) AS annees_manquantes, CAST(count(*) AS INTEGER) AS nb_annees_manquantes FROM g GROUP BY 1""",
)
def _(spark, sf):
    return coh.missing_years(silver(spark, sf))


@register(
    "q20_missing_year_flag",
    """SELECT row_id, CAST((SELECT max(annee) - min(annee) + 1 - count(*) FROM years_of o WHERE o.matricule = s.matricule) > 0 AS INTEGER) AS "FLAG_ANNEE_MANQUANTE"
FROM silver s""",
)
def _(spark, sf):
    return coh.missing_year_flag(silver(spark, sf)).select("row_id", "FLAG_ANNEE_MANQUANTE")


@register(
    "q21_numeric_id",
    """SELECT DISTINCT cle_unique, CAST(regexp_full_match(replace(cle_unique, '||0', ''), '[0-9]+') AS INTEGER) AS "FLAG_MATRICULE_NUMERIQUE" FROM panel_src""",
)
def _(spark, sf):
    d = frame(spark, sf, SRC).select("cle_unique").distinct()
    return coh.numeric_id_flag(d.withColumn("matricule", F.replace("cle_unique", F.lit("||0"), F.lit("")))).drop("matricule")


@register(
    "q22_flag_kpis",
    " UNION ALL ".join(
        f"SELECT '{f}' AS flag, CAST(sum(\"{f}\") AS BIGINT) AS effectif, round(sum(\"{f}\") * 100.0::DOUBLE / count(*), 2) AS taux_pct FROM flag_rows"
        for f in coh.ALL_FLAGS
    ),
)
def _(spark, sf):
    return coh.flag_kpis(flagged(spark, sf), coh.ALL_FLAGS)


_SUM = " + ".join(f'"{f}"' for f in coh.ALL_FLAGS)


@register(
    "q22_flagged_persons",
    f"""SELECT matricule, count(*) FILTER (WHERE {_SUM} > 0) AS nb_lignes_flaggees, CAST(sum({_SUM}) AS BIGINT) AS nb_flags_total FROM flag_rows GROUP BY 1""",
)
def _(spark, sf):
    return coh.flagged_persons(flagged(spark, sf), coh.ALL_FLAGS)


@register(
    "q22_flag_summary",
    f"""SELECT count(*) AS total_lignes, {len(coh.ALL_FLAGS)} AS total_flags_distincts, count(DISTINCT matricule) AS total_matricules,
count(*) FILTER (WHERE {_SUM} > 0) AS lignes_avec_flag FROM flag_rows""",
)
def _(spark, sf):
    return coh.flag_summary(flagged(spark, sf), coh.ALL_FLAGS)


_SEX = coh.FLAG_GROUPS["sexe"]


@register(
    "q22_category_extract",
    f"""SELECT row_id, {", ".join(f'"{f}"' for f in _SEX)}, {" + ".join(f'"{f}"' for f in _SEX)} AS nb_flags_categorie FROM flag_rows
WHERE {" + ".join(f'"{f}"' for f in _SEX)} > 0""",
)
def _(spark, sf):
    return coh.category_extract(flagged(spark, sf), "sexe", ["row_id"])


@register(
    "q23_context_export",
    """SELECT f.matricule, p.periode, f."FLAG_ENFANTS_DESCENTE", 'Nombre d''enfants en baisse' AS description_probleme FROM flag_rows f
JOIN panel_src p ON p.row_id = f.row_id WHERE f.matricule IN (SELECT matricule FROM flag_rows WHERE "FLAG_ENFANTS_DESCENTE" = 1)""",
)
def _(spark, sf):
    return coh.context_export(flagged(spark, sf), "FLAG_ENFANTS_DESCENTE", "Nombre d'enfants en baisse", ["periode"])


define("jumped", "SELECT *, CAST(coalesce(montant_net > p * 2, false) AS INTEGER) AS h FROM net_prev")
define(
    "gaps",
    """SELECT matricule, periode, row_id, annee * 12 + mois - lag(annee * 12 + mois) OVER (PARTITION BY matricule ORDER BY periode, row_id) AS g
FROM jumped WHERE h = 1""",
)
YEARS = list(range(1995, 2002))


@register("q24_flag_intervals", "SELECT matricule, periode, row_id, CAST(g AS INTEGER) AS intervalle_mois FROM gaps WHERE g IS NOT NULL")
def _(spark, sf):
    return coh.flag_intervals(coh.jump_flags(silver(spark, sf)), "FLAG_MONTANT_HAUSSE_FORTE")


@register(
    "q24_flag_matrix",
    """WITH g AS (SELECT matricule, round(avg(g), 1) AS intervalle_moyen, CAST(min(g) AS INTEGER) AS intervalle_min, CAST(max(g) AS INTEGER) AS intervalle_max
    FROM gaps WHERE g IS NOT NULL GROUP BY 1),
  first AS (SELECT *, row_number() OVER (PARTITION BY matricule, annee ORDER BY periode, row_id) AS r FROM jumped)
SELECT j.matricule, CAST(sum(h) AS BIGINT) AS nb_variations, any_value(intervalle_moyen) AS intervalle_moyen, any_value(intervalle_min) AS intervalle_min,
any_value(intervalle_max) AS intervalle_max, """
    + ", ".join(
        f'max(montant_net) FILTER (WHERE annee = {y} AND r = 1) AS "{y}_montant", max(h) FILTER (WHERE annee = {y}) AS "{y}_flag", '
        f'min(mois) FILTER (WHERE annee = {y} AND h = 1) AS "{y}_mois"'
        for y in YEARS
    )
    + " FROM first j LEFT JOIN g ON g.matricule = j.matricule GROUP BY 1 HAVING sum(h) > 0",
)
def _(spark, sf):
    return coh.flag_matrix(coh.jump_flags(silver(spark, sf)), "FLAG_MONTANT_HAUSSE_FORTE", "montant_net", YEARS)


