"""Marts, indicators, dashboard tables and reporting views."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.frames import frame, graded, imputed, panel, rounded, silver
from checks.registry import VALID, define, register
from paypanel.functions.dates import month_end, tenure_years
from paypanel.functions.grades import bareme_detail, category_from_grade_text
from paypanel.functions.people import status_from_id
from paypanel.operators import aggregates as agg
from paypanel.operators.silver import BRUT_CODES, brut_from_components, filter_valid_grades
from paypanel.operators.sets import pay_scale_grid
from paypanel.operators.joins import join_bareme
from paypanel.plans import views

# Rank 1 + floor((n-1)p + 0.5) without interpolation, as a correlated-free list lookup.


def near(value: str, p: float) -> str:
    vals = f"list_sort(list({value}) FILTER (WHERE {value} IS NOT NULL))"
    return f"{vals}[CAST(1 + floor((count({value}) - 1) * {p}::DOUBLE + 0.5::DOUBLE) AS BIGINT)]"


def whole(e: str) -> str:
    return f"round(round({e}, 6), 0)"


def quart(value: str, names: tuple[str, str, str]) -> str:
    return ", ".join(
        f"{whole(f'quantile_cont({value}, {p})')} AS {n}" for p, n in zip(("0.5", "0.25", "0.75"), names)
    )


@register(
    "a01_masse_salariale",
    f"""SELECT mois_annee, CAST(annee AS INTEGER) AS annee, mois, coalesce(CODE_ORGANISME, 'NON_CODE') AS code_organisme,
coalesce(organisme, 'NON_IDENTIFIE') AS organisme, situation_normalisee, count(*) AS nb_lignes,
count(DISTINCT matricule) AS nb_agents_uniques, {whole("coalesce(sum(montant_brut), 0)")} AS masse_brute,
{whole("coalesce(sum(montant_net), 0)")} AS masse_nette, {whole("avg(montant_brut)")} AS salaire_brut_moyen,
{whole("avg(montant_net)")} AS salaire_net_moyen, {whole(near("montant_brut", 0.5))} AS salaire_brut_mediane,
{whole(near("montant_net", 0.5))} AS salaire_net_mediane FROM silver GROUP BY 1, 2, 3, 4, 5, 6""",
)
def _(spark, sf):
    return agg.masse_salariale(silver(spark, sf))


@register(
    "a02_effectifs",
    """SELECT mois_annee, annee, mois, situation_normalisee, coalesce(CODE_ORGANISME, 'NON_CODE') AS code_organisme,
count(*) AS nb_lignes, count(DISTINCT matricule) AS nb_agents_uniques,
count(*) FILTER (WHERE SEXE_STD = 'Homme') AS nb_hommes, count(*) FILTER (WHERE SEXE_STD = 'Femme') AS nb_femmes
FROM silver GROUP BY 1, 2, 3, 4, 5""",
)
def _(spark, sf):
    return agg.effectifs(silver(spark, sf))


# -------------------------------------------------------------- revenue of persons and posts
define(
    "scale_grid",
    """SELECT * FROM (VALUES ('BUILDING', 'ENS SEC & PRIM', 'A3'), ('MACHINERY', 'police', 'B3'),
('AUTOMOBILE', 'ENS SUP', 'A5'), ('FURNITURE', 'Tech-Santé', 'C3')) g(emploi_ref, bareme, grade_ref)""",
)
define("brut_items", "SELECT row_id, sum(montant) AS s FROM paycodes WHERE code IN ('124','228','271','421','425') GROUP BY 1")
define(
    "salaried",
    """SELECT i.*, coalesce(b.s, i.montant_brut) AS SALAIRE_BRUT, d.Code_CITP, d.Metier_CITP, g.bareme, g.grade_ref,
CASE WHEN g.bareme = 'ENS SEC & PRIM' THEN CASE WHEN i.GRADE IN ('B3','C3','D1','D2') THEN 'ENS SEC & PRIM_PRIM'
  ELSE 'ENS SEC & PRIM_SEC' END ELSE g.bareme END AS bareme_detail,
(SELECT count(*) FROM imputed k WHERE k.mois_annee = i.mois_annee AND k.matricule = i.matricule) AS NB_POSTES
FROM imputed i LEFT JOIN brut_items b ON b.row_id = i.row_id LEFT JOIN dim_emploi d ON upper(d.libelle) = i.emploi
LEFT JOIN scale_grid g ON g.emploi_ref = i.emploi""",
)
define("salaried_valid", f"SELECT * FROM salaried WHERE GRADE IN {VALID} AND SALAIRE_BRUT > 0")
_ORD = "ascii(GRADE) * -10 + CAST(substr(GRADE, 2, 1) AS INTEGER)"
define(
    "revenue",
    f"""SELECT annee, mois, matricule, s AS REVENU_TOTAL, NB_POSTES, GRADE AS GRADE_PRINCIPAL,
GRADE_SOURCE AS GRADE_SOURCE_PRINCIPAL, SEXE_STD, Code_CITP, Metier_CITP, bareme, bareme_detail FROM (
  SELECT *, sum(SALAIRE_BRUT) OVER (PARTITION BY annee, mois, matricule) AS s,
    row_number() OVER (PARTITION BY annee, mois, matricule ORDER BY {_ORD} DESC, cle_unique, row_id) AS rk
  FROM salaried_valid) WHERE rk = 1""",
)


def salaried(spark, sf):
    """Rows with gross pay from items, posts per person and month, job group and pay scale."""

    def build():
        d = imputed(spark, sf)
        d = brut_from_components(d, frame(spark, sf, "paycodes"), ["row_id"], BRUT_CODES)
        d = agg.count_posts(d, ["mois_annee", "matricule"])
        dim = frame(spark, sf, "dim_emploi")
        from paypanel.operators.joins import enrich_code

        d = enrich_code(d, dim, "emploi", "_c", ["Code_CITP", "Metier_CITP"]).drop("_c")
        d = join_bareme(d, pay_scale_grid(spark))
        return d.withColumn("bareme_detail", bareme_detail("bareme", "GRADE"))

    from paypanel.plans.stages import layer

    return layer(spark, f"salaried {sf}", build)


def revenue(spark, sf, key="matricule"):
    return agg.aggregate_revenue(filter_valid_grades(salaried(spark, sf), "SALAIRE_BRUT"), key)


@register("f17_brut_from_components", "SELECT row_id, round(SALAIRE_BRUT, 4) AS SALAIRE_BRUT FROM salaried")
def _(spark, sf):
    d = brut_from_components(imputed(spark, sf), frame(spark, sf, "paycodes"), ["row_id"], BRUT_CODES)
    return rounded(d.select("row_id", "SALAIRE_BRUT"), 4, "SALAIRE_BRUT")


@register("a06_count_posts", "SELECT row_id, NB_POSTES FROM salaried")
def _(spark, sf):
    return agg.count_posts(imputed(spark, sf), ["mois_annee", "matricule"]).select("row_id", "NB_POSTES")


@register(
    "a06_count_employers",
    """SELECT s.row_id, (SELECT count(DISTINCT cle_unique) FROM silver k WHERE k.mois_annee = s.mois_annee
AND k.matricule = s.matricule) AS nb_employeurs FROM silver s""",
)
def _(spark, sf):
    d = agg.count_posts(silver(spark, sf), ["mois_annee", "matricule"], "nb_employeurs", "cle_unique")
    return d.select("row_id", "nb_employeurs")


@register("j03_join_bareme", "SELECT row_id, bareme, grade_ref FROM salaried")
def _(spark, sf):
    return join_bareme(imputed(spark, sf), pay_scale_grid(spark)).select("row_id", "bareme", "grade_ref")


@register("i14_bareme_detail", "SELECT row_id, bareme_detail FROM salaried")
def _(spark, sf):
    d = join_bareme(imputed(spark, sf), pay_scale_grid(spark))
    return d.select("row_id", bareme_detail("bareme", "GRADE").alias("bareme_detail"))


@register("a05_revenue_person", "SELECT * EXCLUDE (REVENU_TOTAL), round(REVENU_TOTAL, 4) AS REVENU_TOTAL FROM revenue")
def _(spark, sf):
    return rounded(revenue(spark, sf), 4, "REVENU_TOTAL")


@register(
    "a05_revenue_post",
    f"""SELECT annee, mois, cle_unique, round(sum(SALAIRE_BRUT), 4) AS REVENU_TOTAL,
max(NB_POSTES) AS NB_POSTES, arg_max(GRADE, {_ORD} - row_id / 1000000000.0::DOUBLE) AS GRADE_PRINCIPAL
FROM salaried_valid GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    r = revenue(spark, sf, "cle_unique")
    cols = ["annee", "mois", "cle_unique", "REVENU_TOTAL", "NB_POSTES", "GRADE_PRINCIPAL"]
    return rounded(r.select(*cols), 4, "REVENU_TOTAL")


def indicators_sql(keys: str, src: str, where: str = "TRUE", value: str = "REVENU_TOTAL") -> str:
    return f"""SELECT annee, mois, {keys}, count(*) AS "Effectif", {whole(f"avg({value})")} AS "Revenu_moyen",
{whole(f"quantile_cont({value}, 0.5)")} AS "Revenu_median", {whole(f"min({value})")} AS "Revenu_min",
{whole(f"max({value})")} AS "Revenu_max", {whole(near(value, 0.25))} AS "Revenu_p25",
{whole(near(value, 0.75))} AS "Revenu_p75" FROM {src} WHERE {where} GROUP BY ALL"""


_WHERE = {"citp": "Code_CITP IS NOT NULL AND Code_CITP <> 'Non renseigné'"}
for _name, _keys in agg.INDICATOR_KEYS.items():

    def _run(spark, sf, name=_name):
        return agg.indicator_table(revenue(spark, sf), name)

    _w = "bareme IS NOT NULL" if _keys[0] == "bareme" else _WHERE.get(_name, "TRUE")
    register(f"a04_indicators_{_name}", indicators_sql(", ".join(_keys), "revenue", _w))(_run)


@register(
    "a03_indicators_linear",
    f"""SELECT annee, GRADE, count(*) AS "Effectif", {whole("avg(montant_brut)")} AS "Revenu_moyen",
{whole("quantile_cont(montant_brut, 0.5)")} AS "Revenu_median", {whole("min(montant_brut)")} AS "Revenu_min",
{whole("max(montant_brut)")} AS "Revenu_max", {whole("quantile_cont(montant_brut, 0.25)")} AS "Revenu_p25",
{whole("quantile_cont(montant_brut, 0.75)")} AS "Revenu_p75" FROM panel GROUP BY ALL""",
)
def _(spark, sf):
    return agg.compute_indicators(panel(spark, sf), ["annee", "GRADE"], "montant_brut", linear=True)


@register(
    "a07_multi_posts_table",
    """SELECT annee, mois, GRADE_PRINCIPAL, count(*) FILTER (WHERE NB_POSTES = 1) AS "1", count(*) FILTER (WHERE NB_POSTES = 2) AS "2",
count(*) FILTER (WHERE NB_POSTES = 3) AS "3", count(*) FILTER (WHERE NB_POSTES = 4) AS "4",
count(*) FILTER (WHERE NB_POSTES >= 5) AS "5+" FROM revenue GROUP BY 1, 2, 3""",
)
def _(spark, sf):
    return agg.multi_posts_table(revenue(spark, sf))


@register(
    "a07_multi_posts_means",
    f"""SELECT annee, mois, GRADE_PRINCIPAL, NB_POSTES, count(*) AS "Effectif", {whole("avg(REVENU_TOTAL)")} AS "Revenu_moyen"
FROM revenue GROUP BY 1, 2, 3, 4""",
)
def _(spark, sf):
    return agg.multi_posts_means(revenue(spark, sf))


@register(
    "a08_posts_distribution",
    f"""SELECT NB_POSTES, count(*) AS "Effectif", {whole("avg(REVENU_TOTAL)")} AS "Revenu_moyen",
round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM revenue), 2) AS "Pct" FROM revenue GROUP BY 1""",
)
def _(spark, sf):
    return agg.posts_distribution(revenue(spark, sf))


GRADES = ["A1", "A2", "A3", "B1", "B2", "B3", "C1", "C2", "C3", "D1", "D2", "D3"]


def pivot_sql(stat: str) -> str:
    cols = ", ".join(f"{stat.format(v=f'CASE WHEN GRADE = {g!r} THEN SALAIRE_BRUT END')} AS \"{g}\"" for g in GRADES)
    inlist = ", ".join(f"'{g}'" for g in GRADES)
    names = ", ".join(f'"{g}"' for g in GRADES)
    wide = f"SELECT annee, mois, {cols} FROM salaried_valid WHERE GRADE IN ({inlist}) GROUP BY 1, 2"
    return f"SELECT * FROM ({wide}) WHERE coalesce({names}) IS NOT NULL"


for _stat, _sql in (
    ("moyen", whole("avg({v})")),
    ("median", whole("quantile_cont({v}, 0.5)")),
    ("effectif", "CAST(nullif(count({v}), 0) AS DOUBLE)"),
    ("sd", "round(stddev_samp({v}), 4)"),
    ("se", "round(stddev_samp({v}) / sqrt(count({v})), 4)"),
    ("cv", "round(stddev_samp({v}) / avg({v}), 4)"),
):

    def _run(spark, sf, stat=_stat):
        d = filter_valid_grades(salaried(spark, sf), "SALAIRE_BRUT")
        out = agg.pivot_indicator(d, ["annee", "mois"], "GRADE", GRADES, "SALAIRE_BRUT", stat)
        return rounded(out, 4, *GRADES) if stat in ("sd", "se", "cv") else out

    register(f"a09_pivot_{_stat}", pivot_sql(_sql))(_run)


@register(
    "a10_sector_pay_model",
    f"""WITH year96 AS (SELECT * FROM salaried WHERE annee = 1996 AND bareme_detail IS NOT NULL AND SALAIRE_BRUT > 0),
  layout AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{a}', {'NULL' if k is None else repr(k)})" for i, (a, k) in enumerate(agg.SECTOR_ROWS, 1))})
    t(ordre, libelle, bareme_detail)),
  stats AS (SELECT bareme_detail AS k, min(SALAIRE_BRUT) a, avg(SALAIRE_BRUT) b, max(SALAIRE_BRUT) c, count(*) n, quantile_cont(SALAIRE_BRUT, 0.5) m
    FROM year96 GROUP BY 1 UNION ALL
    SELECT '_GLOBAL_', min(SALAIRE_BRUT), avg(SALAIRE_BRUT), max(SALAIRE_BRUT), count(*), quantile_cont(SALAIRE_BRUT, 0.5) FROM year96)
SELECT l.ordre, l.libelle, CAST(l.bareme_detail AS VARCHAR) AS bareme_detail, {whole("a")} AS salaire_brut_min, {whole("b")} AS salaire_brut_moyen,
{whole("c")} AS salaire_brut_max, n AS nb_obs, {whole("m")} AS salaire_brut_mediane FROM layout l LEFT JOIN stats ON k = l.bareme_detail""",
)
def _(spark, sf):
    return agg.sector_pay_model(salaried(spark, sf), 1996)


@register(
    "a11_robust_stats",
    """SELECT GRADE, count(*) AS "Effectif", round(avg(montant_net), 8) AS moyenne, round(stddev_samp(montant_net), 4) AS sd,
round(stddev_samp(montant_net) / sqrt(count(montant_net)), 4) AS se, round(stddev_samp(montant_net) / avg(montant_net), 6) AS cv,
min(montant_net) AS minimum, max(montant_net) AS maximum, round(quantile_cont(montant_net, 0.5), 6) AS mediane
FROM imputed GROUP BY 1""",
)
def _(spark, sf):
    out = agg.robust_stats(imputed(spark, sf), ["GRADE"], "montant_net")
    return rounded(rounded(rounded(out, 4, "sd", "se"), 6, "cv", "mediane"), 8, "moyenne")


define(
    "member",
    """SELECT *, CASE WHEN substr(matricule, 1, 1) IN ('5', '6') THEN 'Non' ELSE 'Oui' END AS fonct,
regexp_extract(upper(strip_accents(statut_fonctionnaire)), 'CATEGORIE\\s+([A-D])', 1) AS lettre FROM graded""",
)
_PANEL_AGG = """count(*) AS effectif, round(avg(montant_net), 8) AS net_moyen, round(avg(montant_brut), 8) AS brut_moyen,
min(montant_net) AS net_min, max(montant_net) AS net_max, round(quantile_cont(montant_net, 0.5), 6) AS net_median,
round(quantile_cont(montant_brut, 0.5), 6) AS brut_median"""
_GROUPS = {
    "Ensemble": "TRUE",
    "Non fonctionnaire": "fonct = 'Non'",
    "Homme": "SEXE_STD = 'Homme'",
    "Femme": "SEXE_STD = 'Femme'",
    **{f"Cat {c}": f"fonct = 'Oui' AND lettre = '{c}'" for c in "ABCD"},
}


def panels(spark, sf):
    d = graded(spark, sf).withColumns(
        {
            "STATUT": F.when(status_from_id("matricule") == "Fonctionnaire", "Fonctionnaire").otherwise("Autre"),
            "CATEGORIE": category_from_grade_text("statut_fonctionnaire"),
        }
    )
    return agg.group_panels(d, ["annee", "mois"], list("ABCD"), "montant_brut", "montant_net")


@register(
    "a12_group_panels",
    " UNION ALL ".join(
        f"SELECT annee, mois, '{g}' AS groupe, {_PANEL_AGG} FROM member WHERE {w} GROUP BY 1, 2" for g, w in _GROUPS.items()
    ),
)
def _(spark, sf):
    return rounded(rounded(panels(spark, sf), 6, "net_median", "brut_median"), 8, "net_moyen", "brut_moyen")


@register(
    "a12_group_panels_wide",
    "SELECT annee, mois, "
    + ", ".join(f'round(avg(montant_net) FILTER (WHERE {w}), 8) AS "{g}"' for g, w in _GROUPS.items())
    + " FROM member GROUP BY 1, 2",
)
def _(spark, sf):
    out = agg.group_panels_wide(panels(spark, sf), ["annee", "mois"], list("ABCD"), "net_moyen")
    return rounded(out, 8, *_GROUPS)


@register(
    "a18_distribution",
    """SELECT sexe AS valeur, count(*) AS effectif, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM panel_src), 2) AS pct
FROM panel_src GROUP BY 1""",
)
def _(spark, sf):
    return agg.distribution(frame(spark, sf, "panel_src"), "sexe")


@register(
    "a19_crosstab",
    """WITH c AS (SELECT coalesce(sexe, '(vide)') AS sexe, emploi FROM panel_src)
SELECT sexe, emploi, count(*) AS effectif FROM c GROUP BY 1, 2 UNION ALL SELECT sexe, 'Total', count(*) FROM c GROUP BY 1
UNION ALL SELECT 'Total', emploi, count(*) FROM c GROUP BY 2 UNION ALL SELECT 'Total', 'Total', count(*) FROM c""",
)
def _(spark, sf):
    return agg.crosstab(frame(spark, sf, "panel_src"), "sexe", "emploi")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register(
    "a19_crosstab_wide",
    "WITH c AS (SELECT unnest([coalesce(sexe, '(vide)'), 'Total']) AS sexe, emploi FROM panel_src) SELECT sexe, "
    + ", ".join(f"count(*) FILTER (WHERE emploi = '{s}') AS \"{s}\"" for s in SEGMENTS)
    + ', count(*) AS "Total" FROM c GROUP BY 1',
)
def _(spark, sf):
    cells = agg.crosstab(frame(spark, sf, "panel_src"), "sexe", "emploi")
    return agg.crosstab_wide(cells, "sexe", "emploi", SEGMENTS)


define(
    "ind_grade",
    f'SELECT annee, mois, GRADE_PRINCIPAL, count(*) AS "Effectif", {whole("avg(REVENU_TOTAL)")} AS "Revenu_moyen" FROM revenue GROUP BY 1, 2, 3',
)


@register(
    "a20_weighted_rollup",
    """SELECT GRADE_PRINCIPAL, CAST(sum("Effectif") AS BIGINT) AS effectif_total,
round_even(sum("Effectif" * "Revenu_moyen") / sum("Effectif"), 0) AS revenu_moyen_pondere FROM ind_grade GROUP BY 1""",
)
def _(spark, sf):
    return agg.weighted_rollup(agg.indicator_table(revenue(spark, sf), "grade"), "GRADE_PRINCIPAL")


@register(
    "a21_citp_summary",
    """SELECT CAST(g AS INTEGER) AS grand_groupe, count(r.Code_CITP) AS effectif_total, count(DISTINCT r.Code_CITP) AS nb_metiers
FROM range(1, 10) t(g) LEFT JOIN revenue r ON left(r.Code_CITP, 1) = CAST(g AS VARCHAR) GROUP BY 1""",
)
def _(spark, sf):
    return agg.citp_summary(agg.indicator_table(revenue(spark, sf), "citp"))


@register(
    "a22_multi_share",
    """SELECT GRADE_PRINCIPAL, count(*) FILTER (WHERE NB_POSTES = 1) AS mono_postes, count(*) FILTER (WHERE NB_POSTES >= 2) AS multi_postes,
'Catégorie ' || left(GRADE_PRINCIPAL, 1) AS categorie FROM revenue GROUP BY 1""",
)
def _(spark, sf):
    return agg.multi_share(revenue(spark, sf))


@register(
    "a23_kpis",
    f"""WITH n AS (SELECT * FROM panel WHERE annee BETWEEN 1997 AND 1998 AND montant_brut > 0),
  o AS (SELECT sum(montant_brut) AS s, avg(montant_brut) AS a FROM panel WHERE annee BETWEEN 1996 AND 1997 AND montant_brut > 0)
SELECT {whole("sum(montant_brut)")} AS masse, {whole("avg(montant_brut)")} AS moyen, count(*) AS n_lignes,
count(DISTINCT matricule) AS n_agents, {whole("quantile_cont(montant_brut, 0.5)")} AS median,
round((sum(montant_brut) / (SELECT s FROM o) - 1) * 100, 1) AS delta_masse_pct,
round((avg(montant_brut) / (SELECT a FROM o) - 1) * 100, 1) AS delta_moyen_pct FROM n""",
)
def _(spark, sf):
    return agg.kpis(panel(spark, sf), 1997, 1998)


_DASH = f"""count(*) AS effectif, {whole("sum(montant_brut)")} AS masse, {whole("avg(montant_brut)")} AS moyen,
{quart("montant_brut", ("median", "p25", "p75"))}"""


@register(
    "a24_dashboard_monthly",
    f"""SELECT annee, mois, organisme, {_DASH}, count(DISTINCT matricule) AS agents,
strftime(make_date(annee, mois, 1), '%Y-%m') AS periode FROM panel WHERE montant_brut > 0 GROUP BY annee, mois, organisme""",
)
def _(spark, sf):
    return agg.dashboard_agg(panel(spark, sf), ["organisme"])


@register("a24_dashboard_yearly", f"SELECT annee, GRADE, {_DASH} FROM panel WHERE montant_brut > 0 GROUP BY 1, 2")
def _(spark, sf):
    return agg.dashboard_agg(panel(spark, sf), ["GRADE"], monthly=False)


YEARS = list(range(1995, 2002))
define(
    "top_org",
    "SELECT organisme FROM panel WHERE montant_brut > 0 GROUP BY 1 ORDER BY count(*) DESC, organisme LIMIT 15",
)


@register(
    "a25_heatmap",
    "SELECT organisme, "
    + ", ".join(f"{whole(f'avg(montant_brut) FILTER (WHERE annee = {y})')} AS \"{y}\"" for y in YEARS)
    + " FROM panel WHERE montant_brut > 0 AND organisme IN (SELECT organisme FROM top_org) GROUP BY 1",
)
def _(spark, sf):
    return agg.heatmap(panel(spark, sf), "organisme", YEARS)


@register(
    "a26_headcount_compare",
    """WITH a AS (SELECT mois, GRADE, count(*) AS n FROM panel WHERE annee = 1996 GROUP BY 1, 2),
  b AS (SELECT mois, GRADE, count(*) AS n FROM panel WHERE annee = 1997 GROUP BY 1, 2)
SELECT coalesce(a.mois, b.mois) AS mois, coalesce(a.GRADE, b.GRADE) AS GRADE, coalesce(a.n, 0) AS effectif_a, coalesce(b.n, 0) AS effectif_b,
coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL JOIN b ON a.mois = b.mois AND a.GRADE = b.GRADE""",
)
def _(spark, sf):
    return agg.headcount_compare(panel(spark, sf), 1996, 1997)


_EVO = """round(avg(montant_brut), 8) AS moyenne, count(*) AS effectif, round(quantile_cont(montant_brut, 0.5), 6) AS median,
round(quantile_cont(montant_brut, 0.25), 6) AS p25, round(quantile_cont(montant_brut, 0.75), 6) AS p75"""


@register(
    "a27_evolution",
    f"SELECT make_date(annee, mois, 1) AS date_mois, {_EVO} FROM panel WHERE montant_brut > 0 GROUP BY 1",
)
def _(spark, sf):
    return rounded(rounded(agg.evolution(panel(spark, sf)), 6, "median", "p25", "p75"), 8, "moyenne")


@register(
    "a27_evolution_by_letter",
    f"""SELECT make_date(annee, mois, 1) AS date_mois, left(GRADE, 1) AS lettre, {_EVO} FROM panel
WHERE montant_brut > 0 AND GRADE <> 'NF' GROUP BY 1, 2""",
)
def _(spark, sf):
    d = panel(spark, sf).where(F.col("GRADE") != "NF").withColumn("lettre", F.substring("GRADE", 1, 1))
    return rounded(rounded(agg.evolution(d, ["lettre"]), 6, "median", "p25", "p75"), 8, "moyenne")


@register(
    "a28_numeric_profile",
    """SELECT count(*) AS total, count(montant_net) AS non_nuls, count(*) FILTER (WHERE montant_net IS NULL) AS manquants,
count(*) FILTER (WHERE montant_net < 0) AS negatifs, count(*) FILTER (WHERE montant_net = 0) AS zeros,
count(*) FILTER (WHERE montant_net > 0) AS positifs, round(avg(montant_net), 4) AS moyenne,
round(stddev_samp(montant_net), 4) AS ecart_type, min(montant_net) AS minimum, max(montant_net) AS maximum,
round(quantile_cont(montant_net, 0.5), 6) AS mediane, round(quantile_cont(montant_net, 0.25), 6) AS p25,
round(quantile_cont(montant_net, 0.75), 6) AS p75 FROM panel_src""",
)
def _(spark, sf):
    out = agg.numeric_profile(frame(spark, sf, "panel_src"), "montant_net")
    return rounded(rounded(out, 4, "moyenne", "ecart_type"), 6, "mediane", "p25", "p75")


PROFILED = ["sexe", "situation", "emploi", "CODE_EMPLOI", "date_naissance"]


@register(
    "a29_column_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS colonne, count({c}) AS non_nuls, count(*) - count({c}) AS nuls, count(DISTINCT {c}) AS distincts,
(SELECT string_agg(v, ' | ' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM panel_src WHERE {c} IS NOT NULL ORDER BY 1 LIMIT 5)) AS exemples,
(SELECT max(try_strptime(v, '%Y-%m-%d') IS NOT NULL) FROM (SELECT DISTINCT {c} AS v FROM panel_src WHERE {c} IS NOT NULL ORDER BY 1 LIMIT 5)) AS date_probable,
'string' AS type FROM panel_src"""
        for c in PROFILED
    ),
)
def _(spark, sf):
    return agg.column_profile(frame(spark, sf, "panel_src"), PROFILED)


@register(
    "a30_duplicate_profile",
    """SELECT n AS occurrences, count(*) AS nb_identifiants FROM (SELECT matricule, count(*) AS n FROM panel_src GROUP BY 1) GROUP BY 1""",
)
def _(spark, sf):
    return agg.duplicate_profile(frame(spark, sf, "panel_src"), "matricule")


@register(
    "a31_id_structure",
    """SELECT CAST(length(m) AS INTEGER) AS longueur, left(m, 1) AS premier, count(*) AS nb_identifiants
FROM (SELECT DISTINCT matricule AS m FROM panel_src) GROUP BY 1, 2""",
)
def _(spark, sf):
    return agg.id_structure(frame(spark, sf, "panel_src"), "matricule")


@register(
    "a32_grade_summary",
    f"""SELECT GRADE, count(*) AS nb_lignes, count(DISTINCT matricule) AS nb_personnes, count(DISTINCT cle_unique) AS nb_postes,
{whole("avg(montant_brut)")} AS moyenne, min(montant_brut) AS minimum, max(montant_brut) AS maximum,
round(quantile_cont(montant_brut, 0.5), 6) AS mediane FROM imputed WHERE montant_brut > 0 GROUP BY 1""",
)
def _(spark, sf):
    return rounded(agg.grade_summary(imputed(spark, sf)), 6, "mediane")


@register(
    "a33_top_values",
    "SELECT organisme, count(*) AS n FROM panel WHERE montant_brut > 0 GROUP BY 1 ORDER BY n DESC, organisme LIMIT 10",
)
def _(spark, sf):
    return agg.top_values(panel(spark, sf), "organisme", 10)


def tenured(spark, sf):
    d = silver(spark, sf)
    return d.withColumn("anciennete", tenure_years(F.col("prise_service").cast("date"), month_end("mois_annee")))


define(
    "tenured",
    """SELECT s.*, round_even(date_diff('day', CAST(prise_service AS DATE), last_day(make_date(annee, mois, 1))) / 365.25::DOUBLE, 2) AS anciennete
FROM silver s""",
)


@register(
    "a34_year_end_growth",
    """WITH e AS (SELECT matricule, annee, max(anciennete) AS fin_annee FROM tenured GROUP BY 1, 2)
SELECT e.*, round(fin_annee - (SELECT p.fin_annee FROM e p WHERE p.matricule = e.matricule AND p.annee < e.annee
  ORDER BY p.annee DESC LIMIT 1), 6) AS delta FROM e""",
)
def _(spark, sf):
    return rounded(agg.year_end_growth(tenured(spark, sf), ["matricule"], "anciennete"), 6, "delta")


@register(
    "a34_growth_verdict",
    """WITH e AS (SELECT matricule, annee, max(anciennete) AS f FROM tenured GROUP BY 1, 2),
  d AS (SELECT f - lag(f) OVER (PARTITION BY matricule ORDER BY annee) AS delta FROM e)
SELECT CASE WHEN count(*) FILTER (WHERE delta < 0) > 0 THEN 'decroit' WHEN count(*) FILTER (WHERE delta <= 0) = 0 THEN 'evolue'
  WHEN count(*) FILTER (WHERE delta <> 0) = 0 THEN 'constant' ELSE 'decroit' END AS verdict FROM d""",
)
def _(spark, sf):
    return agg.growth_verdict(agg.year_end_growth(tenured(spark, sf), ["matricule"], "anciennete"))


@register(
    "a35_situation_summary",
    """SELECT situation, count(*) AS effectif, round(avg(montant_brut), 2) AS salaire_moyen,
round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM panel_src), 2) AS pct FROM panel_src GROUP BY 1""",
)
def _(spark, sf):
    return agg.situation_summary(frame(spark, sf, "panel_src"))


@register(
    "a36_histogram",
    """WITH s AS (SELECT min(montant_brut) AS lo, max(montant_brut) AS hi FROM panel)
SELECT SEXE_STD, CAST(least(floor((montant_brut - lo) / ((hi - lo) / 50.0::DOUBLE)), 49) AS INTEGER) AS classe, count(*) AS effectif
FROM panel, s WHERE montant_brut IS NOT NULL GROUP BY 1, 2""",
)
def _(spark, sf):
    return agg.histogram(panel(spark, sf), "montant_brut", "SEXE_STD", 50)


@register(
    "a37_box_stats",
    """WITH d AS (SELECT * FROM panel WHERE annee = 1997 AND montant_brut > 0),
  t AS (SELECT organisme FROM d GROUP BY 1 ORDER BY count(*) DESC, organisme LIMIT 15)
SELECT organisme, count(*) AS n, min(montant_brut) AS minimum, max(montant_brut) AS maximum,
round(quantile_cont(montant_brut, 0.25), 6) AS q1, round(quantile_cont(montant_brut, 0.5), 6) AS median,
round(quantile_cont(montant_brut, 0.75), 6) AS q3 FROM d WHERE organisme IN (SELECT organisme FROM t) GROUP BY 1""",
)
def _(spark, sf):
    return rounded(agg.box_stats(panel(spark, sf), "organisme", 1997), 6, "q1", "median", "q3")


# -------------------------------------------------------------- reporting views
define(
    "base",
    """SELECT matricule, CASE SEXE_STD WHEN 'Inconnu' THEN 'Autre' ELSE SEXE_STD END AS sexe, GRADE AS grade_principal,
CASE WHEN GRADE IN ('A3','A4','A5','A6','A7') THEN 'Catégorie A' WHEN GRADE IN ('B1','B3') THEN 'Catégorie B'
  WHEN GRADE IN ('C1','C2','C3') THEN 'Catégorie C' WHEN GRADE IN ('D1','D2') THEN 'Catégorie D'
  WHEN GRADE = 'NF' THEN 'Non Fonctionnaire' ELSE 'Autre' END AS categorie_grade,
TRY_CAST(left(trim(Code_CITP), 1) AS INTEGER) AS citp_grand_groupe, nullif(trim(Code_CITP), '') AS code_citp,
nullif(trim(Metier_CITP), '') AS metier_citp, annee, mois, make_date(annee, mois, 1) AS date_mois, montant_brut, montant_net,
organisme, emploi, CASE GRADE WHEN 'NF' THEN 'Non Fonctionnaire' ELSE 'Barême Général' END AS bareme
FROM panel WHERE montant_brut > 0 AND annee BETWEEN 1995 AND 2099 AND GRADE <> ''""",
)


def base(spark, sf):
    return views.panel_base(panel(spark, sf), first_year=1995)


def view(name, fn, sql):
    register(name, sql)(lambda spark, sf: fn(base(spark, sf)))


REPORT = "('A3','A4','A5','A6','A7','B1','B3','C1','C2','C3','D1','D2')"
_Q = quart("montant_brut", ("revenu_median", "revenu_p25", "revenu_p75"))
_SHORT = f"count(*) AS effectif, {whole('avg(montant_brut)')} AS revenu_moyen, {_Q}"
_LONG = f"{_SHORT}, {whole('min(montant_brut)')} AS revenu_min, {whole('max(montant_brut)')} AS revenu_max"

view("v1_panel_base", lambda b: b, "SELECT * FROM base")
view("v2_global", views.indicators_global, f"SELECT annee, mois, date_mois, {_LONG} FROM base GROUP BY 1, 2, 3")
view(
    "v3_citp",
    views.indicators_citp,
    f"""SELECT annee, mois, date_mois, citp_grand_groupe, code_citp, metier_citp, {_LONG} FROM base
WHERE citp_grand_groupe IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6""",
)
view(
    "v3_citp_group",
    views.indicators_citp_group,
    f"""SELECT annee, mois, date_mois, citp_grand_groupe, CASE citp_grand_groupe WHEN 1 THEN '1 - Directeurs & cadres'
WHEN 2 THEN '2 - Professions intellectuelles' WHEN 3 THEN '3 - Professions intermédiaires' WHEN 4 THEN '4 - Employés administratifs'
WHEN 5 THEN '5 - Services & ventes' WHEN 6 THEN '6 - Agriculture' WHEN 7 THEN '7 - Métiers qualifiés'
WHEN 8 THEN '8 - Opérateurs machines' WHEN 9 THEN '9 - Professions élémentaires' ELSE 'Non classé' END AS libelle_citp, {_SHORT}
FROM base WHERE citp_grand_groupe BETWEEN 1 AND 9 GROUP BY 1, 2, 3, 4""",
)
view(
    "v4_grade",
    views.indicators_grade,
    f"SELECT annee, mois, date_mois, grade_principal, {_LONG} FROM base WHERE grade_principal IN {REPORT} GROUP BY 1, 2, 3, 4",
)
view(
    "v4_sex_grade",
    views.indicators_sex_grade,
    f"""SELECT annee, mois, date_mois, sexe, grade_principal, {_LONG} FROM base
WHERE grade_principal IN {REPORT} AND sexe <> 'Autre' GROUP BY 1, 2, 3, 4, 5""",
)
view(
    "v5_pay_gap",
    views.pay_gap,
    f"""WITH c AS (SELECT annee, mois, date_mois, grade_principal,
  {whole("avg(montant_brut) FILTER (WHERE sexe = 'Homme')")} AS h, {whole("avg(montant_brut) FILTER (WHERE sexe = 'Femme')")} AS f,
  nullif(count(*) FILTER (WHERE sexe = 'Homme'), 0) AS nh, nullif(count(*) FILTER (WHERE sexe = 'Femme'), 0) AS nf
  FROM base WHERE grade_principal IN {REPORT} AND sexe <> 'Autre' GROUP BY 1, 2, 3, 4)
SELECT annee, mois, date_mois, grade_principal, h AS salaire_moyen_homme, f AS salaire_moyen_femme, nh AS effectif_homme,
nf AS effectif_femme, round((f - h) / nullif(h, 0) * 100, 1) AS ecart_pct_hf FROM c""",
)
view("v6_bareme", views.indicators_bareme, f"SELECT annee, mois, date_mois, bareme, {_LONG} FROM base GROUP BY 1, 2, 3, 4")
view(
    "v6_bareme_grade",
    views.indicators_bareme_grade,
    f"""SELECT annee, mois, date_mois, bareme, grade_principal, {_SHORT} FROM base WHERE grade_principal IN {REPORT}
GROUP BY 1, 2, 3, 4, 5""",
)
view(
    "v6_bareme_sex",
    views.indicators_bareme_sex,
    f"SELECT annee, mois, date_mois, bareme, sexe, {_SHORT} FROM base WHERE sexe <> 'Autre' GROUP BY 1, 2, 3, 4, 5",
)
define(
    "posts_of",
    "SELECT annee, mois, date_mois, grade_principal, matricule, count(*) AS nb_postes FROM base GROUP BY 1, 2, 3, 4, 5",
)
view(
    "v7_posts_by_grade",
    views.posts_by_grade,
    "SELECT annee, mois, date_mois, grade_principal, nb_postes, count(*) AS effectif FROM posts_of GROUP BY 1, 2, 3, 4, 5",
)
view(
    "v7_multi_post_rate",
    views.multi_post_rate,
    f"""SELECT annee, mois, date_mois, grade_principal, count(DISTINCT matricule) AS total_agents,
count(*) FILTER (WHERE nb_postes > 1) AS agents_multipostes,
round(count(*) FILTER (WHERE nb_postes > 1) * 100.0::DOUBLE / count(DISTINCT matricule), 1) AS taux_multipostes_pct
FROM posts_of WHERE grade_principal IN {REPORT} GROUP BY 1, 2, 3, 4""",
)
view(
    "v8_yearly",
    views.yearly_kpis,
    f"""SELECT annee, grade_principal, bareme, sexe, count(DISTINCT matricule) AS nb_agents_distincts, count(*) AS nb_observations,
{whole("avg(montant_brut)")} AS revenu_moyen, {_Q}, {whole("sum(montant_brut)")} AS masse_salariale_brute FROM base GROUP BY 1, 2, 3, 4""",
)
view(
    "v9_refresh_control",
    views.refresh_control,
    """SELECT count(*) AS total_lignes, min(date_mois) AS periode_debut, max(date_mois) AS periode_fin,
count(DISTINCT date_mois) AS nb_mois FROM base""",
)
view(
    "v9_refresh_bareme",
    views.refresh_control_bareme,
    """SELECT bareme, count(DISTINCT matricule) AS agents FROM base
WHERE date_mois = (SELECT max(date_mois) FROM base) GROUP BY 1""",
)
