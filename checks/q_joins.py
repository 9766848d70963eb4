"""Joins, stacking, period differences, sources that SQL can restate."""

from __future__ import annotations


from pyspark.sql import functions as F

from checks.frames import frame, graded, rounded, silver, table
from checks.q_scalars import key_sql
from checks.registry import define, register
from paypanel.operators import joins, sets
from paypanel.operators import windows as win
from paypanel.functions.text import norm_label
from paypanel.operators.schema import stack_by_name
from paypanel.operators.silver import pivot_paycodes

CODES = ["124", "228", "271"]


@register(
    "j01_join_sheets",
    """WITH p AS (SELECT row_id, sum(montant) FILTER (WHERE code = '124') AS a, sum(montant) FILTER (WHERE code = '228') AS b,
  sum(montant) FILTER (WHERE code = '271') AS c FROM paycodes GROUP BY 1)
SELECT s.row_id, s.cle_unique, round(a, 4) AS "124", round(b, 4) AS "228", round(c, 4) AS "271" FROM silver s LEFT JOIN p ON p.row_id = s.row_id""",
)
def _(spark, sf):
    items = pivot_paycodes(frame(spark, sf, "paycodes"), ["row_id"], CODES)
    d = joins.join_sheets(silver(spark, sf).select("row_id", "cle_unique"), items, "row_id")
    return d.withColumns({c: F.round(F.col(f"`{c}`"), 4) for c in CODES})


define("org_key", f"SELECT code, {key_sql('libelle')} AS k FROM dim_organisme")
define("org_one", "SELECT k, min(code) AS code FROM org_key GROUP BY 1")


@register(
    "j02_enrich_codes",
    """SELECT s.row_id, o.code AS "CODE_ORG", left(d.code, 3) AS "CODE_EMP", d.Code_CITP, d.Metier_CITP, CAST(NULL AS VARCHAR) AS "CODE_SERVICE"
FROM silver s LEFT JOIN org_one o ON o.k = upper(s.organisme) LEFT JOIN dim_emploi d ON upper(d.libelle) = s.emploi""",
)
def _(spark, sf):
    service = spark.createDataFrame([("1", "x")], "code string, libelle string")
    dims = {
        "CODE_ORG": (frame(spark, sf, "dim_organisme"), "organisme", []),
        "CODE_EMP": (frame(spark, sf, "dim_emploi"), "emploi", ["Code_CITP", "Metier_CITP"]),
        "CODE_SERVICE": (service, "service", []),
    }
    d = joins.enrich_codes(silver(spark, sf), dims)
    return d.select("row_id", "CODE_ORG", "CODE_EMP", "Code_CITP", "Metier_CITP", "CODE_SERVICE")


@register(
    "j04_fill_from_lookup",
    """SELECT s.row_id, coalesce(s.CODE_ORGANISME, o.code) AS CODE_ORGANISME FROM silver s LEFT JOIN org_one o ON o.k = s.organisme""",
)
def _(spark, sf):
    lk = joins.code_table(frame(spark, sf, "dim_organisme")).select(
        F.col("libelle_norm").alias("organisme"), F.col("code").alias("CODE_ORGANISME")
    )
    return joins.fill_from_lookup(silver(spark, sf), lk, "organisme", ["CODE_ORGANISME"]).select("row_id", "CODE_ORGANISME")


@register(
    "j04_fill_audit",
    """SELECT s.row_id, s.organisme, s.CODE_ORGANISME AS "CODE_ORGANISME_BEFORE", o.code AS "CODE_ORGANISME_AFTER"
FROM silver s JOIN org_one o ON o.k = s.organisme WHERE s.CODE_ORGANISME IS NULL""",
)
def _(spark, sf):
    lk = joins.code_table(frame(spark, sf, "dim_organisme")).select(
        F.col("libelle_norm").alias("organisme"), F.col("code").alias("CODE_ORGANISME")
    )
    return joins.fill_audit(silver(spark, sf), lk, "organisme", "CODE_ORGANISME", ["row_id"])


@register(
    "j05_outer_reconcile",
    """WITH l AS (SELECT matricule, periode, row_id AS r0 FROM silver WHERE row_id % 3 <> 0),
  r AS (SELECT matricule, periode, min(row_id) AS r1 FROM silver WHERE row_id % 2 = 0 GROUP BY 1, 2)
SELECT coalesce(l.matricule, r.matricule) AS matricule, coalesce(l.periode, r.periode) AS periode, r0 AS row_id_b0, r1 AS row_id_b1,
CASE WHEN r1 IS NULL THEN 'base1' WHEN r0 IS NULL THEN 'base2' ELSE 'both' END AS "IN_SRC", r0 IS NOT NULL AS "IN_BASE1", r1 IS NOT NULL AS "IN_BASE2"
FROM l FULL JOIN r ON l.matricule = r.matricule AND l.periode = r.periode""",
)
def _(spark, sf):
    d = silver(spark, sf).select("matricule", "periode", "row_id")
    a, b = d.where(F.col("row_id") % 3 != 0), d.where(F.col("row_id") % 2 == 0)
    return joins.outer_reconcile(a, b, ["matricule", "periode"], ["row_id"])


@register(
    "j06_unmatched",
    "SELECT emploi AS libelle, count(*) AS n FROM silver WHERE emploi NOT IN (SELECT upper(libelle) FROM dim_emploi) GROUP BY 1",
)
def _(spark, sf):
    ref = frame(spark, sf, "dim_emploi").withColumn("k", norm_label("libelle"))
    return joins.unmatched(silver(spark, sf), ref, "emploi", "k")


define("several", "SELECT k, count(DISTINCT code) AS n_codes FROM org_key GROUP BY 1 HAVING count(DISTINCT code) > 1")


@register("j07_ambiguous", "SELECT * FROM several")
def _(spark, sf):
    return joins.ambiguous(frame(spark, sf, "dim_organisme").withColumn("k", norm_label("libelle")), "k", "code")


@register("j07_drop_ambiguous", "SELECT k, code FROM org_key WHERE k NOT IN (SELECT k FROM several)")
def _(spark, sf):
    d = frame(spark, sf, "dim_organisme").withColumn("k", norm_label("libelle"))
    return joins.drop_ambiguous(d, "k", "code").select("k", "code")


@register(
    "j08_two_pass_match",
    """SELECT s.row_id, coalesce(a.code, b.code) AS code, CASE WHEN a.code IS NOT NULL THEN 1 WHEN b.code IS NOT NULL THEN 2 ELSE 0 END AS passe
FROM silver s LEFT JOIN (SELECT * FROM org_key WHERE k NOT IN (SELECT k FROM several)) a ON a.k = s.organisme
LEFT JOIN org_one b ON b.k = s.organisme""",
)
def _(spark, sf):
    d = frame(spark, sf, "dim_organisme").withColumn("k", norm_label("libelle"))
    first = joins.drop_ambiguous(d, "k", "code").select(F.col("k").alias("organisme"), "code")
    second = d.groupBy(F.col("k").alias("organisme")).agg(F.min("code").alias("code"))
    return joins.two_pass_match(silver(spark, sf), first, second, "organisme", "code").select("row_id", "code", "passe")


@register(
    "j12_month_grid",
    """SELECT m.matricule, CAST(d AS DATE) AS mois_date, (SELECT count(*) FROM silver s WHERE s.matricule = m.matricule
  AND s.annee = year(d) AND s.mois = month(d)) AS n
FROM (SELECT DISTINCT matricule FROM silver) m, generate_series(DATE '1996-01-01', DATE '1996-12-01', INTERVAL 1 MONTH) t(d)""",
)
def _(spark, sf):
    d = silver(spark, sf).withColumn("mois_date", F.make_date("annee", "mois", F.lit(1)))
    n = d.groupBy("matricule", "mois_date").agg(F.count("*").alias("n"))
    grid = joins.month_grid(d, ["matricule"], "1996-01-01", "1996-12-01")
    return grid.join(n, ["matricule", "mois_date"], "left").fillna(0, ["n"])


@register(
    "j13_id_overlap",
    """WITH a AS (SELECT DISTINCT matricule FROM silver WHERE annee < 1996), b AS (SELECT DISTINCT matricule FROM silver WHERE annee >= 1996)
SELECT (SELECT count(*) FROM a) AS n_gauche, (SELECT count(*) FROM b) AS n_droite,
(SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS communs,
(SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS manquants,
(SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS surplus""",
)
def _(spark, sf):
    d = silver(spark, sf)
    return joins.id_overlap(d.where("annee < 1996"), d.where("annee >= 1996"), "matricule")


@register(
    "j14_new_membership",
    """SELECT row_id, matricule NOT IN (SELECT matricule FROM silver WHERE annee < 1998) AS est_nouveau FROM silver WHERE annee >= 1998""",
)
def _(spark, sf):
    d = silver(spark, sf)
    return joins.new_membership(d.where("annee >= 1998"), d.where("annee < 1998"), "matricule").select("row_id", "est_nouveau")


@register(
    "j15_geo_join",
    """WITH loc AS (SELECT n_name AS nom, n_regionkey AS reg FROM nation UNION ALL SELECT n_name, 9 FROM nation WHERE n_nationkey % 7 = 0)
SELECT row_id, (SELECT min(reg) FROM loc WHERE nom = organisme HAVING count(*) = 1) AS cod_reg FROM silver""",
)
def _(spark, sf):
    n = table(spark, sf, "nation").select(F.lower("n_name").alias("nom"), F.col("n_regionkey").alias("cod_reg"), "n_nationkey")
    loc = n.unionByName(n.where("n_nationkey % 7 = 0").withColumn("cod_reg", F.lit(9)))
    return joins.geo_join(silver(spark, sf), loc, "organisme", "nom", ["cod_reg"]).select("row_id", "cod_reg")


@register(
    "q06_match_rate",
    """SELECT periode, round(count(CODE_ORGANISME) * 100.0::DOUBLE / count(*), 1) AS CODE_ORGANISME,
round(count(CODE_EMPLOI) * 100.0::DOUBLE / count(*), 1) AS CODE_EMPLOI FROM silver GROUP BY 1""",
)
def _(spark, sf):
    from paypanel.operators.quality import match_rates

    return match_rates(silver(spark, sf), ["CODE_ORGANISME", "CODE_EMPLOI"])


# ------------------------------------------------------------------ windows


@register(
    "w08_presence_tenure",
    """WITH g AS (SELECT m.matricule, CAST(d AS DATE) AS mois_date, (SELECT count(*) FROM silver s WHERE s.matricule = m.matricule
    AND s.annee = year(d) AND s.mois = month(d)) AS n
  FROM (SELECT DISTINCT matricule FROM silver WHERE annee BETWEEN 1996 AND 1997) m,
    generate_series(DATE '1996-01-01', DATE '1997-12-01', INTERVAL 1 MONTH) t(d)),
  b AS (SELECT matricule, min(CAST(prise_service AS DATE)) AS p FROM silver WHERE annee BETWEEN 1996 AND 1997 GROUP BY 1),
  c AS (SELECT g.matricule, g.mois_date, n AS nb_lignes, CAST(n > 0 AS INTEGER) AS presence,
    (SELECT count(*) FROM g h WHERE h.matricule = g.matricule AND h.mois_date <= g.mois_date AND h.n > 0) AS anciennete_mois,
    CAST(coalesce(datediff('month', p, DATE '1995-12-01') + 1, 0) AS INTEGER) AS base_mois FROM g JOIN b ON b.matricule = g.matricule)
SELECT *, anciennete_mois // 12 AS anciennete_an, anciennete_mois + base_mois AS anciennete_mois_total,
(anciennete_mois + base_mois) // 12 AS anciennete_an_total FROM c""",
)
def _(spark, sf):
    d = silver(spark, sf).withColumns(
        {"mois_date": F.make_date("annee", "mois", F.lit(1)), "debut": F.col("prise_service").cast("date")}
    )
    return win.presence_tenure(d, ["matricule"], "debut", "1996-01-01", "1997-12-01")


define(
    "entry",
    """SELECT matricule, organisme, coalesce(arg_min(debut, epoch(collecte) * 1000000 + row_id) FILTER (WHERE debut IS NOT NULL), min(collecte)) AS e
FROM births GROUP BY 1, 2""",
)


@register(
    "w09_org_tenure",
    """SELECT b.row_id, e.e AS date_entree_org, CAST(datediff('month', e.e, b.collecte) + 1 AS INTEGER) AS anciennete_org_mois,
CAST((datediff('month', e.e, b.collecte) + 1) // 12 AS INTEGER) AS anciennete_org_an
FROM births b JOIN entry e ON e.matricule = b.matricule AND e.organisme = b.organisme""",
)
def _(spark, sf):
    from paypanel.functions.dates import month_end

    d = graded(spark, sf).withColumns(
        {"collecte": month_end("mois_annee"), "debut": F.col("prise_service").cast("date")}
    )
    out = win.org_tenure(d, ["matricule", "organisme"], "collecte", "debut")
    return out.select("row_id", "date_entree_org", "anciennete_org_mois", "anciennete_org_an")


@register(
    "w11_first_seen",
    """SELECT p AS premier_mois, count(*) AS nb_nouveaux FROM (SELECT matricule, min(periode) AS p FROM silver GROUP BY 1) GROUP BY 1""",
)
def _(spark, sf):
    return win.first_seen(silver(spark, sf))


@register(
    "w11_yearly_arrivals",
    """WITH y AS (SELECT DISTINCT matricule, annee FROM silver),
  t AS (SELECT *, NOT EXISTS (SELECT 1 FROM y b WHERE b.matricule = y.matricule AND b.annee < y.annee) AS nouveau,
    EXISTS (SELECT 1 FROM y b WHERE b.matricule = y.matricule AND b.annee < y.annee) AND NOT EXISTS (
      SELECT 1 FROM y b WHERE b.matricule = y.matricule AND b.annee = y.annee - 1) AS retour FROM y)
SELECT annee, count(*) AS nb_individus, count(*) FILTER (WHERE nouveau) AS nb_nouveaux, count(*) FILTER (WHERE retour) AS nb_reapparus,
(SELECT count(*) FROM silver s WHERE s.annee = t.annee) AS nb_obs, round(count(*) FILTER (WHERE nouveau) * 100.0::DOUBLE / count(*), 1) AS pct_nouveaux
FROM t GROUP BY annee""",
)
def _(spark, sf):
    return win.yearly_arrivals(silver(spark, sf))


define(
    "declared",
    """SELECT organisme, periode, CAST(count(montant_net) FILTER (WHERE row_id % 5 = 0) > 0 AS INTEGER) AS d FROM silver GROUP BY 1, 2""",
)


@register(
    "w12_declaration_history",
    """WITH o AS (SELECT *, row_number() OVER (PARTITION BY organisme ORDER BY periode) AS r FROM declared)
SELECT o.organisme, o.periode, o.d, coalesce(a.d, 1) AS hist_decl_1, round((coalesce(a.d, 1) + coalesce(b.d, 1) + coalesce(c.d, 1)) / 3.0::DOUBLE, 8) AS hist_decl_3
FROM o LEFT JOIN o a ON a.organisme = o.organisme AND a.r = o.r - 1 LEFT JOIN o b ON b.organisme = o.organisme AND b.r = o.r - 2
LEFT JOIN o c ON c.organisme = o.organisme AND c.r = o.r - 3""",
)
def _(spark, sf):
    d = silver(spark, sf).groupBy("organisme", "periode").agg(
        (F.count(F.when(F.col("row_id") % 5 == 0, F.col("montant_net"))) > 0).cast("int").alias("d")
    )
    return rounded(win.declaration_history(d, "organisme", "periode", "d"), 8, "hist_decl_3")


@register(
    "w13_pct_of_total",
    """SELECT organisme, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM silver), 2) AS pct FROM silver GROUP BY 1""",
)
def _(spark, sf):
    n = silver(spark, sf).groupBy("organisme").agg(F.count("*").alias("n"))
    return win.pct_of_total(n, "n", "pct")


# ------------------------------------------------------------------ sets


@register(
    "t01_panel_order",
    "SELECT matricule, annee, mois, count(*) AS n FROM silver GROUP BY 1, 2, 3",
)
def _(spark, sf):
    d = sets.panel_order(silver(spark, sf), ["matricule", "annee", "mois"])
    return d.groupBy("matricule", "annee", "mois").agg(F.count("*").alias("n"))


@register("t02_top_k", "SELECT matricule, mois_annee, count(*) AS n FROM silver GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 20")
def _(spark, sf):
    n = silver(spark, sf).groupBy("matricule", "mois_annee").agg(F.count("*").alias("n"))
    return sets.top_k(n, "n", ["matricule", "mois_annee"], 20)


@register(
    "u01_stack_by_name",
    """SELECT row_id, montant_brut, CAST(NULL AS DOUBLE) AS montant_net FROM silver WHERE annee < 1996
UNION ALL SELECT row_id, NULL, montant_net FROM silver WHERE annee >= 1996""",
)
def _(spark, sf):
    d = silver(spark, sf)
    a = d.where("annee < 1996").select("row_id", "montant_brut")
    b = d.where("annee >= 1996").select("row_id", "montant_net")
    return stack_by_name([a, b])


define(
    "month_codes",
    "SELECT DISTINCT s.periode, p.code FROM silver s JOIN paycodes p ON p.row_id = s.row_id WHERE (s.periode + CAST(p.code AS INTEGER)) % 4 <> 0",
)


def month_codes(spark, sf):
    d = silver(spark, sf).select("row_id", "periode").join(frame(spark, sf, "paycodes"), "row_id")
    return d.where((F.col("periode") + F.col("code").cast("int")) % 4 != 0).select("periode", "code")


@register(
    "u03_neighbour_changes",
    """WITH c AS (SELECT periode, lead(periode) OVER (ORDER BY periode) AS nxt FROM (SELECT DISTINCT periode FROM month_codes))
SELECT c.periode AS periode_avant, c.nxt AS periode_apres, m.code, 'DISPARUE' AS changement FROM c JOIN month_codes m ON m.periode = c.periode
WHERE nxt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM month_codes x WHERE x.periode = c.nxt AND x.code = m.code)
UNION ALL SELECT c.periode, c.nxt, m.code, 'APPARUE' FROM c JOIN month_codes m ON m.periode = c.nxt
WHERE NOT EXISTS (SELECT 1 FROM month_codes x WHERE x.periode = c.periode AND x.code = m.code)""",
)
def _(spark, sf):
    return sets.neighbour_changes(month_codes(spark, sf), name="code")


@register("u04_period_counts", "SELECT periode, count(*) AS nb FROM month_codes GROUP BY 1")
def _(spark, sf):
    return sets.period_counts(month_codes(spark, sf), name="code")


@register(
    "u04_name_summary",
    """WITH p AS (SELECT periode, count(*) AS nb FROM month_codes GROUP BY 1)
SELECT min(nb) AS min_par_periode, max(nb) AS max_par_periode, round(avg(nb), 1) AS moyenne, (SELECT count(DISTINCT code) FROM month_codes) AS nb_distincts,
(SELECT min(code) FROM month_codes) AS premier, (SELECT max(code) FROM month_codes) AS dernier FROM p""",
)
def _(spark, sf):
    return sets.name_summary(month_codes(spark, sf), name="code")


@register(
    "u05_period_gaps",
    """WITH w AS (SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS periode FROM generate_series(DATE '1995-01-01', DATE '2000-12-01', INTERVAL 1 MONTH) t(d)),
  h AS (SELECT DISTINCT periode FROM silver WHERE mois <> 7)
SELECT periode, 'MANQUANTE' AS etat, periode IN (SELECT periode FROM silver) AS dans_couche_precedente FROM w WHERE periode NOT IN (SELECT periode FROM h)
UNION ALL SELECT periode, 'INATTENDUE', periode IN (SELECT periode FROM silver) FROM h WHERE periode NOT IN (SELECT periode FROM w)""",
)
def _(spark, sf):
    d = silver(spark, sf)
    return sets.period_gaps(d.where("mois <> 7"), d, 199501, 200012)


