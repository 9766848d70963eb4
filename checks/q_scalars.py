"""Scalar functions and Bronze to Silver projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.frames import frame, graded, imputed, panel, silver, table
from checks.registry import VALID, define, register
from paypanel.functions import dates, grades, people, text
from paypanel.operators import schema
from paypanel.operators import silver as sil

SRC = "panel_src"


def key_sql(e: str) -> str:
    """Label key: punctuation to blanks, upper, no accents, squeezed."""
    return (
        f"nullif(trim(regexp_replace(strip_accents(upper(translate({e}, '-.,;:()[]/''', '            '))), '\\s+', ' ', 'g')), '')"
    )


@register("x01_norm_label", f"SELECT situation_matrimoniale AS s, {key_sql('situation_matrimoniale')} AS k, count(*) AS n FROM {SRC} GROUP BY 1, 2")
def _(spark, sf):
    d = frame(spark, sf, SRC).groupBy(F.col("situation_matrimoniale").alias("s")).agg(F.count("*").alias("n"))
    return d.withColumn("k", text.norm_label("s"))


@register(
    "x01_norm_label_parts",
    f"SELECT p_partkey, {key_sql('p_name')} AS k FROM part",
)
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.norm_label("p_name").alias("k"))


@register(
    "x02_norm_label_lower",
    """SELECT row_id, nullif(trim(regexp_replace(translate(lower(strip_accents(statut_fonctionnaire)), '-_''/.', '     '), '\\s+', ' ', 'g')), '') AS k
FROM panel_src""",
)
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", text.norm_label_lower("statut_fonctionnaire").alias("k"))


@register("x03_clean_place", "SELECT row_id, trim(upper(strip_accents(coalesce(sexe, '')))) AS k FROM panel_src")
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", text.clean_place("sexe").alias("k"))


@register("x04_extract_grade", 'SELECT row_id, GRADE FROM graded')
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", grades.extract_grade("statut_fonctionnaire").alias("GRADE"))


@register(
    "x04_civil_servant_grade",
    """SELECT row_id, CASE WHEN statut_fonctionnaire LIKE 'Fonctionnaire Cat%' THEN split_part(statut_fonctionnaire, ' ', 3) END AS g
FROM panel_src""",
)
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", grades.civil_servant_grade("statut_fonctionnaire").alias("g"))


@register(
    "x05_grade_order",
    """SELECT DISTINCT GRADE, CASE WHEN length(GRADE) = 2 AND GRADE <> 'NF' THEN (ascii('I') - ascii(GRADE)) * 10
  + CAST(substr(GRADE, 2, 1) AS INTEGER) ELSE 0 END AS ordre FROM graded""",
)
def _(spark, sf):
    return graded(spark, sf).select("GRADE").distinct().withColumn("ordre", grades.grade_order("GRADE"))


@register(
    "x06_grade_category",
    """SELECT row_id, CASE WHEN GRADE = 'NF' THEN 'Non Fonctionnaire' WHEN GRADE IN ('A3','A4','A5','A6','A7','B1','B3','C1','C2','C3','D1','D2')
THEN 'Catégorie ' || left(GRADE, 1) ELSE 'Autre' END AS cat, CASE WHEN GRADE = 'NF' THEN 'Autre' ELSE 'Catégorie ' || left(GRADE, 1) END AS lettre FROM graded""",
)
def _(spark, sf):
    return graded(spark, sf).select(
        "row_id", grades.grade_category("GRADE").alias("cat"), grades.grade_letter_category("GRADE").alias("lettre")
    )


@register(
    "x07_citp_group",
    """SELECT p_partkey, TRY_CAST(regexp_extract(trim(p_name), '^[0-9]') AS INTEGER) AS g1,
CASE WHEN regexp_extract(CAST(p_partkey AS VARCHAR), '[0-9]') <> '0' THEN CAST(regexp_extract(CAST(p_partkey AS VARCHAR), '[0-9]') AS INTEGER) END AS g2
FROM part""",
)
def _(spark, sf):
    code = F.col("p_partkey").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey", grades.citp_group("p_name").alias("g1"), grades.citp_group_any(code).alias("g2")
    )


@register(
    "x08_labels",
    """SELECT DISTINCT mois, ['Janvier','Février','Mars','Avril','Mai','Juin','Juillet','Août','Septembre','Octobre','Novembre','Décembre'][mois] AS nom,
CASE mois WHEN 1 THEN '1 - Directeurs & cadres' WHEN 2 THEN '2 - Professions intellectuelles' WHEN 3 THEN '3 - Professions intermédiaires'
WHEN 4 THEN '4 - Employés administratifs' WHEN 5 THEN '5 - Services & ventes' WHEN 6 THEN '6 - Agriculture' WHEN 7 THEN '7 - Métiers qualifiés'
WHEN 8 THEN '8 - Opérateurs machines' WHEN 9 THEN '9 - Professions élémentaires' ELSE 'Non classé' END AS citp FROM graded""",
)
def _(spark, sf):
    m = graded(spark, sf).select("mois").distinct()
    return m.select("mois", people.month_fr("mois").alias("nom"), grades.citp_label("mois").alias("citp"))


@register("x09_std_sexe", "SELECT row_id, SEXE_STD AS s FROM graded")
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", people.std_sex("sexe").alias("s"))


@register(
    "x10_age_band",
    """SELECT row_id, CASE WHEN a IS NULL THEN 'Inconnu' WHEN a < 30 THEN '< 30 ans' WHEN a < 40 THEN '30–39 ans' WHEN a < 50 THEN '40–49 ans'
WHEN a < 60 THEN '50–59 ans' ELSE '60 ans +' END AS tranche FROM (SELECT row_id, 2001 - TRY_CAST(left(date_naissance, 4) AS INTEGER) AS a FROM panel_src)""",
)
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", people.age_band("date_naissance", 2001).alias("tranche"))


define(
    "births",
    """SELECT *, CASE WHEN date_naissance LIKE '__/__/____' THEN CAST(try_strptime(date_naissance, '%d/%m/%Y') AS DATE)
  WHEN date_naissance LIKE '____-__-__' THEN CAST(try_strptime(date_naissance, '%Y-%m-%d') AS DATE)
  WHEN TRY_CAST(date_naissance AS INTEGER) BETWEEN 1 AND 60000 THEN DATE '1899-12-30' + CAST(date_naissance AS INTEGER) END AS naissance,
  CAST(prise_service AS DATE) AS debut, last_day(make_date(annee, mois, 1)) AS collecte FROM graded""",
)


@register("x11_clean_date", "SELECT row_id, date_naissance, naissance FROM births")
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", "date_naissance", dates.clean_date("date_naissance").alias("naissance"))


@register("x12_date_ref", "SELECT row_id, CAST(date_trunc('month', coalesce(debut, collecte)) AS DATE) AS d FROM births")
def _(spark, sf):
    d = frame(spark, sf, SRC)
    return d.select("row_id", dates.date_ref(dates.clean_date("prise_service"), dates.month_end("mois_annee")).alias("d"))


@register("x13_age_years", "SELECT row_id, CAST(year(collecte) - year(naissance) - CASE WHEN strftime(collecte, '%m%d') < strftime(naissance, '%m%d') THEN 1 ELSE 0 END AS INTEGER) AS age FROM births")
def _(spark, sf):
    d = frame(spark, sf, SRC)
    age = dates.age_years(dates.clean_date("date_naissance"), dates.month_end("mois_annee"))
    return d.select("row_id", age.alias("age"))


@register(
    "x14_months_inclusive",
    """SELECT row_id, CAST(CASE WHEN date_trunc('month', debut) > collecte THEN 0 ELSE datediff('month', debut, collecte) + 1 END AS INTEGER) AS m
FROM births WHERE debut IS NOT NULL""",
)
def _(spark, sf):
    start = dates.clean_date("prise_service")
    d = frame(spark, sf, SRC).where(F.col("prise_service").isNotNull())
    return d.select("row_id", dates.months_inclusive(start, dates.month_end("mois_annee")).alias("m"))


@register("x15_norm_id", "SELECT c_custkey, upper(trim(c_name)) AS k FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.norm_id(F.concat(F.lit(" "), "c_name", F.lit(" "))).alias("k"))


@register(
    "x16_filled",
    """SELECT row_id, coalesce(lower(trim(sexe)) NOT IN ('', 'na', 'nan', 'none'), false) AS a,
coalesce(montant_net <> 0, false) AS b FROM panel_src""",
)
def _(spark, sf):
    return frame(spark, sf, SRC).select(
        "row_id", text.filled("sexe").alias("a"), F.coalesce(text.filled("montant_net", False, True), F.lit(False)).alias("b")
    )


@register("x17_month_end", "SELECT row_id, collecte FROM births")
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", dates.month_end("mois_annee").alias("collecte"))


@register(
    "x18_period_label",
    "SELECT DISTINCT annee, mois, strftime(make_date(annee, mois, 1), '%Y-%m') AS periode, make_date(annee, mois, 1) AS premier FROM graded",
)
def _(spark, sf):
    d = graded(spark, sf).select("annee", "mois").distinct()
    return d.select("annee", "mois", dates.period_label("annee", "mois").alias("periode"), dates.first_of_month("annee", "mois").alias("premier"))


register(
    "x19_first_of_month", "SELECT DISTINCT annee, mois, make_date(annee, mois, 1) AS premier FROM graded"
)(lambda spark, sf: graded(spark, sf).select("annee", "mois", dates.first_of_month("annee", "mois").alias("premier")).distinct())


# ------------------------------------------------------------------ F operators


@register(
    "f01_normalize_column_name",
    """SELECT p_partkey, trim(regexp_replace(regexp_replace(upper(replace(replace(p_name, ' ', '_'), '-', '_')), '[^A-Z0-9_]', '', 'g'), '_+', '_', 'g'), '_') AS nom
FROM part""",
)
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", schema.normalize_column_name_expr(F.col("p_name")).alias("nom"))


@register(
    "f04_cast_amounts",
    "SELECT row_id, TRY_CAST(date_naissance AS DOUBLE) AS montant_brut, TRY_CAST(nombre_enfant AS DOUBLE) AS \"124\" FROM panel_src",
)
def _(spark, sf):
    d = frame(spark, sf, SRC).select("row_id", F.col("date_naissance").alias("montant_brut"), F.col("nombre_enfant").alias("124"))
    return sil.cast_amounts(d)


@register("f05_normalize_situation", "SELECT row_id, situation_normalisee FROM graded")
def _(spark, sf):
    return sil.add_situation(frame(spark, sf, SRC)).select("row_id", "situation_normalisee")


@register("f06_filter_situations", "SELECT row_id, situation_normalisee FROM graded WHERE situation_normalisee <> 'autre'")
def _(spark, sf):
    return sil.filter_situations(sil.add_situation(frame(spark, sf, SRC))).select("row_id", "situation_normalisee")


@register(
    "f07_add_period",
    """SELECT row_id, annee, mois, periode, strftime(make_date(annee, mois, 1), '%Y-%m') AS m2, annee AS a2 FROM graded""",
)
def _(spark, sf):
    d = sil.add_period(frame(spark, sf, SRC).drop("periode"))
    d = d.withColumn("m2", dates.period_label("annee", "mois"))
    return d.select("row_id", "annee", "mois", "periode", "m2", dates.period_parts("m2")[0].alias("a2"))


@register("f08_select_panel", "SELECT cle_unique, matricule, GRADE, annee, mois, montant_brut, CAST(NULL AS VARCHAR) AS \"CODE_POSTE\" FROM panel")
def _(spark, sf):
    d = schema.select_panel(panel(spark, sf))
    return d.select("cle_unique", "matricule", "GRADE", "annee", "mois", "montant_brut", "CODE_POSTE")


@register(
    "f09_derive_keys",
    """SELECT row_id, left(cle_unique, 7) AS matricule_verif, substr(cle_unique, 8) AS code_organisme_verif,
CAST(length(cle_unique) AS INTEGER) AS longueur_cle FROM panel_src""",
)
def _(spark, sf):
    d = sil.derive_keys(frame(spark, sf, SRC), "cle_unique")
    return d.select("row_id", "matricule_verif", "code_organisme_verif", "longueur_cle")


WIDE = ["row_id", "prime_a", "prime-a (2)", "prime.a"]


def repeated(spark, sf):
    d = frame(spark, sf, SRC)
    return d.select(
        "row_id",
        F.when(F.col("row_id") % 3 == 0, F.col("montant_brut")).alias("prime_a"),
        F.when(F.col("row_id") % 3 == 1, F.col("montant_net")).alias("prime-a (2)"),
        F.when(F.col("row_id") % 2 == 0, F.lit(0.0)).otherwise(F.col("montant_net")).alias("prime.a"),
    )


define(
    "repeated",
    """SELECT row_id, CASE WHEN row_id % 3 = 0 THEN montant_brut END AS c1, CASE WHEN row_id % 3 = 1 THEN montant_net END AS c2,
CASE WHEN row_id % 2 = 0 THEN 0.0::DOUBLE ELSE montant_net END AS c3 FROM panel_src""",
)


@register("f10_coalesce_first", 'SELECT row_id, coalesce(c1, c2, c3) AS "prime a" FROM repeated')
def _(spark, sf):
    return schema.coalesce_repeated(repeated(spark, sf))


@register("f10_coalesce_nonzero", 'SELECT row_id, coalesce(nullif(c1, 0), nullif(c2, 0), nullif(c3, 0)) AS "prime a" FROM repeated')
def _(spark, sf):
    return schema.coalesce_repeated(repeated(spark, sf), zero_is_filled=False)


@register(
    "f10_coalesce_sum",
    'SELECT row_id, round(nullif(coalesce(c1, 0) + coalesce(c2, 0) + coalesce(c3, 0), 0), 6) AS "prime a" FROM repeated',
)
def _(spark, sf):
    d = schema.coalesce_repeated(repeated(spark, sf), "sum")
    return d.withColumn("prime a", F.round("prime a", 6))


@register(
    "f10_coalesce_concat",
    """SELECT row_id, nullif(concat_ws(' | ', nullif(trim(sexe), ''), nullif(trim(situation), '')), '') AS "etat" FROM panel_src""",
)
def _(spark, sf):
    d = frame(spark, sf, SRC).select("row_id", F.trim("sexe").alias("etat"), F.trim("situation").alias("ETAT (b)"))
    return schema.coalesce_repeated(d, "concat")


@register(
    "f11_first_filled",
    """SELECT row_id, coalesce(nullif(trim(sexe), ''), nullif(trim(situation), '')) AS a,
TRY_CAST(coalesce(nullif(trim(date_naissance), ''), nullif(trim(nombre_enfant), '')) AS DOUBLE) AS b FROM panel_src""",
)
def _(spark, sf):
    return frame(spark, sf, SRC).select(
        "row_id", text.first_filled("sexe", "situation").alias("a"),
        text.first_filled_amount("date_naissance", "nombre_enfant").alias("b"),
    )


@register(
    "f12_drop_if_others_empty",
    """SELECT row_id FROM panel_src WHERE (CASE WHEN montant_brut IS NULL THEN 0 ELSE 1 END + CASE WHEN montant_net IS NULL THEN 0 ELSE 1 END) = 1
OR coalesce(trim(situation), '') <> '' OR coalesce(trim(sexe), '') <> ''""",
)
def _(spark, sf):
    d = frame(spark, sf, SRC).select("row_id", "montant_brut", "montant_net", "situation", "sexe")
    out = sil.drop_if_others_empty(d, ["montant_brut", "montant_net"], ["row_id", "montant_brut", "montant_net"])
    return out.select("row_id")


LABELS = [("124", "SOLDE"), ("228", "PRIME"), ("271", "PRIME"), ("421", "LOGEMENT")]


@register(
    "f13_rename_by_codes",
    """SELECT CASE code WHEN '124' THEN 'SOLDE' WHEN '228' THEN 'PRIME (code 228)' WHEN '271' THEN 'PRIME (code 271)'
WHEN '421' THEN 'LOGEMENT' ELSE code END AS poste, count(*) AS n, round(sum(montant), 2) AS total FROM paycodes GROUP BY 1""",
)
def _(spark, sf):
    labels = spark.createDataFrame(LABELS, "code string, libelle string")
    d = sil.label_items(frame(spark, sf, "paycodes"), labels)
    return d.groupBy("poste").agg(F.count("*").alias("n"), F.round(F.sum("montant"), 2).alias("total"))


@register("f14_filter_valid_grades", f"SELECT row_id, GRADE FROM imputed WHERE GRADE IN {VALID} AND montant_brut > 0")
def _(spark, sf):
    return sil.filter_valid_grades(imputed(spark, sf)).select("row_id", "GRADE")


@register("f14_filter_valid_grades_zero", f"SELECT row_id, GRADE FROM imputed WHERE GRADE IN {VALID}")
def _(spark, sf):
    return sil.filter_valid_grades(imputed(spark, sf), include_zero=True).select("row_id", "GRADE")


@register("f15_filter_panel_base", "SELECT row_id FROM panel WHERE montant_brut > 0 AND annee >= 1997 AND GRADE <> ''")
def _(spark, sf):
    return sil.filter_panel_base(panel(spark, sf), 1997).select("row_id")


@register("f16_apply_filters", "SELECT row_id FROM panel WHERE SEXE_STD = 'Femme' AND annee IN (1996, 1997)")
def _(spark, sf):
    choices = {"SEXE_STD": ["Femme"], "annee": [1996, 1997], "emploi": ["Tous"], "GRADE": []}
    return sil.apply_filters(panel(spark, sf), choices).select("row_id")


CODES = ["124", "195", "200", "228", "271", "421", "425"]


@register(
    "f18_pivot_paycodes",
    "SELECT row_id, " + ", ".join(f"round(sum(montant) FILTER (WHERE code = '{c}'), 4) AS \"{c}\"" for c in CODES) + " FROM paycodes GROUP BY 1",
)
def _(spark, sf):
    d = sil.pivot_paycodes(frame(spark, sf, "paycodes"), ["row_id"], CODES)
    return d.withColumns({c: F.round(F.col(f"`{c}`"), 4) for c in CODES})


@register("f18_unpivot_paycodes", "SELECT row_id, code, round(sum(montant), 4) AS montant FROM paycodes GROUP BY 1, 2")
def _(spark, sf):
    d = sil.unpivot_paycodes(sil.pivot_paycodes(frame(spark, sf, "paycodes"), ["row_id"], CODES), ["row_id"])
    return d.withColumn("montant", F.round("montant", 4))


@register(
    "i07_marital",
    """SELECT row_id, CASE situation_matrimoniale WHEN 'Femme Mariée' THEN 'Marié(e)' WHEN 'Veuf / veuve' THEN 'Veuf/Veuve'
WHEN 'Cas Particulier' THEN 'Autres' ELSE situation_matrimoniale END AS s FROM panel_src""",
)
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", people.recode_marital("situation_matrimoniale").alias("s"))


@register("i08_children", "SELECT row_id, coalesce(CAST(nombre_enfant AS BIGINT), 0) AS n FROM panel_src")
def _(spark, sf):
    return frame(spark, sf, SRC).select("row_id", people.children_count("nombre_enfant").alias("n"))


define(
    "cats",
    """SELECT row_id, emploi, matricule, periode, annee, coalesce(nullif(regexp_extract(upper(strip_accents(statut_fonctionnaire)),
  'CATEGORIE\\s+([A-D])', 1), ''), 'Non Fonctionnaire') AS c1,
CASE WHEN GRADE = 'NF' THEN 'Non Fonctionnaire' ELSE left(GRADE, 1) END AS c2,
CASE WHEN row_id % 23 = 0 THEN ' ' ELSE emploi END AS job FROM graded""",
)


def cats(spark, sf):
    d = graded(spark, sf).withColumns(
        {
            "c1": grades.category_from_grade_text("statut_fonctionnaire"),
            "c2": grades.category_from_grade_code("GRADE"),
            "job": F.when(F.col("row_id") % 23 == 0, " ").otherwise(F.col("emploi")),
        }
    )
    return d.withColumn("STATUT", people.build_status("job", "c1", "c2"))


@register("i09_categories", "SELECT row_id, c1, c2 FROM cats")
def _(spark, sf):
    return cats(spark, sf).select("row_id", "c1", "c2")


define(
    "stat",
    """SELECT *, CASE WHEN trim(job) <> '' AND (c1 = 'Non Fonctionnaire' OR c2 = 'Non Fonctionnaire') THEN 'Cas particulier'
WHEN trim(job) = '' AND (length(c1) = 1 OR length(c2) = 1) THEN 'Cas particulier'
WHEN trim(job) <> '' AND length(c1) = 1 AND length(c2) = 1 THEN 'Fonctionnaire' ELSE 'Non Fonctionnaire' END AS STATUT FROM cats""",
)


@register("i10_status", "SELECT row_id, STATUT FROM stat")
def _(spark, sf):
    return cats(spark, sf).select("row_id", "STATUT")


@register(
    "i13_status_from_id",
    """SELECT DISTINCT matricule, CASE WHEN matricule LIKE '5%' THEN 'Contractuel' WHEN matricule LIKE '6%' THEN 'Gens de maison'
ELSE 'Fonctionnaire' END AS statut FROM panel_src""",
)
def _(spark, sf):
    d = frame(spark, sf, SRC).select("matricule").distinct()
    return d.withColumn("statut", people.status_from_id("matricule"))


# Job titles made from the given tables: every rule of the pay scale is reached.
TITLES = {
    0: "Ambassadeur", 1: "Corps Préfectoral", 2: "Juge", 3: "Greffier", 4: "Maitre de conferences", 5: "Instituteur",
    6: "Medecin", 7: "Infirmier", 8: "Commissaire", 9: "Garde de sous-prefecture", 10: "Professeur titulaire",
}
define(
    "titled",
    "SELECT row_id, GRADE, organisme, CASE row_id % 13 "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in TITLES.items())
    + " ELSE emploi END AS titre FROM graded",
)
SCALE_RULES = [
    ("CORPS DIPL", "upper(titre) SIMILAR TO '.*(AMBASSAD|CONSUL).*'"),
    ("CORPS PREF", "titre = 'Corps Préfectoral' OR upper(titre) LIKE '%GARDE DE SOUS-PREF%'"),
    ("MAGISTRAT", "upper(titre) SIMILAR TO '.*(MAGISTR|JUGE|PROCUREUR).*'"),
    ("GREFFE", "upper(titre) LIKE '%GREFF%'"),
    ("ENS SUP", "upper(titre) SIMILAR TO '.*(MAITRE DE CONF|PROFESSEUR TITULAR).*'"),
    ("ENS SEC & PRIM", "upper(titre) SIMILAR TO '.*(INSTITUTEUR|PROFESSEUR|EDUCATEUR).*'"),
    ("Cadre-Sup-Santé", "upper(titre) LIKE '%MEDECIN%' AND GRADE IN ('A4','A5','A6','A7')"),
    ("Tech-Santé", "upper(titre) LIKE '%INFIRMI%'"),
    ("police", "upper(titre) LIKE '%COMMISSAIRE%'"),
    ("Non Fonctionnaire", "GRADE = 'NF'"),
]


@register(
    "i15_bareme_rules",
    "SELECT row_id, CASE " + " ".join(f"WHEN {c} THEN '{s}'" for s, c in SCALE_RULES) + " ELSE 'Barême Général' END AS bareme FROM titled",
)
def _(spark, sf):
    title = grades.lookup(F.col("row_id") % 13, TITLES, F.col("emploi"))
    return graded(spark, sf).select("row_id", grades.bareme_rules("organisme", title, "GRADE").alias("bareme"))


@register("i18_tenure_simple", "SELECT row_id, anciennete FROM tenured")
def _(spark, sf):
    d = silver(spark, sf)
    return d.select("row_id", dates.tenure_years(F.col("prise_service").cast("date"), dates.month_end("mois_annee")).alias("anciennete"))


@register("i19_age_at_start", "SELECT row_id, CAST(floor((debut - naissance) / 365.0::DOUBLE) AS INTEGER) AS age FROM births")
def _(spark, sf):
    start = dates.clean_date("prise_service")
    return frame(spark, sf, SRC).select("row_id", dates.age_at_start(dates.clean_date("date_naissance"), start).alias("age"))


# Untidy headers under which the same columns arrive.
RAW_HEADERS = {
    "row_id": "Ligne",
    "matricule": "T12.Matricule",
    "cle_unique": "MATRICULE||CODE_ORGANISME",
    "emploi": "Corps",
    "statut_fonctionnaire": "Grade",
    "montant_brut": "Rémunération brute",
    "sexe": "SEXE",
    "situation": "Situation administrative",
}


@register(
    "f02_map_columns",
    """SELECT row_id AS ligne, matricule, cle_unique, emploi, statut_fonctionnaire, montant_brut, sexe, situation FROM panel_src""",
)
def _(spark, sf):
    d = frame(spark, sf, SRC).select(*[F.col(c).alias(h) for c, h in RAW_HEADERS.items()])
    return schema.standardize(d)


@register(
    "f03_dedupe_names",
    """SELECT row_id AS ligne, emploi, organisme AS "emploi_dup2", CODE_EMPLOI AS "emploi_dup3" FROM panel_src""",
)
def _(spark, sf):
    d = frame(spark, sf, SRC)
    d = d.select(F.col("row_id").alias("ligne"), F.col("emploi").alias("EMPLOI"), F.col("organisme").alias("Corps"), F.col("CODE_EMPLOI").alias("corps d'emploi"))
    return schema.standardize(d)


@register("u02_stack_strict", "SELECT row_id, emploi FROM panel_src")
def _(spark, sf):
    d = frame(spark, sf, SRC).select("row_id", "emploi")
    return schema.stack_strict([d.where(f"row_id % 3 = {i}") for i in range(3)])


@register(
    "u06_compare_columns",
    """SELECT row_id, emploi, montant_brut, CAST(NULL AS VARCHAR) AS sexe FROM panel_src WHERE row_id % 2 = 0
UNION ALL SELECT row_id, emploi, NULL, sexe FROM panel_src WHERE row_id % 2 = 1""",
)
def _(spark, sf):
    d = frame(spark, sf, SRC)
    a = d.where("row_id % 2 = 0").select("row_id", "emploi", "montant_brut")
    b = d.where("row_id % 2 = 1").select("row_id", "sexe", "emploi")
    sides = schema.compare_columns(a, b)
    return schema.stack_by_name([a, b]).select(*sides["common"], *sides["only_left"], *sides["only_right"])
