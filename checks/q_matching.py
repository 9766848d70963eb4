"""Similarity matching, pseudonyms, estimators, files and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.frames import frame, graded, rounded, silver, table
from checks.registry import define, register
from paypanel.functions.dates import age_years, clean_date, month_end, tenure_years
from paypanel.functions.text import norm_label
from paypanel.operators import estimators as est
from paypanel.operators import matching as mat
from paypanel.operators import pseudonyms as pseudo
from paypanel.plans.stages import layer, shared_dir, written
from paypanel.sources import files
from paypanel.streaming import ingest

TEST_KEY = "0123456789abcdef"


def spread(rows):
    """The rows over all cores: a file of short rows is few splits, and labels take long to normalise."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def reference(spark, sf):
    """Code table of product labels: name and brand."""

    def build():
        lib = norm_label(F.concat_ws(" ", "p_name", "p_brand"))
        named = spread(table(spark, sf, "part").groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("first")))
        labelled = written(named.select(lib.alias("ref"), "first"), "reference-labels")
        return labelled.groupBy("ref").agg(F.min("first").cast("string").alias("code"))

    return layer(spark, f"reference {sf}", build)


def products(spark, sf):
    """Products labelled in another way, without a code."""

    def build():
        lib = norm_label(F.concat_ws(" ", "p_type", "p_name", F.concat("p_brand", F.lit("0"))))
        rows = spread(table(spark, sf, "part").select("p_partkey", "p_type", "p_name", "p_brand"))
        return rows.select("p_partkey", lib.alias("lib"), F.lit(None).cast("string").alias("code"))

    return layer(spark, f"products {sf}", build)


def suggestions(spark, sf):
    def build():
        ref = reference(spark, sf)
        d = products(spark, sf)
        unknown = d.join(ref.select(F.col("ref").alias("lib")), "lib", "left_anti")
        return mat.with_codes(mat.best_suggestions(unknown, ref, "lib", "ref"), ref, "ref", "code")

    return layer(spark, f"suggestions {sf}", build)


@register("j09_best_suggestions")
def _(spark, sf):
    return suggestions(spark, sf)


@register("j10_auto_apply")
def _(spark, sf):
    out, _audit = mat.auto_apply(products(spark, sf), suggestions(spark, sf), "lib", "code", ["p_partkey"])
    return out.select("p_partkey", "lib", "code")


@register("j10_auto_apply_audit")
def _(spark, sf):
    return mat.auto_apply(products(spark, sf), suggestions(spark, sf), "lib", "code", ["p_partkey"])[1]


@register(
    "j11_extend_mapping",
    """WITH m AS (SELECT upper(libelle) AS k, code FROM dim_emploi), a AS (SELECT 'FURNITURE' AS k, '777' AS code UNION ALL SELECT 'BUILDING', '888')
SELECT k, code FROM m WHERE k <> 'BUILDING' UNION ALL SELECT k, code FROM a""",
)
def _(spark, sf):
    m = frame(spark, sf, "dim_emploi").select(norm_label("libelle").alias("k"), "code")
    chosen = spark.createDataFrame([("FURNITURE", "777"), ("BUILDING", "888")], "libelle string, code string")
    return mat.extend_mapping(m, chosen, "k", "code")


# ------------------------------------------------------------------ pseudonyms

_IPAD = "".join(chr(b ^ 0x36) for b in TEST_KEY.encode().ljust(64, b"\0")).encode("latin1").hex()
_OPAD = "".join(chr(b ^ 0x5C) for b in TEST_KEY.encode().ljust(64, b"\0")).encode("latin1").hex()
HMAC = f"sha256(unhex('{_OPAD}') || unhex(sha256(unhex('{_IPAD}') || encode(m))))"
define("hashed", f"SELECT m AS original, {HMAC} AS pseudonyme FROM (SELECT DISTINCT matricule AS m FROM panel_src)")


@register("h01_hmac_id", "SELECT * FROM hashed")
def _(spark, sf):
    return pseudo.id_mapping(frame(spark, sf, "panel_src"), "matricule", TEST_KEY)


@register("h02_pbkdf2_id")
def _(spark, sf):
    return pseudo.id_mapping(frame(spark, sf, "panel_src"), "matricule", TEST_KEY)


@register("h03_collisions", "SELECT pseudonyme, count(*) AS n FROM hashed GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf):
    return pseudo.collisions(pseudo.id_mapping(frame(spark, sf, "panel_src"), "matricule", TEST_KEY))


@register("h04_apply_ids", "SELECT p.row_id, h.pseudonyme FROM panel_src p LEFT JOIN hashed h ON h.original = p.matricule")
def _(spark, sf):
    d = frame(spark, sf, "panel_src")
    mapping = pseudo.id_mapping(d, "matricule", TEST_KEY)
    return pseudo.apply_ids(d, mapping, "matricule").select("row_id", "pseudonyme")


@register(
    "h04_missing_ids",
    """SELECT count(*) AS lignes, count(*) FILTER (WHERE matricule NOT IN (SELECT matricule FROM silver WHERE annee = 1995)) AS sans_pseudonyme FROM silver""",
)
def _(spark, sf):
    d = silver(spark, sf)
    return pseudo.missing_ids(d, pseudo.id_mapping(d.where("annee = 1995"), "matricule", TEST_KEY), "matricule")


# ------------------------------------------------------------------ estimators


def survey(spark, sf):
    """All rows with declared salaries (R = 1) and predictors; the months of all years are told apart."""

    def build():
        d = graded(spark, sf)
        birth, ref = clean_date("date_naissance"), month_end("mois_annee")
        return d.select(
            "row_id",
            "organisme",
            F.col("periode").alias("mois"),
            F.col("montant_brut").alias("salaire"),
            F.col("montant_brut").isNotNull().cast("int").alias("R"),
            F.coalesce(age_years(birth, ref), F.lit(40)).cast("double").alias("age"),
            F.col("SEXE_STD").alias("sexe"),
            F.col("emploi").alias("profession"),
            F.coalesce(tenure_years(clean_date("prise_service"), ref), F.lit(5.0)).alias("anciennete"),
            F.coalesce("CODE_ORGANISME", F.lit("NON_CODE")).alias("secteur"),
            (F.col("row_id") % 100 + 1).cast("double").alias("taille"),
        )

    return layer(spark, f"survey {sf}", build)


CATS, NUMS = ["sexe", "profession", "secteur"], ["age", "anciennete"]


@register("e01_ipw_weights")
def _(spark, sf):
    return est.ipw_weights(survey(spark, sf), "R", CATS, NUMS).select("row_id", "R", "pi_hat", "w_ipw")


@register("e02_pmm_impute")
def _(spark, sf):
    d = survey(spark, sf).withColumn("_log", F.log("salaire"))
    return est.pmm_impute(d, "_log", "row_id", CATS, NUMS)


@register("e03_pool_rubin")
def _(spark, sf):
    d = survey(spark, sf).withColumn("_log", F.log("salaire"))
    c = est.pmm_impute(d, "_log", "row_id", CATS, NUMS).withColumns({"valeur": F.exp("valeur"), "w": F.lit(1.0)})
    return est.pool_rubin(est.weighted_estimates(c, "w"))


@register("e01_individual_estimate")
def _(spark, sf):
    return est.individual_estimate(survey(spark, sf), "salaire", "R", "row_id", CATS, NUMS)


def employers(spark, sf):
    d = survey(spark, sf).withColumn("R", F.when(F.col("mois") % 100 % 4 == 0, 0).otherwise(F.col("R")))
    return est.employer_month_base(d, "organisme", "mois", "salaire", "R", "age", "sexe", "Femme", "taille", "secteur")


@register(
    "e04_employer_month_base",
    """WITH s AS (SELECT *, CASE WHEN periode % 100 % 4 = 0 OR montant_brut IS NULL THEN 0 ELSE 1 END AS rr,
  coalesce(year(collecte) - year(naissance) - CASE WHEN strftime(collecte, '%m%d') < strftime(naissance, '%m%d') THEN 1 ELSE 0 END, 40) AS ag
  FROM births)
SELECT organisme, periode AS mois, count(*) AS n_total, CAST(sum(rr) AS BIGINT) AS n_declares, round(avg(montant_brut) FILTER (WHERE rr = 1), 6) AS salaire_moyen_obs,
round(avg(ag), 6) AS age_moyen, round(avg(CASE WHEN SEXE_STD = 'Femme' THEN 1.0::DOUBLE ELSE 0 END), 6) AS part_femmes,
CAST(arg_min(row_id % 100 + 1, row_id) AS DOUBLE) AS taille, arg_min(coalesce(CODE_ORGANISME, 'NON_CODE'), row_id) AS secteur,
CAST(sum(rr) > 0 AS INTEGER) AS declare FROM s GROUP BY 1, 2""",
)
def _(spark, sf):
    return rounded(employers(spark, sf), 6, "salaire_moyen_obs", "age_moyen", "part_femmes")


@register("e05_employer_estimate")
def _(spark, sf):
    return est.employer_estimate(employers(spark, sf), "organisme", "mois")


@register("e06_two_stage_estimate")
def _(spark, sf):
    d = survey(spark, sf).withColumn("R", F.when(F.col("mois") % 100 % 4 == 0, 0).otherwise(F.col("R")))
    return est.two_stage_estimate(d, employers(spark, sf), "organisme", "mois", "salaire", "R", CATS, NUMS)


# ------------------------------------------------------------------ files and streams


def fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def raw_rows(spark, sf):
    """Sheet-like rows: one file per month, title lines, a header at varying depth, then data."""
    d = silver(spark, sf)
    depth = F.col("mois") % 3
    file = F.concat(F.col("mois_annee"), F.lit(".xlsx"))
    months = d.select("mois_annee", "mois").distinct()
    title = months.where("mois % 3 > 0").select(
        file.alias("fichier"), F.lit(0).alias("ligne"), F.array(F.lit("Etat"), F.lit(None), F.lit(None)).alias("cellules")
    )
    head = months.select(
        file.alias("fichier"), depth.cast("int").alias("ligne"), F.array(F.lit("Matricule"), F.lit("Emploi"), F.lit("Montant Brut")).alias("cellules")
    )
    body = d.select(
        file.alias("fichier"),
        (F.col("row_id") + 10).cast("int").alias("ligne"),
        F.array("matricule", "emploi", F.col("montant_brut").cast("string")).alias("cellules"),
    )
    return title.unionByName(head).unionByName(body)


@register(
    "s04_locate_header",
    "SELECT DISTINCT mois_annee || '.xlsx' AS fichier, CAST(mois % 3 AS INTEGER) AS entete FROM silver",
)
def _(spark, sf):
    return files.locate_header(raw_rows(spark, sf))


@register(
    "s05_score_header",
    """SELECT DISTINCT mois_annee || '.xlsx' AS fichier, CAST(mois % 3 AS INTEGER) AS entete, 0.85::DOUBLE AS score FROM silver""",
)
def _(spark, sf):
    return files.score_header(raw_rows(spark, sf), ["MATRICULE"], ["MONTANT BRUT", "SEXE"])


@register(
    "s06_apply_header",
    """SELECT mois_annee || '.xlsx' AS fichier, matricule AS "MATRICULE", emploi AS "EMPLOI", montant_brut AS "MONTANT_BRUT" FROM silver""",
)
def _(spark, sf):
    raw = written(raw_rows(spark, sf), "raw")
    d = files.apply_header(raw, files.locate_header(raw))
    return d.select("fichier", "MATRICULE", "EMPLOI", F.col("MONTANT_BRUT").cast("double").alias("MONTANT_BRUT"))


def monthly_files(spark, sf):
    """Bronze folder with one file per period, named after the period."""
    d = frame(spark, sf, "panel_src")
    path = fresh(spark, "bronze")
    d.withColumn("p", F.col("mois_annee")).repartition("p").write.partitionBy("p").parquet(path)
    # hand the files over under period names, as the extracts arrive
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hpath = spark._jvm.org.apache.hadoop.fs.Path
    target = hpath(fresh(spark, "landing"))
    fs = target.getFileSystem(conf)
    fs.mkdirs(target)
    for part in fs.listStatus(hpath(path)):
        name = part.getPath().getName()
        if name.startswith("p="):
            for f in fs.listStatus(part.getPath()):
                if f.getPath().getName().endswith(".parquet"):
                    fs.rename(f.getPath(), hpath(target, f"{name[2:]}.parquet"))
    return target.toString()


@register(
    "s01_read_bronze",
    """SELECT CAST(row_id AS VARCHAR) AS row_id, mois_annee, mois_annee || '.parquet' AS fichier_source FROM panel_src""",
)
def _(spark, sf):
    return files.read_bronze(spark, monthly_files(spark, sf)).select("row_id", "mois_annee", "fichier_source")


@register("s02_read_silver", "SELECT row_id, montant_brut FROM silver WHERE annee IN (1996, 1998)")
def _(spark, sf):
    path = fresh(spark, "silver")
    files.write_partitioned(silver(spark, sf), path)
    return files.read_silver(spark, path, [1996, 1998], ["row_id", "montant_brut"])


@register("s03_read_text_table", "SELECT CAST(row_id AS VARCHAR) AS row_id, matricule, emploi FROM silver")
def _(spark, sf):
    path = fresh(spark, "csv")
    silver(spark, sf).select("row_id", "matricule", "emploi").write.option("header", True).csv(path)
    return files.read_text_table(spark, path, "csv")


@register("s07_write_partitioned", "SELECT annee, count(*) AS n FROM silver GROUP BY 1")
def _(spark, sf):
    path = fresh(spark, "years")
    files.write_partitioned(silver(spark, sf), path)
    files.write_partitioned(silver(spark, sf).where("annee = 1997"), path)
    return spark.read.parquet(path).groupBy("annee").agg(F.count("*").alias("n"))


@register("s08_write_monthly_split", "SELECT periode, count(*) AS n FROM silver GROUP BY 1")
def _(spark, sf):
    path = fresh(spark, "months")
    files.write_monthly_split(silver(spark, sf), path)
    return spark.read.parquet(path).groupBy("periode").agg(F.count("*").alias("n"))


@register("s09_write_report_csv", "SELECT GRADE, CAST(count(*) AS VARCHAR) AS n FROM silver GROUP BY 1")
def _(spark, sf):
    path = fresh(spark, "report")
    files.write_report_csv(silver(spark, sf).groupBy("GRADE").agg(F.count("*").alias("n")), path)
    return spark.read.option("header", True).csv(path)


@register("s10_write_bounded_parts", "SELECT count(*) AS n, true AS bornes FROM silver")
def _(spark, sf):
    path = fresh(spark, "parts")
    files.write_bounded_parts(silver(spark, sf), path, 1000)
    per_file = spark.read.parquet(path).groupBy("_metadata.file_name").agg(F.count("*").alias("k"))
    return per_file.agg(F.sum("k").alias("n"), (F.max("k") <= 1000).alias("bornes"))


@register("s11_verify_load", "SELECT count(*) AS lignes, min(periode) AS premiere, max(periode) AS derniere FROM silver")
def _(spark, sf):
    return files.verify_load(spark, written(silver(spark, sf), "check").inputFiles()[0].rsplit("/", 1)[0])


@register(
    "s12_append_new_periods",
    """SELECT row_id, periode, montant_brut, CASE WHEN periode > 199706 THEN emploi END AS emploi FROM silver WHERE periode <= 199706 OR periode > 199706""",
)
def _(spark, sf):
    d = silver(spark, sf)
    base = d.where("periode <= 199706").select("row_id", "periode", "montant_brut")
    new = d.where("periode >= 199701").select("row_id", "periode", "montant_brut", "emploi")
    return files.append_new_periods(base, new)


@register("s12_publish_version", "SELECT row_id, periode, montant_brut FROM silver")
def _(spark, sf):
    d = silver(spark, sf).select("row_id", "periode", "montant_brut")
    base = fresh(spark, "versions")
    files.publish_version(d.where("periode <= 199706"), base)
    files.publish_version(files.append_new_periods(files.read_current(spark, base), d), base)
    return files.read_current(spark, base)


@register("s13_select_period_range", "SELECT row_id, periode FROM silver WHERE periode BETWEEN 199607 AND 199803")
def _(spark, sf):
    return files.select_period_range(silver(spark, sf), 199607, 199803).select("row_id", "periode")


@register(
    "s14_sample_rows",
    "SELECT row_id, periode FROM silver ORDER BY sha256(concat_ws('|', CAST(row_id AS VARCHAR), '1')) LIMIT 100",
)
def _(spark, sf):
    return files.sample(silver(spark, sf), ["row_id"], 100).select("row_id", "periode")


@register(
    "m01_ingest_new_files",
    "SELECT row_id, periode FROM panel_src",
)
def _(spark, sf):
    folder = monthly_files(spark, sf)
    schema = frame(spark, sf, "panel_src").drop("mois_annee", "periode").schema
    bronze, mark = fresh(spark, "bronze"), fresh(spark, "mark")
    ingest.ingest_new_files(spark, folder, schema, bronze, mark)
    ingest.ingest_new_files(spark, folder, schema, bronze, mark)  # nothing new: nothing added
    return spark.read.parquet(bronze).select("row_id", "periode")


@register(
    "m02_running_effectifs",
    """SELECT periode, organisme, count(*) AS nb_lignes, count(DISTINCT matricule) AS nb_agents,
count(*) FILTER (WHERE SEXE_STD = 'Homme') AS nb_hommes, count(*) FILTER (WHERE SEXE_STD = 'Femme') AS nb_femmes
FROM graded GROUP BY 1, 2""",
)
def _(spark, sf):
    schema = frame(spark, sf, "panel_src").drop("mois_annee", "periode").schema
    target, mark = fresh(spark, "effectifs"), fresh(spark, "mark")
    ingest.running_effectifs(spark, monthly_files(spark, sf), schema, target, mark)
    return spark.read.parquet(target)


