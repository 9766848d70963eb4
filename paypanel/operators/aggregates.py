"""Salary mass, headcount and indicator tables.

Every grouping goes through map-side combined aggregates and ``group_stats`` for the exact
quantiles, so a group holding a large share of the rows never sits in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.functions.dates import period_label
from paypanel.functions.grades import citp_group_any, grade_letter_category, grade_order
from paypanel.functions.people import std_sex
from paypanel.operators.joins import first_rows
from paypanel.operators.quantiles import Quantile, group_stats, median, nearest, whole
from paypanel.operators.skew import join_back




def count_rows(name: str) -> Column:
    return F.count("*").alias(name)


def sum0(c: str | Column) -> Column:
    """Sum that is 0, not NULL, without values."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def with_shares(df: DataFrame, n: str, out: str, digits: int = 2) -> DataFrame:
    """Percentage of the column total; the total is a scalar subquery, not a one-task window."""
    total = df.agg(F.sum(n)).scalar()
    return df.withColumn(out, F.round(F.col(n) * 100.0 / total, digits))


# ---------------------------------------------------------------- gold marts


def masse_salariale(df: DataFrame) -> DataFrame:
    """Lines, agents, sums, means and nearest medians by month, organisation and situation."""
    d = df.withColumns(
        {
            "code_organisme": F.coalesce("CODE_ORGANISME", F.lit("NON_CODE")),
            "organisme": F.coalesce("organisme", F.lit("NON_IDENTIFIE")),
        }
    )
    keys = ["mois_annee", "annee", "mois", "code_organisme", "organisme", "situation_normalisee"]
    mid = {
        "salaire_brut_mediane": nearest("montant_brut", 0.5),
        "salaire_net_mediane": nearest("montant_net", 0.5),
    }
    aggs = [
        count_rows("nb_lignes"),
        F.count_distinct("matricule").alias("nb_agents_uniques"),
        whole(sum0("montant_brut")).alias("masse_brute"),
        whole(sum0("montant_net")).alias("masse_nette"),
        whole(F.avg("montant_brut")).alias("salaire_brut_moyen"),
        whole(F.avg("montant_net")).alias("salaire_net_moyen"),
    ]
    out = group_stats(d, keys, aggs, mid)
    return out.withColumns({c: whole(F.col(c)) for c in mid})


def effectifs(df: DataFrame) -> DataFrame:
    """Lines, agents, men and women by month, situation and organisation."""
    d = df.withColumns(
        {"code_organisme": F.coalesce("CODE_ORGANISME", F.lit("NON_CODE")), "_sexe": std_sex("sexe")}
    )
    return d.groupBy("mois_annee", "annee", "mois", "situation_normalisee", "code_organisme").agg(
        count_rows("nb_lignes"),
        F.count_distinct("matricule").alias("nb_agents_uniques"),
        F.count_if(F.col("_sexe") == "Homme").alias("nb_hommes"),
        F.count_if(F.col("_sexe") == "Femme").alias("nb_femmes"),
    )


# ---------------------------------------------------------------- indicators


def compute_indicators(df: DataFrame, keys: list[str], value: str = "REVENU_TOTAL", linear: bool = False) -> DataFrame:
    """Count, mean, median, min, max and quartiles (nearest rank, or interpolated)."""
    q = {
        "Revenu_median": median(value),
        "Revenu_p25": Quantile(value, 0.25, not linear),
        "Revenu_p75": Quantile(value, 0.75, not linear),
    }
    aggs = [
        count_rows("Effectif"),
        whole(F.avg(value)).alias("Revenu_moyen"),
        whole(F.min(value)).alias("Revenu_min"),
        whole(F.max(value)).alias("Revenu_max"),
    ]
    return group_stats(df, keys, aggs, q).withColumns({c: whole(F.col(c)) for c in q})


# Indicator tables and the columns that define their groups.
INDICATOR_KEYS = {
    "grade": ["GRADE_PRINCIPAL"],
    "grade_sexe": ["SEXE_STD", "GRADE_PRINCIPAL"],
    "citp": ["Code_CITP", "Metier_CITP"],
    "bareme": ["bareme"],
    "bareme_grade": ["bareme", "GRADE_PRINCIPAL"],
    "bareme_sexe": ["bareme", "SEXE_STD"],
}


def indicator_table(revenue: DataFrame, name: str, value: str = "REVENU_TOTAL") -> DataFrame:
    """One of the monthly indicator tables of ``INDICATOR_KEYS``."""
    keys = INDICATOR_KEYS[name]
    if name == "citp":
        revenue = revenue.where(F.col("Code_CITP") != "Non renseigné")
    if keys[0] == "bareme":
        revenue = revenue.where(F.col("bareme").isNotNull())
    return compute_indicators(revenue, ["annee", "mois", *keys], value)


def count_posts(df: DataFrame, keys: list[str], out: str = "NB_POSTES", distinct: str | None = None) -> DataFrame:
    """Rows with the number of posts of their (month, person): lines, or distinct employer keys."""
    n = F.count_distinct(distinct) if distinct else F.count("*")
    return join_back(df, df.groupBy(*keys).agg(n.alias(out)), keys)


def aggregate_revenue(
    df: DataFrame, key: str = "matricule", value: str = "SALAIRE_BRUT", include_zero: bool = False
) -> DataFrame:
    """Income per person (or post) and month with the attributes of its principal row.

    The principal row has the highest grade; ties go to the smallest post key, then row.
    """
    attributes = ["GRADE", "GRADE_SOURCE", "SEXE_STD", "Code_CITP", "Metier_CITP", "bareme", "bareme_detail"]
    present = [c for c in attributes if c in df.columns]
    rank = F.struct(-grade_order("GRADE"), F.col("cle_unique"), F.col("row_id"))
    names = {"GRADE": "GRADE_PRINCIPAL", "GRADE_SOURCE": "GRADE_SOURCE_PRINCIPAL"}
    out = (
        df.groupBy("annee", "mois", key)
        .agg(
            sum0(value).alias("REVENU_TOTAL"),
            F.max("NB_POSTES").alias("NB_POSTES"),
            F.min_by(F.struct(*present), rank).alias("_p"),
        )
        .select(
            "annee", "mois", key, "REVENU_TOTAL", "NB_POSTES",
            *[F.col(f"_p.{c}").alias(names.get(c, c)) for c in present],
        )
    )
    return out if include_zero else out.where(F.col("REVENU_TOTAL") > 0)


def posts_bucket(c: str, top: int = 5) -> Column:
    return F.when(F.col(c) >= top, F.lit(f"{top}+")).otherwise(F.col(c).cast("string"))


def multi_posts_table(revenue: DataFrame, top: int = 5) -> DataFrame:
    """Headcount by month, grade and number of posts, one column per number."""
    labels = [str(i) for i in range(1, top)] + [f"{top}+"]
    return (
        revenue.withColumn("_b", posts_bucket("NB_POSTES", top))
        .groupBy("annee", "mois", "GRADE_PRINCIPAL")
        .pivot("_b", labels)
        .agg(F.count(F.lit(1)))
        .fillna(0, labels)
    )


def multi_posts_means(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("annee", "mois", "GRADE_PRINCIPAL", "NB_POSTES").agg(
        count_rows("Effectif"), whole(F.avg("REVENU_TOTAL")).alias("Revenu_moyen")
    )


def posts_distribution(revenue: DataFrame) -> DataFrame:
    counts = revenue.groupBy("NB_POSTES").agg(
        count_rows("Effectif"), whole(F.avg("REVENU_TOTAL")).alias("Revenu_moyen")
    )
    return with_shares(counts, "Effectif", "Pct")


def pivot_indicator(df: DataFrame, keys: list[str], on: str, values: list[str], value: str, stat: str) -> DataFrame:
    """One row per period and one column per fixed value of ``on``; all-empty rows are dropped."""
    stats = {
        "effectif": (F.count("*").cast("double").alias("_x"), {}),
        "moyen": (whole(F.avg(value)).alias("_x"), {}),
        "median": (F.count("*").alias("_n"), {"_x": median(value)}),
        "se": (robust_expr("se", value).alias("_x"), {}),
        "sd": (robust_expr("sd", value).alias("_x"), {}),
        "cv": (robust_expr("cv", value).alias("_x"), {}),
    }
    agg, q = stats[stat]
    cells = group_stats(df.where(F.col(on).isin(*values)), [*keys, on], [agg], q)
    if stat == "median":
        cells = cells.withColumn("_x", whole(F.col("_x")))
    wide = cells.groupBy(*keys).pivot(on, values).agg(F.first("_x"))
    return wide.dropna(how="all", subset=values)


# Display rows of the sector pay table; NULL marks a heading.
SECTOR_ROWS = [
    ("TOUS SECTEURS CONFONDUS", "_GLOBAL_"),
    ("SECTEUR EDUCATION", None),
    ("Primaire", "ENS SEC & PRIM_PRIM"),
    ("Secondaire", "ENS SEC & PRIM_SEC"),
    ("Supérieur", "ENS SUP"),
    ("SECTEUR SANTE", None),
    ("Cadres supérieurs", "Cadre-Sup-Santé Generaliste & Specialiste"),
    ("Personnels Techniques", "Tech-Santé"),
    ("AUTRES SECTEURS", None),
    ("Para-militaire / Douanes / Eaux & Forêts", "police"),
    ("Barème Général", "Barême Général"),
    ("PERSONNELS SOUS STATUT PARTICULIER", None),
    ("Magistrat", "MAGISTRAT "),
    ("Corps préfectoral", "CORPS PREF"),
    ("Corps diplomatique", "CORPS DIPL"),
    ("Greffier", "GREFFE"),
]


def sector_pay_model(df: DataFrame, year: int, value: str = "SALAIRE_BRUT", rows=SECTOR_ROWS) -> DataFrame:
    """Min, mean, max and median of one year, overall and by detailed scale, in display order."""
    spark = df.sparkSession
    d = df.where((F.col("annee") == year) & F.col("bareme_detail").isNotNull() & (F.col(value) > 0))
    both = d.select(value, F.explode(F.array("bareme_detail", F.lit("_GLOBAL_"))).alias("bareme_detail"))
    stats = group_stats(
        both,
        ["bareme_detail"],
        [
            whole(F.min(value)).alias("salaire_brut_min"),
            whole(F.avg(value)).alias("salaire_brut_moyen"),
            whole(F.max(value)).alias("salaire_brut_max"),
            count_rows("nb_obs"),
        ],
        {"salaire_brut_mediane": median(value)},
    ).withColumn("salaire_brut_mediane", whole(F.col("salaire_brut_mediane")))
    layout = spark.createDataFrame(
        [(i, label, key) for i, (label, key) in enumerate(rows, 1)], "ordre int, libelle string, bareme_detail string"
    )
    return layout.join(stats, "bareme_detail", "left")


# ---------------------------------------------------------------- robust statistics


def _finite(value: str) -> Column:
    c = F.col(value)
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def robust_expr(stat: str, value: str) -> Column:
    """sd, se or cv over finite values; NULL for fewer than two values or a zero mean."""
    x = _finite(value)
    n, sd = F.count(x), F.stddev_samp(x)
    many = n > 1
    if stat == "sd":
        return F.when(many, sd)
    if stat == "se":
        return F.when(many, sd / F.sqrt(n))
    return F.when(many & (F.avg(x) != 0), sd / F.avg(x))


def robust_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    d = df.withColumn("_x", _finite(value))
    aggs = [
        count_rows("Effectif"),
        F.avg("_x").alias("moyenne"),
        *[robust_expr(s, "_x").alias(s) for s in ("sd", "se", "cv")],
        F.min("_x").alias("minimum"),
        F.max("_x").alias("maximum"),
    ]
    return group_stats(d, keys, aggs, {"mediane": median("_x")})


def group_panels(df: DataFrame, keys: list[str], categories: list[str], brut: str, net: str) -> DataFrame:
    """Indicators of overlapping groups (categories, status, all, sex) side by side.

    Each row is repeated once per group it belongs to (at most three), then aggregated once.
    """
    official = F.col("STATUT") == "Fonctionnaire"
    member = F.array_compact(
        F.array(
            F.lit("Ensemble"),
            F.when(official & F.col("CATEGORIE").isin(*categories), F.concat(F.lit("Cat "), F.col("CATEGORIE"))),
            F.when(~official, F.lit("Non fonctionnaire")),
            F.when(F.col("SEXE_STD").isin("Homme", "Femme"), F.col("SEXE_STD")),
        )
    )
    long = df.select(*keys, brut, net, F.explode(member).alias("groupe"))
    return group_stats(
        long,
        [*keys, "groupe"],
        [
            count_rows("effectif"),
            F.avg(net).alias("net_moyen"),
            F.avg(brut).alias("brut_moyen"),
            F.min(net).alias("net_min"),
            F.max(net).alias("net_max"),
        ],
        {"net_median": median(net), "brut_median": median(brut)},
    )


def group_panels_wide(panels: DataFrame, keys: list[str], categories: list[str], stat: str) -> DataFrame:
    groups = [f"Cat {c}" for c in categories] + ["Non fonctionnaire", "Ensemble", "Homme", "Femme"]
    return panels.groupBy(*keys).pivot("groupe", groups).agg(F.first(stat))


# ---------------------------------------------------------------- summaries


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Counts and percentages of a column, NULL included."""
    return with_shares(df.groupBy(F.col(col).alias("valeur")).agg(count_rows("effectif")), "effectif", "pct")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of a × b with margins, in long form; margins carry 'Total'."""
    cube = df.cube(a, b).agg(count_rows("effectif"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    label_a = F.when(F.col("_ga") == 1, "Total").otherwise(F.coalesce(F.col(a).cast("string"), F.lit("(vide)")))
    label_b = F.when(F.col("_gb") == 1, "Total").otherwise(F.coalesce(F.col(b).cast("string"), F.lit("(vide)")))
    return cube.select(label_a.alias(a), label_b.alias(b), "effectif")


def crosstab_wide(cells: DataFrame, a: str, b: str, values: list[str]) -> DataFrame:
    return cells.groupBy(a).pivot(b, [*values, "Total"]).agg(F.first("effectif")).fillna(0)


def weighted_rollup(table: DataFrame, key: str, n: str = "Effectif", mean: str = "Revenu_moyen") -> DataFrame:
    """Total headcount and headcount-weighted mean, 0 when empty."""
    total = F.sum(n)
    weighted = F.sum(F.col(n) * F.col(mean)) / total
    return table.groupBy(key).agg(
        total.alias("effectif_total"),
        F.bround(F.when(total > 0, weighted).otherwise(F.lit(0.0)), 0).alias("revenu_moyen_pondere"),
    )


def citp_summary(table: DataFrame) -> DataFrame:
    """Headcount and distinct jobs of the groups 1 to 9, zero-filled."""
    spark = table.sparkSession
    groups = spark.range(1, 10).select(F.col("id").cast("int").alias("grand_groupe"))
    sums = (
        table.withColumn("grand_groupe", citp_group_any("Code_CITP"))
        .groupBy("grand_groupe")
        .agg(F.sum("Effectif").alias("effectif_total"), F.count_distinct("Code_CITP").alias("nb_metiers"))
    )
    return groups.join(sums, "grand_groupe", "left").fillna(0, ["effectif_total", "nb_metiers"])


def multi_share(revenue: DataFrame) -> DataFrame:
    """Single-post and multi-post headcounts per grade."""
    return revenue.groupBy("GRADE_PRINCIPAL").agg(
        F.count_if(F.col("NB_POSTES") == 1).alias("mono_postes"),
        F.count_if(F.col("NB_POSTES") >= 2).alias("multi_postes"),
    ).withColumn("categorie", grade_letter_category("GRADE_PRINCIPAL"))


def kpis(df: DataFrame, first_year: int, last_year: int, value: str = "montant_brut") -> DataFrame:
    """Mass, mean, median, lines and agents of a year range, and the change from the range before."""
    now = F.col("annee").between(first_year, last_year)
    before = F.col("annee").between(first_year - 1, last_year - 1)
    paid = df.where((now | before) & (F.col(value) > 0))
    d = paid.withColumns(
        {
            "_now": F.when(now, F.col(value)),
            "_before": F.when(before, F.col(value)),
            "_agent": F.when(now, F.col("matricule")),
        }
    )
    out = group_stats(
        d,
        [],
        [
            whole(sum0("_now")).alias("masse"),
            whole(F.avg("_now")).alias("moyen"),
            F.count("_now").alias("n_lignes"),
            F.count_distinct("_agent").alias("n_agents"),
            F.sum("_before").alias("_m0"),
            F.avg("_before").alias("_a0"),
            F.sum("_now").alias("_m1"),
            F.avg("_now").alias("_a1"),
        ],
        {"median": median("_now")},
    )

    def change(a: str, b: str) -> Column:
        return F.round((F.col(a) - F.col(b)) / F.abs(F.nullif(F.col(b), F.lit(0.0))) * 100, 1)

    return out.withColumns(
        {"median": whole(F.col("median")), "delta_masse_pct": change("_m1", "_m0"), "delta_moyen_pct": change("_a1", "_a0")}
    ).drop("_m0", "_a0", "_m1", "_a1")


def dashboard_agg(df: DataFrame, extra: list[str], monthly: bool = True, value: str = "montant_brut") -> DataFrame:
    """Headcount, mass, mean and interpolated quartiles of paid rows, by month or year."""
    keys = (["annee", "mois"] if monthly else ["annee"]) + extra
    q = {"median": median(value), "p25": Quantile(value, 0.25), "p75": Quantile(value, 0.75)}
    aggs = [
        count_rows("effectif"),
        whole(F.sum(value)).alias("masse"),
        whole(F.avg(value)).alias("moyen"),
    ]
    if monthly:
        aggs.append(F.count_distinct("matricule").alias("agents"))
    out = group_stats(df.where(F.col(value) > 0), keys, aggs, q).withColumns({c: whole(F.col(c)) for c in q})
    return out.withColumn("periode", period_label("annee", "mois")) if monthly else out


def top_values(df: DataFrame, col: str, n: int, value: str = "montant_brut") -> DataFrame:
    """The n most frequent values among paid rows; ties by value."""
    counts = df.where((F.col(value) > 0) & F.col(col).isNotNull()).groupBy(col).agg(count_rows("n"))
    return counts.orderBy(F.desc("n"), col).limit(n)


def heatmap(df: DataFrame, by: str, years: list[int], n: int = 15, value: str = "montant_brut") -> DataFrame:
    """Mean pay by category and year for the top categories (at most n rows, so broadcast)."""
    top = F.broadcast(top_values(df, by, n, value).select(by))
    kept = df.where((F.col(value) > 0) & F.col("annee").isin(*years)).join(top, by, "left_semi")
    return kept.groupBy(by).pivot("annee", years).agg(whole(F.avg(value)))


def box_stats(df: DataFrame, by: str, year: int, n: int = 15, value: str = "montant_brut") -> DataFrame:
    """Five-number summary of the top categories of a year."""
    d = df.where((F.col("annee") == year) & (F.col(value) > 0))
    d = d.join(F.broadcast(top_values(d, by, n, value).select(by)), by, "left_semi")
    q = {"q1": Quantile(value, 0.25), "median": median(value), "q3": Quantile(value, 0.75)}
    return group_stats(
        d, [by], [count_rows("n"), F.min(value).alias("minimum"), F.max(value).alias("maximum")], q
    )


def histogram(df: DataFrame, value: str, by: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the whole range, counted by group."""
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    number = F.least(F.floor((F.col(value) - lo) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    return (
        df.where(F.col(value).isNotNull())
        .withColumn("classe", F.coalesce(number, F.lit(0)).cast("int"))
        .groupBy(by, "classe")
        .agg(count_rows("effectif"))
    )


def headcount_compare(df: DataFrame, year_a: int, year_b: int) -> DataFrame:
    """Grade × month headcounts of two years and their difference."""
    d = df.where(F.col("GRADE").isNotNull() & F.col("annee").isin(year_a, year_b))
    return (
        d.groupBy("mois", "GRADE")
        .agg(
            F.count_if(F.col("annee") == year_a).alias("effectif_a"),
            F.count_if(F.col("annee") == year_b).alias("effectif_b"),
        )
        .withColumn("delta", F.col("effectif_b") - F.col("effectif_a"))
    )


def evolution(df: DataFrame, by: list[str] | None = None, value: str = "montant_brut") -> DataFrame:
    """Monthly mean, median, quartiles and headcount of paid rows."""
    q = {"median": median(value), "p25": Quantile(value, 0.25), "p75": Quantile(value, 0.75)}
    d = df.where(F.col(value) > 0).withColumn("date_mois", F.make_date("annee", "mois", F.lit(1)))
    aggs = [F.avg(value).alias("moyenne"), count_rows("effectif")]
    return group_stats(d, ["date_mois", *(by or [])], aggs, q)


def numeric_profile(df: DataFrame, value: str) -> DataFrame:
    """One row: counts, sign counts and describe statistics."""
    c = F.col(value)
    aggs = [
        count_rows("total"),
        F.count(value).alias("non_nuls"),
        F.count_if(c.isNull()).alias("manquants"),
        F.count_if(c < 0).alias("negatifs"),
        F.count_if(c == 0).alias("zeros"),
        F.count_if(c > 0).alias("positifs"),
        F.avg(value).alias("moyenne"),
        F.stddev_samp(value).alias("ecart_type"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
    ]
    q = {"mediane": median(value), "p25": Quantile(value, 0.25), "p75": Quantile(value, 0.75)}
    return group_stats(df, [], aggs, q)


def column_profile(df: DataFrame, cols: list[str], samples: int = 5) -> DataFrame:
    """Per column: type, filled, empty and distinct counts, smallest sample values, date-likeness."""
    types = F.create_map(*[F.lit(x) for c, t in df.dtypes if c in cols for x in (c, t)])
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "colonne", "valeur")
    values = long.groupBy("colonne", "valeur").agg(F.count("*").alias("_n"))
    first = first_rows_n(values.where(F.col("valeur").isNotNull()), ["colonne"], ["valeur"], samples)
    sample = first.groupBy("colonne").agg(
        F.concat_ws(" | ", F.sort_array(F.collect_list("valeur"))).alias("exemples"),
        F.max(F.try_to_date("valeur", "yyyy-MM-dd").isNotNull()).alias("date_probable"),
    )
    stats = values.groupBy("colonne").agg(
        F.coalesce(F.sum(F.when(F.col("valeur").isNotNull(), F.col("_n"))), F.lit(0)).alias("non_nuls"),
        F.coalesce(F.sum(F.when(F.col("valeur").isNull(), F.col("_n"))), F.lit(0)).alias("nuls"),
        F.count("valeur").alias("distincts"),
    )
    return stats.join(sample, "colonne", "left").withColumn("type", types[F.col("colonne")])


def first_rows_n(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """First n rows of each key; the limit also runs before the shuffle."""
    if n == 1:
        return first_rows(df, keys, order)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def duplicate_profile(df: DataFrame, key: str) -> DataFrame:
    """How many ids occur once, twice..."""
    return (
        df.groupBy(key).agg(count_rows("occurrences")).groupBy("occurrences").agg(count_rows("nb_identifiants"))
    )


def id_structure(df: DataFrame, key: str) -> DataFrame:
    """Distinct ids by length and first character."""
    s = F.trim(F.col(key))
    return (
        df.select(s.alias("_id"))
        .distinct()
        .groupBy(F.length("_id").alias("longueur"), F.substring("_id", 1, 1).alias("premier"))
        .agg(count_rows("nb_identifiants"))
    )


def grade_summary(df: DataFrame, value: str = "montant_brut") -> DataFrame:
    """Lines, persons, posts and pay statistics per grade among paid rows."""
    return group_stats(
        df.where(F.col(value) > 0),
        ["GRADE"],
        [
            count_rows("nb_lignes"),
            F.count_distinct("matricule").alias("nb_personnes"),
            F.count_distinct("cle_unique").alias("nb_postes"),
            whole(F.avg(value)).alias("moyenne"),
            F.min(value).alias("minimum"),
            F.max(value).alias("maximum"),
        ],
        {"mediane": median(value)},
    )


def year_end_growth(df: DataFrame, keys: list[str], tenure: str) -> DataFrame:
    """Largest tenure of each year per key and its change from the key's year before."""
    ends = df.groupBy(*keys, "annee").agg(F.max(tenure).alias("fin_annee"))
    w = Window.partitionBy(*keys).orderBy("annee")
    return ends.withColumn("delta", F.col("fin_annee") - F.lag("fin_annee").over(w))


def growth_verdict(growth: DataFrame) -> DataFrame:
    """One row: any fall, else all rising, else constant; a mixed panel counts as falling."""
    d = F.col("delta")
    any_fall = F.coalesce(F.max(d < 0), F.lit(False))
    all_rise = F.coalesce(F.min(d > 0), F.lit(True))
    constant = F.coalesce(F.min(d == 0), F.lit(True))
    return growth.agg(
        F.when(any_fall, "decroit").when(all_rise, "evolue").when(constant, "constant").otherwise("decroit").alias(
            "verdict"
        )
    )


def situation_summary(df: DataFrame, col: str = "situation", value: str = "montant_brut") -> DataFrame:
    counts = df.groupBy(col).agg(count_rows("effectif"), F.round(F.avg(value), 2).alias("salaire_moyen"))
    return with_shares(counts, "effectif", "pct")
