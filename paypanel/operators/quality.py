"""Quality controls on layers and code tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paypanel.functions.dates import first_of_month, period_index
from paypanel.functions.text import filled
from paypanel.operators.aggregates import count_rows, with_shares
from paypanel.operators.joins import upper_median_rows
from paypanel.operators.silver import exactly_one_filled
from paypanel.operators.skew import join_back


def _pct(part: Column, total: Column, digits: int = 1) -> Column:
    return F.round(part * 100.0 / F.nullif(total, F.lit(0)), digits)


def match_rates(df: DataFrame, codes: list[str], by: str = "periode") -> DataFrame:
    """Share of coded rows per period and code column."""
    n = F.count("*")
    return df.groupBy(by).agg(*[_pct(F.count(c), n).alias(c) for c in codes])


def match_rate_range(df: DataFrame, codes: list[str], by: str = "periode") -> DataFrame:
    """Smallest, largest and mean rate of each code over the periods."""
    long = match_rates(df, codes, by).unpivot([by], codes, "code", "taux")
    return long.groupBy("code").agg(
        F.min("taux").alias("minimum"), F.max("taux").alias("maximum"), F.avg("taux").alias("moyenne")
    )


def completeness(df: DataFrame, cols: list[str], warn_below: float = 95.0) -> DataFrame:
    """Filled share of key columns."""
    counts = df.agg(count_rows("total"), *[F.count(c).alias(c) for c in cols])
    return counts.unpivot(["total"], cols, "colonne", "non_nuls").select(
        "colonne",
        "non_nuls",
        "total",
        _pct(F.col("non_nuls"), F.col("total")).alias("pct"),
        (_pct(F.col("non_nuls"), F.col("total")) < warn_below).alias("alerte"),
    )


def null_rates(df: DataFrame, cols: list[str], by: str = "annee") -> DataFrame:
    """NULL share by year and column, long form."""
    n = F.count("*")
    wide = df.groupBy(by).agg(*[_pct(F.count_if(F.col(c).isNull()), n).alias(c) for c in cols])
    return wide.unpivot([by], cols, "colonne", "pct_na")


def suspicious_columns(df: DataFrame, cols: list[str], high: float = 95, low: float = 5) -> DataFrame:
    """Columns almost empty in one year and almost full in another."""
    rates = null_rates(df, cols).groupBy("colonne").agg(F.min("pct_na").alias("mini"), F.max("pct_na").alias("maxi"))
    return rates.where((F.col("maxi") > high) & (F.col("mini") < low))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(count_rows("n")).where(F.col("n") > 1)


def duplicate_flag(df: DataFrame, keys: list[str], out: str = "FLAG_DOUBLON_STRICT") -> DataFrame:
    """1 on every row of a repeated key; counted by aggregation, so no key is buffered whole."""
    counted = join_back(df, df.groupBy(*keys).agg(count_rows("_n")), keys)
    return counted.withColumn(out, (F.col("_n") > 1).cast("int")).drop("_n")


def net_above_brut(df: DataFrame) -> DataFrame:
    bad = F.count_if(F.col("montant_net") > F.col("montant_brut"))
    return df.agg(bad.alias("n"), count_rows("total"), _pct(bad, F.count("*"), 2).alias("pct"))


def situation_distribution(df: DataFrame) -> DataFrame:
    return with_shares(df.groupBy("situation_normalisee").agg(count_rows("nb")), "nb", "pct")


def not_exactly_one(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose filled cells among ``cols`` are none or several."""
    return df.where(~exactly_one_filled(cols))


def exclusivity(df: DataFrame, groups: dict[str, list[str]], by: str = "annee") -> DataFrame:
    """Rows with several filled columns of one base, per base and year."""
    types = dict(df.dtypes)

    def several(cols: list[str]) -> Column:
        total = F.lit(0)
        for c in cols:
            numeric = types[c] in ("double", "int", "bigint", "float")
            total = total + F.coalesce(filled(F.col(f"`{c}`"), numeric=numeric), F.lit(False)).cast("int")
        return F.count_if(total > 1)

    wide = df.groupBy(by).agg(count_rows("lignes"), *[several(c).alias(b) for b, c in groups.items()])
    return wide.unpivot([by, "lignes"], list(groups), "base", "violations")


def sum_mismatch(
    df: DataFrame, parts: list[str], reference: str, abs_tol: float = 1e-6, rel_tol: float = 0.0
) -> DataFrame:
    """Rows whose component sum departs from the reference beyond both tolerances."""
    total = F.lit(0.0)
    any_part = F.lit(False)
    for p in parts:
        total = total + F.coalesce(F.col(f"`{p}`"), F.lit(0.0))
        any_part = any_part | F.col(f"`{p}`").isNotNull()
    out = df.withColumns({"sum_all": F.when(any_part, total), "reference": F.col(reference)})
    out = out.withColumn("abs_diff", F.abs(F.col("sum_all") - F.col("reference")))
    out = out.withColumn("rel_diff", F.col("abs_diff") / F.nullif(F.col("reference"), F.lit(0.0)))
    far = F.coalesce(F.col("rel_diff") > rel_tol, F.lit(True))
    return out.where((F.col("abs_diff") > abs_tol) & far)


def ambiguous_codes(ref: DataFrame, code: str, label: str) -> DataFrame:
    """Codes pointing to several labels."""
    return ref.groupBy(code).agg(F.count_distinct(label).alias("n_libelles")).where(F.col("n_libelles") > 1)


def normalized_duplicates(ref: DataFrame, norm: str, label: str, code: str) -> DataFrame:
    """Distinct reference rows whose normalised label occurs several times."""
    rows = ref.select(norm, label, code).distinct()
    again = rows.groupBy(norm).agg(count_rows("_n")).where(F.col("_n") > 1).select(norm)
    return rows.join(again, norm, "left_semi")


def layer_trace(layers: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Rows and NULL keys per layer and month."""
    parts = None
    for name, df in layers.items():
        part = df.select(F.lit(name).alias("couche"), "periode", *keys)
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("couche", "periode").agg(
        count_rows("lignes"), *[F.count_if(F.col(k).isNull()).alias(f"{k}_nuls") for k in keys]
    )


def kept_share(df: DataFrame, kept: Column, witness: int | None = None) -> DataFrame:
    """Rows, kept rows and kept share per month, with the gap to a witness month."""
    share = df.groupBy("periode").agg(
        count_rows("lignes"), F.count_if(kept).alias("gardees"), _pct(F.count_if(kept), F.count("*"), 2).alias("pct")
    )
    if witness is None:
        return share
    ref = share.where(F.col("periode") == witness).select("pct").scalar()
    return share.withColumn("ecart_temoin", F.round(F.col("pct") - ref, 2))


def inconstant(df: DataFrame, key: str, value: str) -> DataFrame:
    """Persons with several distinct values of a variable."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n_valeurs")).where(F.col("n_valeurs") > 1)


def conflicting_statuses(df: DataFrame, keys: list[str], status: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(status).alias("nb_statuts")).where(F.col("nb_statuts") > 1)


def period_vs_date(df: DataFrame, date: str, period: str = "periode") -> DataFrame:
    """Same month or not, and the gap in months and in days from the first of the period."""
    d, p = F.col(date), F.col(period)
    date_index = F.year(d) * 12 + F.month(d)
    start = first_of_month(F.floor(p / 100).cast("int"), p % 100)
    return df.withColumns(
        {
            "meme_mois": F.coalesce(date_index == period_index(p), F.lit(False)),
            "ecart_mois": date_index - period_index(p),
            "ecart_jours": F.datediff(d, start),
        }
    )


def headcount_anomaly(df: DataFrame, share: float = 0.2) -> DataFrame:
    """Grade-month headcounts below a share of the grade's upper median over its months in the year."""
    cells = df.where(F.col("GRADE").isNotNull()).groupBy("annee", "mois", "GRADE").agg(count_rows("effectif"))
    mid = upper_median_rows(cells, ["annee", "GRADE"], ["effectif", "mois"]).select(
        "annee", "GRADE", F.col("effectif").alias("mediane")
    )
    joined = cells.join(mid, ["annee", "GRADE"])
    return joined.withColumn("anomalie", F.col("effectif") < F.col("mediane") * share)


def headcount_totals(df: DataFrame) -> DataFrame:
    """Headcounts by month and grade of each year with row and column totals."""
    cube = df.where(F.col("GRADE").isNotNull()).groupBy("annee", "mois", "GRADE").agg(count_rows("_n"))
    cells = cube.select(
        "annee",
        F.explode(F.array(F.col("mois").cast("string"), F.lit("TOTAL"))).alias("mois"),
        "GRADE",
        "_n",
    ).select("annee", "mois", F.explode(F.array("GRADE", F.lit("TOTAL"))).alias("GRADE"), "_n")
    return cells.groupBy("annee", "mois", "GRADE").agg(F.sum("_n").alias("effectif"))


def service_anomaly_type(birth: str, start: str, age_service: str, age: str) -> Column:
    """Kind of start-of-service anomaly; when several rules match the last one names it."""
    return (
        F.when(F.col(age_service) > 40, "Âge à la prise de service > 40 ans")
        .when(F.col(age_service) > F.col(age), "Âge à la prise de service > âge imputé")
        .when(F.col(age_service) < 18, "Âge à la prise de service < 18 ans")
        .when(F.col(start) <= F.col(birth), "Prise de service avant ou pendant la naissance")
    )


def imputation_exposure(df: DataFrame, key: str, imputed: Column, group: list[str]) -> DataFrame:
    """Share of imputed rows and number of imputation groups met, per person."""
    whole = F.when(F.col(group[-1]).isNotNull(), F.struct(*group))
    return df.groupBy(key).agg(
        F.avg(imputed.cast("double")).alias("part_imputee"), F.count_distinct(whole).alias("nb_groupes")
    )
