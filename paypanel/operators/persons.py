"""Person variables: sex, age, age at start of service, final status.

Per-person values are map-side combined aggregates joined back to the rows; nothing collects a
person's rows into one place. Each step reads its input several times, so the longer chains
write their intermediate results instead of replanning everything before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paypanel.functions.dates import age_years, clean_date, month_end, years_between
from paypanel.functions.people import sex_letter
from paypanel.operators.imputation import group_median_fill, group_mode_fill, latest_value, modal_value
from paypanel.operators.quantiles import group_quantiles, median
from paypanel.operators.skew import HOT_ROWS, join_back, with_rank
from paypanel.plans.stages import written

KEY = "matricule"
MONTH_SEX = ["annee", "mois", "SEXE_IMPUTE"]


def add_collection_date(df: DataFrame) -> DataFrame:
    return df.withColumn("collecte", month_end("mois_annee"))


def impute_sex(df: DataFrame) -> DataFrame:
    """SEXE_CLEAN: the person's last known sex; SEXE_IMPUTE: the month's mode where none is known."""
    d = df.withColumn("_sexe", sex_letter("sexe"))
    last = latest_value(d, KEY, "_sexe", ["periode", "row_id"]).withColumnRenamed("_sexe_dernier", "SEXE_CLEAN")
    return group_mode_fill(join_back(d, last, [KEY]).drop("_sexe"), "SEXE_CLEAN", ["annee", "mois"], "SEXE_IMPUTE")


def _between(c: str, low: int, high: int) -> Column:
    return F.when(F.col(c).between(low, high), F.col(c))


def stabilize(df: DataFrame, value: str, out: str, method: str) -> DataFrame:
    """One value per person: its last, most frequent or median one."""
    if method == "last":
        one = latest_value(df, KEY, value, ["periode", "row_id"]).withColumnRenamed(f"{value}_dernier", out)
    elif method == "mode":
        one = modal_value(df, [KEY], value, out)
    elif method == "median":
        one = group_quantiles(df, [KEY], {out: median(value)}).select("_g.*", out)
    else:
        raise ValueError("method is one of last, mode, median")
    return join_back(df, one, [KEY])


def add_age(df: DataFrame, low: int = 18, high: int = 70) -> DataFrame:
    """Birth date (the person's latest usable one), exact age and valid age."""
    d = df.withColumn("naissance", clean_date("date_naissance"))
    birth = latest_value(d, KEY, "naissance", ["periode", "row_id"])
    d = join_back(d, birth, [KEY]).withColumn("AGE", age_years(F.col("naissance_dernier"), F.col("collecte")))
    return d.withColumn("AGE_VALIDE", _between("AGE", low, high).cast("double"))


def build_age(df: DataFrame, low: int = 18, high: int = 70, method: str = "last") -> DataFrame:
    """AGE, AGE_VALIDE, AGE_IMPUTE (median of month × sex) and AGE_IMPUTE_STABLE."""
    d = written(add_age(df, low, high), "age")
    d = group_median_fill(d, "AGE_VALIDE", MONTH_SEX, "AGE_IMPUTE")
    return stabilize(d, "AGE_IMPUTE", "AGE_IMPUTE_STABLE", method)


def age_coherent(df: DataFrame) -> DataFrame:
    """Age that advances with time: first valid age (else first imputed one) plus elapsed years."""
    d = group_median_fill(df, "AGE_VALIDE", MONTH_SEX, "_base")
    d = d.withColumn("_base", F.coalesce("AGE_VALIDE", "_base"))
    order = F.struct("collecte", "row_id")
    valid = F.when(F.col("AGE_VALIDE").isNotNull(), order)
    start = d.groupBy(KEY).agg(
        F.min_by(F.struct(F.col("AGE_VALIDE").alias("a"), F.col("collecte").alias("d")), valid).alias("_v"),
        F.min_by(F.struct(F.col("_base").alias("a"), F.col("collecte").alias("d")), order).alias("_f"),
    )
    start = start.select(KEY, F.coalesce("_v", "_f").alias("_s"))
    elapsed = years_between(F.col("_s.d"), F.col("collecte"))
    return (
        join_back(d, start, [KEY])
        .withColumn("AGE_COHERENT", F.bround(F.col("_s.a") + elapsed, 0))
        .drop("_s", "_base")
    )


def add_service_start(df: DataFrame) -> DataFrame:
    """Start of service as it stands on the person's latest row, even when empty there."""
    d = df.withColumn("prise_service_clean", clean_date("prise_service"))
    one = d.groupBy(KEY).agg(
        F.max_by(F.struct(F.col("prise_service_clean").alias("s")), F.struct("periode", "row_id"))
        .getField("s")
        .alias("prise_service_corrigee")
    )
    return join_back(d, one, [KEY])


def build_age_service(
    df: DataFrame, age: str = "AGE_IMPUTE_STABLE", low: int = 18, high: int = 40, method: str = "mode"
) -> DataFrame:
    """Age at start of service: computed, valid, imputed, several-values flag and one value per person."""
    days = F.datediff("collecte", "prise_service_corrigee")
    d = df.withColumn("AGE_AU_SERVICE", F.col(age) - F.floor(days / 365))
    d = d.withColumn("AGE_AU_SERVICE_VALIDE", _between("AGE_AU_SERVICE", low, high))
    d = group_median_fill(written(d, "service"), "AGE_AU_SERVICE_VALIDE", MONTH_SEX, "AGE_AU_SERVICE_IMPUTE")
    several = d.groupBy(KEY).agg((F.count_distinct("AGE_AU_SERVICE_IMPUTE") > 1).cast("int").alias("FLAG_MULTI_AGE_SERVICE"))
    return stabilize(join_back(d, several, [KEY]), "AGE_AU_SERVICE_IMPUTE", "AGE_AU_SERVICE_FINAL", method)


def age_service_stable(
    df: DataFrame,
    age: str,
    start: str = "prise_service_corrigee",
    low: int = 14,
    high: int = 60,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One age at start per person, from the first, else the middle, else the last usable row.

    When none lies in range the largest is kept and named as invalid. One row per person.
    """
    usable = df.where(F.col(age).isNotNull() & F.col(start).isNotNull() & F.col("collecte").isNotNull())
    ranked = with_rank(usable, KEY, hot_rows=hot_rows)
    first_start = F.max(F.when(F.col("rang") == 1, F.col(start)))

    def at(position: Column, c: str) -> Column:
        return F.max(F.when(F.col("rang") == position, F.col(c)))

    places = {
        "PREMIERE_OBS": F.lit(1),
        "OBS_MEDIANE": F.floor(F.col("effectif") / 2) + 1,
        "DERNIERE_OBS": F.col("effectif"),
    }
    picked = ranked.groupBy(KEY).agg(
        first_start.alias("_s"),
        *[at(pos, age).alias(f"_a_{name}") for name, pos in places.items()],
        *[at(pos, "collecte").alias(f"_d_{name}") for name, pos in places.items()],
    )
    value = {n: F.col(f"_a_{n}") - years_between(F.col("_s"), F.col(f"_d_{n}")) for n in places}
    picked = picked.withColumns({f"_v_{n}": v for n, v in value.items()})
    best = F.greatest(*[F.col(f"_v_{n}") for n in places])
    result, method = None, None
    for n in places:
        v, ok = F.col(f"_v_{n}"), F.col(f"_v_{n}").between(low, high)
        result = F.when(ok, v) if result is None else result.when(ok, v)
        method = F.when(ok, n) if method is None else method.when(ok, n)
    for n in places:
        method = method.when(F.col(f"_v_{n}") == best, f"{n}_INVALIDE")
    out = picked.select(
        KEY, result.otherwise(best).alias("AGE_AU_SERVICE"), method.alias("AGE_SERVICE_METHODE")
    ).withColumn("AGE_AU_SERVICE_VALIDE", _between("AGE_AU_SERVICE", low, high))
    everyone = df.select(KEY).distinct()
    return everyone.join(out, KEY, "left").withColumn(
        "AGE_SERVICE_METHODE", F.coalesce("AGE_SERVICE_METHODE", F.lit("AUCUNE_DONNEE"))
    )


# Statuses from weakest to strongest.
STATUS_PRIORITY = ["Non Fonctionnaire", "Cas particulier", "Fonctionnaire"]


def status_final(df: DataFrame, keys: list[str], status: str = "STATUT", out: str = "STATUT_DEF") -> DataFrame:
    """Strongest status of the rows sharing ``keys`` (person × month or person × year)."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUS_PRIORITY]), F.col(status))
    best = df.groupBy(*keys).agg(F.greatest(F.max(rank), F.lit(1)).cast("int").alias("_rank"))
    label = F.element_at(F.array(*[F.lit(s) for s in STATUS_PRIORITY]), F.col("_rank"))
    return join_back(df, best, keys).withColumn(out, label).drop("_rank")


def person_variables(df: DataFrame) -> DataFrame:
    """Sex, age and age at start on every row."""
    d = build_age(written(impute_sex(add_collection_date(df)), "sexe"))
    return build_age_service(add_service_start(written(d, "age")))
