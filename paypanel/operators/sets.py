"""Stacking, differences between periods, calendars, sorting and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paypanel.functions.dates import period_index


def pay_scale_grid(spark: SparkSession, rows: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Employment -> pay scale and reference grade, as a small table."""
    rows = rows or [
        ("Building", "ENS SEC & PRIM", "A3"),
        ("machinery", "police", "B3"),
        ("AUTOMOBILE.", "ENS SUP", "A5"),
        ("Furniture", "Tech-Santé", "C3"),
    ]
    return spark.createDataFrame(rows, "emploi_ref string, bareme string, grade_ref string")


def panel_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows range-partitioned and sorted inside partitions, NULLs last: files in panel order."""
    order: list[Column] = [F.col(k).asc_nulls_last() for k in keys]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def top_k(df: DataFrame, by: str, ties: list[str], k: int) -> DataFrame:
    return df.orderBy(F.desc(by), *ties).limit(k)


def neighbour_changes(names: DataFrame, period: str = "periode", name: str = "colonne") -> DataFrame:
    """Names that appear or disappear between consecutive present periods.

    ``names`` holds one row per (period, name). Periods are numbered through a calendar of the
    distinct periods (at most months x years rows).
    """
    distinct = names.select(period, name).distinct()
    calendar = distinct.select(period).distinct()
    w = Window.orderBy(period)  # one row per month
    steps = calendar.select(F.col(period), F.lead(period).over(w).alias("_next"), F.lag(period).over(w).alias("_prev"))
    here = distinct.join(steps, period)
    other = distinct.select(F.col(period).alias("_p"), F.col(name).alias("_n"))
    gone = (
        here.where(F.col("_next").isNotNull())
        .join(other, (F.col("_next") == F.col("_p")) & (F.col(name) == F.col("_n")), "left_anti")
        .select(F.col(period).alias("periode_avant"), F.col("_next").alias("periode_apres"), name, F.lit("DISPARUE").alias("changement"))
    )
    new = (
        here.where(F.col("_prev").isNotNull())
        .join(other, (F.col("_prev") == F.col("_p")) & (F.col(name) == F.col("_n")), "left_anti")
        .select(F.col("_prev").alias("periode_avant"), F.col(period).alias("periode_apres"), name, F.lit("APPARUE").alias("changement"))
    )
    return gone.unionByName(new)


def period_counts(names: DataFrame, period: str = "periode", name: str = "colonne") -> DataFrame:
    """Distinct names per period."""
    return names.groupBy(period).agg(F.count_distinct(name).alias("nb"))


def name_summary(names: DataFrame, period: str = "periode", name: str = "colonne") -> DataFrame:
    """Distinct names over all periods, smallest and largest, and the per-period min, max and mean."""
    per = period_counts(names, period, name).agg(
        F.min("nb").alias("min_par_periode"), F.max("nb").alias("max_par_periode"), F.round(F.avg("nb"), 1).alias("moyenne")
    )
    total = names.agg(F.count_distinct(name).alias("n"), F.min(name).alias("a"), F.max(name).alias("z"))
    return per.select(
        "*",
        total.select("n").scalar().alias("nb_distincts"),
        total.select("a").scalar().alias("premier"),
        total.select("z").scalar().alias("dernier"),
    )


def expected_periods(spark: SparkSession, first: int, last: int) -> DataFrame:
    """All YYYYMM periods of an inclusive range."""
    lo, hi = first // 100 * 12 + first % 100 - 1, last // 100 * 12 + last % 100 - 1
    i = F.col("id")
    return spark.range(lo, hi + 1).select((F.floor(i / 12) * 100 + i % 12 + 1).cast("int").alias("periode"))


def period_gaps(present: DataFrame, earlier: DataFrame, first: int, last: int) -> DataFrame:
    """Missing and unexpected periods, with a mark when the earlier layer has the missing one."""
    have = present.select("periode").distinct()
    want = expected_periods(present.sparkSession, first, last)
    known = earlier.select("periode").distinct().withColumn("_known", F.lit(True))
    missing = want.join(have, "periode", "left_anti").withColumn("etat", F.lit("MANQUANTE"))
    extra = have.join(want, "periode", "left_anti").withColumn("etat", F.lit("INATTENDUE"))
    return (
        missing.unionByName(extra)
        .join(known, "periode", "left")
        .withColumn("dans_couche_precedente", F.coalesce("_known", F.lit(False)))
        .drop("_known")
    )


def months_apart(a: Column | str, b: Column | str) -> Column:
    return period_index(b) - period_index(a)


def sample_rows(df: DataFrame, key: list[str], n: int, seed: int = 1) -> DataFrame:
    """Repeatable sample of n rows: the smallest hashes of the key, found partition by partition."""
    h = F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))), 256)
    return df.withColumn("_h", h).orderBy("_h", *key).limit(n).drop("_h")
