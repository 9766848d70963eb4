"""Enrichment and reconciliation joins.

Which side is sent whole is decided by the sizes measured at run time (``paypanel.session``), and planning a join starts
no job. Only code tables are written and counted first: labels are few, so rows that were exchanged by label would meet in a
few tasks, however many rows there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.functions.text import clean_place, norm_label
from paypanel.operators.skew import lookup_back


def join_sheets(agents: DataFrame, items: DataFrame, key: str = "cle_unique") -> DataFrame:
    """Agent rows with their pay-item columns; clashing item columns get ``_F2``."""
    right = items.toDF(*[c if c == key else f"{c}_F2" if c in agents.columns else c for c in items.columns])
    return agents.join(right, key, "left")


def code_table(dim: DataFrame, label: str = "libelle", code: str = "code", extras: list[str] | None = None) -> DataFrame:
    """One row per normalised label: the smallest (code, extras) row, taken whole."""
    extras = extras or []
    pick = F.struct(F.col(code), *[F.col(c) for c in extras])
    return (
        dim.withColumn("libelle_norm", norm_label(label))
        .where(F.col("libelle_norm").isNotNull())
        .groupBy("libelle_norm")
        .agg(F.min(pick).alias("_pick"))
        .select("libelle_norm", F.col("_pick").getField(code).alias(code), *[F.col(f"_pick.{c}") for c in extras])
    )


def enrich_code(
    df: DataFrame, dim: DataFrame, source: str, out: str, extras: list[str] | None = None, code: str = "code"
) -> DataFrame:
    """Add the code (and attributes) of a label column; an absent label column gives NULL codes."""
    if source not in df.columns:
        return df.withColumn(out, F.lit(None).cast("string"))
    table = code_table(dim, code=code, extras=extras).withColumnsRenamed({code: out, "libelle_norm": "_norm"})
    rows = df.drop(out, *(extras or [])).withColumn("_norm", norm_label(source))
    return lookup_back(rows, table, ["_norm"]).drop("_norm")


def enrich_codes(df: DataFrame, dims: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """``dims``: code column -> (code table, label column, attribute columns)."""
    for out, (dim, source, extras) in dims.items():
        df = enrich_code(df, dim, source, out, extras)
    return df


def join_bareme(df: DataFrame, grid: DataFrame, emploi: str = "emploi") -> DataFrame:
    """Pay scale and reference grade of the employment; grid columns emploi_ref, bareme, grade_ref."""
    return enrich_code(
        df, grid.withColumnRenamed("emploi_ref", "libelle"), emploi, "bareme", ["grade_ref"], code="bareme"
    )


def match_rate(df: DataFrame, cols: list[str]) -> DataFrame:
    total = F.count(F.lit(1))
    return df.agg(*[F.round(F.count(c) * 100.0 / total, 1).alias(c) for c in cols])


def fill_from_lookup(df: DataFrame, lookup: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Fill only missing cells from a lookup with one row per key."""
    new = lookup.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols])
    filled = df.join(new, key, "left")
    return filled.withColumns({c: F.coalesce(c, f"_new_{c}") for c in cols}).drop(*[f"_new_{c}" for c in cols])


def fill_audit(df: DataFrame, lookup: DataFrame, key: str, col: str, ids: list[str]) -> DataFrame:
    """Rows a fill changes, with the value before and after."""
    new = lookup.select(key, F.col(col).alias(f"{col}_AFTER"))
    return (
        df.where(F.col(col).isNull())
        .join(new, key)
        .where(F.col(f"{col}_AFTER").isNotNull())
        .select(*ids, key, F.col(col).alias(f"{col}_BEFORE"), f"{col}_AFTER")
    )


def first_rows(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row of each key; the limit is applied before the shuffle too, so hot keys stay small."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upper_median_rows(cells: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Row at rank n÷2 + 1 of each key; meant for small cell tables such as months of a year."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    n = F.count("*").over(Window.partitionBy(*keys))
    middle = F.col("_r") == F.floor(F.col("_n") / 2) + 1
    return cells.withColumns({"_r": rank, "_n": n}).where(middle).drop("_r", "_n")


def outer_reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    right_order: list[str] | None = None,
    suffixes: tuple[str, str] = ("_b0", "_b1"),
) -> DataFrame:
    """Full outer result with the origin of each row; shared columns get suffixes.

    Built as a left join plus the right rows without partner: unlike a full outer join, both
    parts can be split when one key holds a large share of the rows. ``right_order`` keeps the
    first right row per key.
    """
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    b = first_rows(right, keys, right_order) if right_order else right
    b = b.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    both = a.join(b.withColumn("_in2", F.lit(True)), keys, "left").withColumns(
        {"IN_BASE1": F.lit(True), "IN_BASE2": F.coalesce("_in2", F.lit(False))}
    )
    alone = b.join(a.select(*keys).distinct(), keys, "left_anti").withColumns(
        {"IN_BASE1": F.lit(False), "IN_BASE2": F.lit(True)}
    )
    origin = F.when(~F.col("IN_BASE2"), "base1").when(~F.col("IN_BASE1"), "base2").otherwise("both")
    return both.drop("_in2").unionByName(alone, allowMissingColumns=True).withColumn("IN_SRC", origin)


def unmatched(df: DataFrame, reference: DataFrame, label: str, ref_label: str) -> DataFrame:
    """Labels without a reference entry and how often they occur."""
    counts = df.groupBy(F.col(label).alias("libelle")).agg(F.count(F.lit(1)).alias("n"))
    ref = reference.select(F.col(ref_label).alias("_ref")).distinct()
    return counts.join(ref, F.col("libelle") == F.col("_ref"), "left_anti")


def ambiguous(ref: DataFrame, label: str, code: str) -> DataFrame:
    """Labels that carry several codes."""
    return (
        ref.groupBy(label).agg(F.count_distinct(code).alias("n_codes")).where(F.col("n_codes") > 1)
    )


def drop_ambiguous(ref: DataFrame, label: str, code: str) -> DataFrame:
    return ref.join(ambiguous(ref, label, code).select(label), label, "left_anti")


def drop_repeated(ref: DataFrame, label: str) -> DataFrame:
    """Remove every label that occurs more than once, all its rows included."""
    again = ref.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(label)
    return ref.join(again, label, "left_anti")


def two_pass_match(df: DataFrame, first: DataFrame, second: DataFrame, label: str, code: str) -> DataFrame:
    """Code from the first reference, from the second where the first has none (both unique by label)."""
    a = first.select(F.col(label), F.col(code).alias("_c1"))
    b = second.select(F.col(label), F.col(code).alias("_c2"))
    origin = F.when(F.col("_c1").isNotNull(), 1).when(F.col("_c2").isNotNull(), 2).otherwise(0)
    return (
        df.join(a, label, "left")
        .join(b, label, "left")
        .withColumns({code: F.coalesce("_c1", "_c2"), "passe": origin})
        .drop("_c1", "_c2")
    )


def month_grid(df: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """Every key for every month of the window, as first-of-month dates."""
    months = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))
    return df.select(*keys).distinct().withColumn("mois_date", F.explode(months))


def id_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Counts of ids common to both frames, missing from the second and only in the second."""
    left = a.select(key).distinct().withColumn("_a", F.lit(1))
    right = b.select(key).distinct().withColumn("_b", F.lit(1))
    both = left.join(right, key, "full")
    return both.agg(
        F.count("_a").alias("n_gauche"),
        F.count("_b").alias("n_droite"),
        F.count(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1)).alias("communs"),
        F.count(F.when(F.col("_b").isNull(), 1)).alias("manquants"),
        F.count(F.when(F.col("_a").isNull(), 1)).alias("surplus"),
    )


def new_membership(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Flag rows whose key is absent from ``known``."""
    seen = known.select(F.col(key).alias("_k")).distinct().withColumn("_seen", F.lit(True))
    return (
        df.join(seen, F.col(key) == F.col("_k"), "left")
        .withColumn("est_nouveau", F.col("_seen").isNull())
        .drop("_k", "_seen")
    )


def geo_join(df: DataFrame, places: DataFrame, place: str, name: str, attributes: list[str]) -> DataFrame:
    """Attributes of the place whose cleaned name is unique in the locality table."""
    ref = drop_repeated(places.withColumn("_place", clean_place(name)), "_place").select("_place", *attributes)
    return df.withColumn("_place", clean_place(place)).join(ref, "_place", "left").drop("_place")
