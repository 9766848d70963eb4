"""Bronze to Silver: casts, situation filter, periods, keys, pay items."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paypanel.functions.dates import period_int, period_parts
from paypanel.functions.grades import VALID_GRADES, extract_grade
from paypanel.functions.people import KEPT_SITUATIONS, normalize_situation
from paypanel.functions.text import filled
from paypanel.operators.skew import join_back

AMOUNTS = ["montant_brut", "montant_net", "retenue_pension", "impot", "charge_patronale"]

# Pay items that make up the gross salary, and the four-item variant.
BRUT_CODES = ["124", "228", "271", "421", "425"]
BRUT_CODES_SHORT = ["124", "228", "421", "425"]


def cast_amounts(df: DataFrame) -> DataFrame:
    """Lenient double cast of the five amounts and of columns named after a pay code."""
    wanted = [c for c in df.columns if c in AMOUNTS or re.match("[0-9]", c)]
    return df.withColumns({c: F.col(f"`{c}`").try_cast("double") for c in wanted})


def add_situation(df: DataFrame) -> DataFrame:
    return df.withColumn("situation_normalisee", normalize_situation("situation"))


def filter_situations(df: DataFrame) -> DataFrame:
    return df.where(F.col("situation_normalisee").isin(*KEPT_SITUATIONS))


def add_period(df: DataFrame, source: str = "mois_annee") -> DataFrame:
    year, month = period_parts(source)
    return df.withColumns({"annee": year, "mois": month, "periode": period_int(year, month)})


def add_grade(df: DataFrame) -> DataFrame:
    return df.withColumn("GRADE", extract_grade("statut_fonctionnaire"))


def to_silver(df: DataFrame) -> DataFrame:
    """Situation classes kept, period columns and raw grade added."""
    return add_grade(add_period(filter_situations(add_situation(df))))


def derive_keys(df: DataFrame, key: str, id_length: int = 7) -> DataFrame:
    """Split person‖organisation into its fixed-length person part and the rest."""
    return df.withColumns(
        {
            "matricule_verif": F.substring(key, 1, id_length),
            "code_organisme_verif": F.substr(F.col(key), F.lit(id_length + 1)),
            "longueur_cle": F.length(key),
        }
    )


def exactly_one_filled(cols: list[str]) -> Column:
    """True when exactly one of the cells holds a value."""
    count = F.lit(0)
    for c in cols:
        count = count + filled(F.col(c).cast("string")).cast("int")
    return count == 1


def drop_if_others_empty(df: DataFrame, rule_cols: list[str], keep: list[str]) -> DataFrame:
    """Drop rows that break the exactly-one rule and whose cells outside ``keep`` are all blank."""
    others = [c for c in df.columns if c not in keep]
    blank = F.lit(True)
    for c in others:
        blank = blank & F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(True))
    return df.where(exactly_one_filled(rule_cols) | ~blank)


def filter_valid_grades(df: DataFrame, value: str = "montant_brut", include_zero: bool = False) -> DataFrame:
    ok = F.col("GRADE").isin(*VALID_GRADES)
    return df.where(ok if include_zero else ok & (F.col(value) > 0))


def filter_panel_base(df: DataFrame, first_year: int = 2015, last_year: int = 2099) -> DataFrame:
    return df.where(
        (F.col("montant_brut") > 0) & F.col("annee").between(first_year, last_year) & (F.col("GRADE") != "")
    )


def apply_filters(df: DataFrame, choices: dict[str, list]) -> DataFrame:
    """Keep rows matching every list; an empty list or 'Tous' leaves a column free."""
    for col, values in choices.items():
        if values and "Tous" not in values and col in df.columns:
            df = df.where(F.col(col).isin(*values))
    return df


def brut_from_components(
    df: DataFrame, items: DataFrame, key: list[str], codes: list[str] = BRUT_CODES, out: str = "SALAIRE_BRUT"
) -> DataFrame:
    """Gross salary as the sum of its pay items; rows without any item keep ``montant_brut``."""
    sums = items.where(F.col("code").isin(*codes)).groupBy(*key).agg(F.sum("montant").alias(out))
    joined = join_back(df, sums.dropna(subset=key), key)  # rows are wide and sums narrow, so sums are hashed and rows not sorted
    rest = [c for c in df.columns if c not in key]
    return joined.select(*key, *rest, F.coalesce(out, "montant_brut").alias(out))


def unpivot_paycodes(wide: DataFrame, ids: list[str]) -> DataFrame:
    """One row per non-NULL pay item of a wide sheet."""
    codes = [c for c in wide.columns if c not in ids]
    typed = wide.select(*ids, *[F.col(f"`{c}`").try_cast("double").alias(c) for c in codes])
    return typed.unpivot(ids, codes, "code", "montant").where(F.col("montant").isNotNull())


def pivot_paycodes(items: DataFrame, ids: list[str], codes: list[str]) -> DataFrame:
    """Wide sheet for a fixed list of pay codes."""
    return items.groupBy(*ids).pivot("code", codes).agg(F.sum("montant"))


def rename_by_codes(columns: list[str], mapping: dict[str, str]) -> list[str]:
    """Labels of code columns; a label claimed by several codes gets its code appended."""
    labels = [mapping.get(c, c) for c in columns]
    return [
        f"{lab} (code {c})" if labels.count(lab) > 1 and lab != c else lab for c, lab in zip(columns, labels)
    ]


def label_items(items: DataFrame, labels: DataFrame) -> DataFrame:
    """Long form of the same: each pay item with its label, disambiguated by code."""
    clash = labels.groupBy("libelle").agg(F.count_distinct("code").alias("_n"))
    names = labels.join(clash, "libelle").select(
        "code",
        F.when(F.col("_n") > 1, F.concat(F.col("libelle"), F.lit(" (code "), F.col("code"), F.lit(")")))
        .otherwise(F.col("libelle"))
        .alias("poste"),
    )
    return items.join(names, "code", "left").withColumn("poste", F.coalesce("poste", "code"))


