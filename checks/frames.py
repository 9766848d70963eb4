"""Frames the registered queries share, built with the library's own operators.

Silver, imputed Silver and the Gold panel are written layers, as in the pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixture import frame, table
from paypanel.functions.people import std_sex
from paypanel.operators.imputation import impute_grades
from paypanel.operators.joins import enrich_code
from paypanel.operators.silver import add_grade, add_period, add_situation, filter_situations
from paypanel.operators.windows import dedup_panel
from paypanel.plans.stages import layer

__all__ = ["frame", "table", "graded", "silver", "imputed", "panel", "rounded"]


def graded(spark: SparkSession, sf: str) -> DataFrame:
    def build():
        d = add_situation(add_grade(add_period(frame(spark, sf, "panel_src"))))
        return d.withColumn("SEXE_STD", std_sex("sexe"))

    return layer(spark, f"graded {sf}", build)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return filter_situations(graded(spark, sf))


def imputed(spark: SparkSession, sf: str) -> DataFrame:
    return layer(spark, f"imputed {sf}", lambda: impute_grades(silver(spark, sf)))


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Gold panel: imputed grades, job codes, one row per (person, month)."""

    def build():
        dim = frame(spark, sf, "dim_emploi")
        d = enrich_code(imputed(spark, sf), dim, "emploi", "_code", ["Code_CITP", "Metier_CITP"])
        return dedup_panel(d.drop("_code"), ["matricule", "mois_annee"])

    return layer(spark, f"panel {sf}", build)


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})
