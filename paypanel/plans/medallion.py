"""The full chain from Bronze rows to Gold tables, one written layer per stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from paypanel.functions.people import std_sex
from paypanel.operators.aggregates import effectifs, masse_salariale
from paypanel.operators.imputation import impute_grades, impute_salaries
from paypanel.operators.joins import enrich_codes
from paypanel.operators.schema import select_panel
from paypanel.operators.silver import cast_amounts, to_silver
from paypanel.operators.windows import dedup_panel
from paypanel.plans.views import panel_base
from paypanel.sources.files import write_partitioned


@dataclass(frozen=True)
class Layers:
    """Paths of one version of the layers under a root folder."""

    root: str
    version: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/version={self.version}"


def rebuild(
    spark: SparkSession,
    bronze: DataFrame,
    dims: dict[str, tuple[DataFrame, str, list[str]]],
    layers: Layers,
    min_obs: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Silver, graded Silver, imputed Silver, panel, base view and the two marts.

    ``bronze`` carries ``row_id`` and the standard column names. Every stage reads the stage
    before it from its new version folder, never from what it is writing.
    """

    def save(df: DataFrame, name: str) -> DataFrame:
        write_partitioned(df, layers.path(name))
        return spark.read.parquet(layers.path(name))

    silver = save(enrich_codes(to_silver(cast_amounts(bronze)), dims), "silver")
    graded = save(impute_grades(silver), "silver_grades")
    paid = save(impute_salaries(graded, min_obs=min_obs), "silver_salaires")
    panel = save(select_panel(dedup_panel(paid, ["matricule", "mois_annee"])), "panel")
    base = save(panel_base(panel, first_year=1900), "base")
    return {
        "silver": paid,
        "panel": panel,
        "base": base,
        "masse_salariale": save(masse_salariale(paid), "masse_salariale"),
        "effectifs": save(effectifs(paid.withColumn("SEXE_STD", std_sex("sexe"))), "effectifs"),
    }
