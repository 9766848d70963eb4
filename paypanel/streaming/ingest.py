"""Newly landed period files as Structured Streaming jobs.

Both jobs run once over what is new (``availableNow``) and stop. File bookkeeping sits in the
stream checkpoint, so a file is taken exactly once even after a failed run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paypanel.operators.aggregates import count_rows
from paypanel.functions.people import std_sex
from paypanel.sources.files import PERIOD_IN_NAME, with_period

VERSION = "(?i)[_-]v([0-9]+)"
#: The end of a name that only tells parts of one delivery apart: ``_a``, ``_2``, ``_part3``.
PART = "(?i)[_-](part|partie|lot|p)?[_-]?([0-9]{1,2}|[a-z])$"


def landed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Stream of the rows of period files, with period and file name from the path."""
    name = F.col("_metadata.file_name")
    rows = spark.readStream.schema(schema).parquet(folder)
    return with_period(
        rows.select("*", F.regexp_extract(name, PERIOD_IN_NAME, 1).alias("mois_annee"), name.alias("fichier_source"))
    )


def ingest_new_files(spark: SparkSession, folder: str, schema: T.StructType, bronze: str, checkpoint: str) -> None:
    """Append every new file to Bronze exactly once, one folder per period."""
    query = (
        landed(spark, folder, schema)
        .writeStream.format("parquet")
        .partitionBy("periode")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def version_in_name() -> Column:
    """The number after ``_v`` in a file's name, 1 without one."""
    return F.coalesce(F.regexp_extract(F.col("_metadata.file_name"), VERSION, 1).try_cast("int"), F.lit(1))


def label_in_name() -> Column:
    """What a file's name says besides period, version and part: empty, or a word such as ``corrige``."""
    name = F.lower(F.regexp_replace(F.col("_metadata.file_name"), r"[.][^.]*$", ""))
    for pattern in (PERIOD_IN_NAME, VERSION, PART):
        name = F.regexp_replace(name, pattern, "")
    return F.regexp_replace(name, r"[^\p{L}\p{N}]+", "")


def file_entries(rows: DataFrame) -> DataFrame:
    """What each file says of each person and organisation: the state that headcounts are made from."""
    sex = std_sex("sexe")
    return rows.groupBy("periode", "fichier_source", "version", "libelle_livraison", "recu", "organisme", "matricule").agg(
        count_rows("lignes"), F.count_if(sex == "Homme").alias("hommes"), F.count_if(sex == "Femme").alias("femmes")
    )


def newest_delivery(entries: DataFrame) -> DataFrame:
    """Entries of each period's newest delivery: the highest version, of these the one whose first file came last."""
    deliveries = entries.groupBy("periode", "version", "libelle_livraison").agg(F.min("recu").alias("debut"))
    best = deliveries.groupBy("periode").agg(F.max(F.struct("version", "debut", "libelle_livraison")).alias("d"))
    best = best.select("periode", F.col("d.version").alias("version"), F.col("d.libelle_livraison").alias("libelle_livraison"))
    return entries.join(F.broadcast(best), ["periode", "version", "libelle_livraison"], "left_semi")  # one row per period


def running_effectifs(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    delivery: Column | None = None,
    state: str | None = None,
) -> None:
    """Headcounts per period, kept up to date; a period delivered again replaces its earlier figures.

    Arrivals alone are read: each new file is reduced to its entries per person, kept in the ``state`` folder by period and
    file, and the periods it touches are counted anew from their entries. Files of one version and label are parts of one
    delivery, whenever each arrived; ``_v2`` or a new label (``_corrige``) starts another one. The highest version
    counts, of equal ones the delivery that began last, so a late part of an older delivery changes nothing. Only folders
    of these files and periods are overwritten, so repeating a batch gives the same tables. ``delivery`` gives
    the version otherwise than by ``_vN``, from the file's metadata.
    """
    order = version_in_name() if delivery is None else delivery
    state = state or f"{checkpoint.rstrip('/')}-state"
    meta = F.col("_metadata.file_name")
    arrived = with_period(
        spark.readStream.schema(schema)
        .parquet(folder)
        .select(
            "organisme",
            "matricule",
            "sexe",
            F.regexp_extract(meta, PERIOD_IN_NAME, 1).alias("mois_annee"),
            meta.alias("fichier_source"),
            order.cast("int").alias("version"),
            label_in_name().alias("libelle_livraison"),
            F.col("_metadata.file_modification_time").alias("recu"),
        )
    )

    def overwrite(df: DataFrame, path: str, *by: str) -> None:
        df.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)

    def upsert(batch: DataFrame, _: int) -> None:
        entries = file_entries(batch)
        overwrite(entries, state, "periode", "fichier_source")
        touched = [r["periode"] for r in batch.select("periode").distinct().collect()]  # as many as the calendar has
        known = spark.read.schema(entries.schema).parquet(state).where(F.col("periode").isin(touched))
        counts = newest_delivery(known).groupBy("periode", "organisme").agg(
            F.sum("lignes").alias("nb_lignes"),
            F.count_distinct("matricule").alias("nb_agents"),
            F.sum("hommes").alias("nb_hommes"),
            F.sum("femmes").alias("nb_femmes"),
        )
        overwrite(counts, target, "periode")

    query = (
        arrived.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
