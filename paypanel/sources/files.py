"""Reading and writing panel files with Spark's own connectors.

Writers never replace the data they read from: a new version goes to a new path and
``current_version`` tells which one to read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paypanel.functions.dates import period_int, period_parts
from paypanel.functions.text import norm_label
from paypanel.operators.schema import normalize_column_name_expr, stack_by_name, standardize
from paypanel.operators.sets import sample_rows

#: Rows of a report that one task may write into one file.
REPORT_ROWS = 1_000_000
PERIOD_IN_NAME = r"([0-9]{6}|[0-9]{4}[-_][0-9]{2})"


def file_period() -> Column:
    """Period text of the file a row comes from; the name is trusted, the content is not."""
    return F.regexp_extract(F.col("_metadata.file_name"), PERIOD_IN_NAME, 1)


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All period files of a folder with the period taken from each file name.

    Without ``schema`` the columns of all files are united (missing ones are NULL).
    """
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    raw = reader.parquet(path)
    keep = [c for c in raw.columns if c not in ("mois_annee",)]
    return raw.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in keep],
        file_period().alias("mois_annee"),
        F.col("_metadata.file_name").alias("fichier_source"),
    )


def read_bronze_standardized(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files whose headers differ: each is renamed to standard names, then stacked by name."""
    frames = [standardize(read_bronze(spark, p)) for p in paths]
    return stack_by_name(frames)


def read_silver(
    spark: SparkSession, path: str, years: list[int] | None = None, cols: list[str] | None = None
) -> DataFrame:
    """Yearly layer: only the wanted partitions and columns are scanned."""
    df = spark.read.parquet(path)
    if years:
        df = df.where(F.col("annee").isin(*years))
    return df.select(*cols) if cols else df


def read_text_table(spark: SparkSession, path: str, fmt: str | None = None, sep: str = ",") -> DataFrame:
    """CSV or Parquet table as strings, by extension unless told otherwise."""
    kind = fmt or ("parquet" if path.rstrip("/").endswith((".parquet", ".pq")) else "csv")
    if kind == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return spark.read.option("header", True).option("sep", sep).csv(path)


# ---------------------------------------------------------------- raw sheet rows

RAW_SCHEMA = T.StructType(
    [
        T.StructField("fichier", T.StringType()),
        T.StructField("ligne", T.IntegerType()),
        T.StructField("cellules", T.ArrayType(T.StringType())),
    ]
)


def locate_header(raw: DataFrame, default: int = 0, depth: int = 20, word: str = "matricule") -> DataFrame:
    """(fichier, entete): first of the leading rows with the word, else ``default`` (1 for sheet 2)."""
    hit = (F.col("ligne") < depth) & F.exists("cellules", lambda c: F.lower(c).contains(word))
    return raw.groupBy("fichier").agg(F.coalesce(F.min(F.when(hit, F.col("ligne"))), F.lit(default)).alias("entete"))


def score_header(
    raw: DataFrame, critical: list[str], important: list[str], depth: int = 50, min_important: float = 0.5
) -> DataFrame:
    """(fichier, entete, score): row with all critical and enough important names, best score first.

    Names are compared after label normalisation; files without such a row are absent.
    """
    found = F.transform("cellules", lambda c: norm_label(c))

    def share(names: list[str]) -> Column:
        return F.size(F.array_intersect(found, F.array(*[F.lit(n) for n in names]))) / F.lit(float(len(names)))

    scored = (
        raw.where(F.col("ligne") <= depth)
        .withColumns({"_c": share(critical), "_i": share(important)})
        .where((F.col("_c") == 1.0) & (F.col("_i") >= min_important))
        .withColumn("score", F.round(F.col("_c") * 0.7 + F.col("_i") * 0.3, 6))
    )
    best = F.min(F.struct(-F.col("score"), F.col("ligne"))).alias("_b")
    return scored.groupBy("fichier").agg(best).select(
        "fichier", F.col("_b.ligne").alias("entete"), (-F.col("_b.col1")).alias("score")
    )


def header_names(raw: DataFrame, headers: DataFrame) -> DataFrame:
    """(fichier, entete, noms): the unique normalised names of each file's header row, by position."""
    named = raw.join(headers.select("fichier", "entete"), "fichier").where(F.col("ligne") == F.col("entete"))
    named = named.select("fichier", "entete", F.transform("cellules", normalize_column_name_expr).alias("_n"))

    def unique(name: Column, i: Column) -> Column:
        nth = F.size(F.filter(F.slice("_n", 1, i + 1), lambda other: other == name))
        return F.when(nth > 1, F.concat(name, F.lit("_"), nth.cast("string"))).otherwise(name)

    return named.select("fichier", "entete", F.transform("_n", unique).alias("noms"))


def apply_header(raw: DataFrame, headers: DataFrame) -> DataFrame:
    """Data rows under their normalised header names, empty rows dropped, one pass for all layouts.

    Headers stay a table and are joined to their files, however many layouts there are; the driver learns the names
    of the result's columns and nothing else. Columns stand in the order of their first position in any file. A row takes
    the cell at the place of the name in its own header.
    """
    heads = header_names(raw, headers)
    names = heads.select(F.posexplode("noms").alias("at", "nom")).groupBy("nom").agg(F.min("at").alias("at"))
    columns = [r["nom"] for r in names.orderBy("at", "nom").collect()]
    cells = F.map_from_arrays("noms", F.transform("noms", lambda _, i: F.get("cellules", i)))
    return (
        raw.join(heads, "fichier")
        .where(F.col("ligne") > F.col("entete"))
        .where(F.exists("cellules", lambda c: F.coalesce(F.trim(c) != "", F.lit(False))))
        .select("fichier", "ligne", cells.alias("_m"))
        .select("fichier", "ligne", *[F.element_at("_m", F.lit(n)).alias(n) for n in columns])
    )


# ---------------------------------------------------------------- sinks


def write_partitioned(df: DataFrame, path: str, by: str = "annee", mode: str = "overwrite") -> None:
    """One folder per year; with dynamic overwrite only the years present are replaced.

    Rows are rebalanced by year: small years share a task, a large one is split over many, each
    writing files of the advisory size.
    """
    df.hint("rebalance", F.col(by)).write.partitionBy(by).option("partitionOverwriteMode", "dynamic").mode(
        mode
    ).parquet(path)


def write_monthly_split(df: DataFrame, path: str, col: str = "periode") -> None:
    write_partitioned(df, path, col)


def write_report_csv(df: DataFrame, path: str, most: int = REPORT_ROWS) -> None:
    """Small aggregated report as one CSV file with a header; more than ``most`` rows are refused."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"a report has {most} rows at most; write larger tables with write_bounded_parts")
    df.coalesce(1).write.option("header", True).mode("overwrite").csv(path)


def write_bounded_parts(df: DataFrame, path: str, rows: int = 1_000_000, fmt: str = "parquet") -> None:
    """No output file holds more than ``rows`` rows."""
    df.write.option("maxRecordsPerFile", rows).option("header", True).mode("overwrite").format(fmt).save(path)


def verify_load(spark: SparkSession, path: str) -> DataFrame:
    """Row count and first and last period of what was written."""
    return spark.read.parquet(path).agg(
        F.count("*").alias("lignes"), F.min("periode").alias("premiere"), F.max("periode").alias("derniere")
    )


# ---------------------------------------------------------------- versions


def _folder(spark: SparkSession, path: str):
    """A path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    folder, fs = _folder(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())


def current_version(spark: SparkSession, base: str) -> int | None:
    """The version readers take: the last one published."""
    return max(_numbers(spark, f"{base}/_published", ""), default=None)


def read_current(spark: SparkSession, base: str) -> DataFrame:
    version = current_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {base}")
    return spark.read.parquet(f"{base}/version={version}")


def publish_version(df: DataFrame, base: str, check: Callable[[DataFrame], bool] | None = None, keep: int = 2) -> int:
    """Write a new version beside the others, verify it, publish it; returns its number.

    What is read back must have the rows that were written and pass ``check``. Publishing creates one marker file that no
    other writer can have created, so it happens whole or not at all: after a failure readers stay with the version
    before, and of two writers of one number the second fails. The last ``keep`` published versions stay.
    """
    spark = df.sparkSession
    number = 1 + max([*_numbers(spark, base, "version="), current_version(spark, base) or 0])
    path = f"{base}/version={number}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    loaded = spark.read.parquet(path)
    if loaded.count() != seen.get["rows"] or (check is not None and not check(loaded)):
        raise ValueError(f"version {number} of {base} is not published: what was written does not verify")
    marker, fs = _folder(spark, f"{base}/_published/{number}")
    fs.create(marker, False).close()
    kept = _numbers(spark, f"{base}/_published", "")[-keep:]
    for old in _numbers(spark, base, "version="):
        if old < kept[0]:
            for gone in (f"{base}/_published/{old}", f"{base}/version={old}"):
                fs.delete(_folder(spark, gone)[0], True)
    return number


# ---------------------------------------------------------------- incremental


def append_new_periods(base: DataFrame, new: DataFrame, period: str = "periode") -> DataFrame:
    """Base plus the rows of periods after its last one; missing columns become NULL."""
    last = base.agg(F.coalesce(F.max(period), F.lit(0))).scalar()
    return base.unionByName(new.where(F.col(period) > last), allowMissingColumns=True)


def select_period_range(df: DataFrame, first: int, last: int, period: str = "periode") -> DataFrame:
    return df.where(F.col(period).between(first, last))


def with_period(df: DataFrame, source: str = "mois_annee") -> DataFrame:
    year, month = period_parts(source)
    return df.withColumn("periode", period_int(year, month))


def sample(df: DataFrame, key: list[str], n: int, period: int | None = None, seed: int = 1) -> DataFrame:
    """Repeatable sample of n rows, of one period if given."""
    return sample_rows(df if period is None else df.where(F.col("periode") == period), key, n, seed)
