"""Table helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted rows, at the stated width, stay under this many bytes.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hinted(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size allows it; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` with a hint that its join is by exchange and sort: Spark's estimate, from the size of files, is not asked."""
    return df.hint("merge")
