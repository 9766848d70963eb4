"""Keyed pseudonyms of person identifiers.

The key comes from the caller and travels inside the pickled function only: it is no literal of
the plan, so it appears in no explain output, event log or query text.
"""

from __future__ import annotations

import hashlib
import hmac
import os
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_VARIABLE = "PAYPANEL_SECRET_KEY"


def key_from_environment(variable: str = KEY_VARIABLE) -> str:
    key = os.environ.get(variable)
    if not key:
        raise OSError(f"set {variable} to the pseudonym key")
    return key


def hmac_hex(value: str, key: str) -> str:
    return hmac.new(key.encode(), value.strip().encode(), hashlib.sha256).hexdigest()


def pbkdf2_hex(value: str, key: str, iterations: int) -> str:
    return hashlib.pbkdf2_hmac("sha256", value.strip().encode(), key.encode(), iterations).hex()


def _vectorised(one: Callable[[str], str]) -> Callable[[Column], Column]:
    def run(ids: pd.Series) -> pd.Series:
        return ids.map(lambda v: None if v is None else one(v))

    return F.pandas_udf(run, "string")


def hmac_id(c: Column | str, key: str) -> Column:
    return _vectorised(lambda v: hmac_hex(v, key))(F.col(c) if isinstance(c, str) else c)


def pbkdf2_id(c: Column | str, key: str, iterations: int = 100_000) -> Column:
    return _vectorised(lambda v: pbkdf2_hex(v, key, iterations))(F.col(c) if isinstance(c, str) else c)


def id_mapping(df: DataFrame, key_col: str, secret: str, iterations: int | None = None) -> DataFrame:
    """(original, pseudonyme) of the distinct, trimmed, non-blank ids; each id is hashed once."""
    ids = df.select(F.trim(F.col(key_col).cast("string")).alias("original")).where(F.col("original") != "").distinct()
    hashed = hmac_id("original", secret) if iterations is None else pbkdf2_id("original", secret, iterations)
    return ids.withColumn("pseudonyme", hashed)


def collisions(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("pseudonyme").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def apply_ids(df: DataFrame, mapping: DataFrame, key_col: str, keep: bool = False) -> DataFrame:
    """Replace ids by their pseudonyms; ids outside the mapping get NULL."""
    out = (
        df.withColumn("_id", F.trim(F.col(key_col).cast("string")))
        .join(mapping.withColumnRenamed("original", "_id"), "_id", "left")
        .drop("_id")
    )
    return out if keep else out.drop(key_col)


def missing_ids(df: DataFrame, mapping: DataFrame, key_col: str) -> DataFrame:
    joined = apply_ids(df, mapping, key_col, keep=True)
    return joined.agg(F.count("*").alias("lignes"), F.count_if(F.col("pseudonyme").isNull()).alias("sans_pseudonyme"))
