"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Language ID drops rows without any letters; exact dedup keeps one row of equal texts; the Jaccard join keeps one
document of each group of near copies (five-word shingles, similarity 0.8); decontamination drops documents that
hold benchmark questions; encoding returns the tokens. All but the last return the columns of their input. A stage
reads ``docs`` from files, as ``run`` and the check tool hand them over.

Each stage's defined results for nulls, empty or very long texts, ties, repeated rows, empty tables and clashing
column names are those of its operator.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paypanel.llm import bpe, decontamination, exact_dedup, jaccard_join, language
from paypanel.llm.tables import table
from paypanel.plans.stages import few_rows_sent, shared_dir, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.encode(docs, ranks, {"doc_id": F.col("doc_id")}).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")
    with few_rows_sent(spark):
        return written(tokens, "tokens")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: SQL states neither the trained language model nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
