"""The registered corpus queries, each over its whole table, and their SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paypanel.llm import (
    bpe,
    decontamination,
    exact_dedup,
    html_extraction,
    jaccard_join,
    language,
    licenses,
    pii,
    sharding,
    spelling,
    toxicity,
    whitening,
    word_bpe,
)
from paypanel.llm.tables import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.report(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.report(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_sharding,
        op3_licenses,
        op4_language,
        op5_bpe,
        op6_exact_dedup,
        op7_html,
        op8_decontamination,
        op9_toxicity,
        op10_jaccard_join,
        op11_whitening,
        op12_spelling,
        op13_word_bpe,
    )
}
ORACLES: dict[str, str] = {
    "op1_pii": pii.ORACLE,
    "op3_licenses": licenses.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op10_jaccard_join": jaccard_join.ORACLE,
    "op12_spelling": spelling.ORACLE,
}
