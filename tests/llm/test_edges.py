"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paypanel.llm import (
    bpe,
    decontamination,
    exact_dedup,
    html_extraction,
    jaccard_join,
    language,
    licenses,
    pii,
    queries,
    sharding,
    toxicity,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, key string, digest string, n string, uid string"
WORDS = "the quick brown fox jumps over the lazy dog while seven large wizards juggle boxing gloves near old stone walls".split()
LONG = " ".join(WORDS[i * 7 % len(WORDS)] + str(i % 911) for i in range(30_000))
ROWS = [
    (1, "Plain words in one short text.", "en"),
    (2, "Plain words in one short text.", "en"),
    (2, "Plain words in one short text.", "en"),
    (3, None, None),
    (None, "a text without an id", "en"),
    (4, "", "en"),
    (5, LONG, None),
    (6, "!!! 123 ???", "fr"),
    (None, None, None),
]


def frame(spark, tmp_path, rows, name="d"):
    data = [(i, t, la, "s", None, "k", "x", "y", "z", "u") for i, t, la in rows]
    path = f"{tmp_path}/{name}"
    spark.createDataFrame(data, DOCS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def docs(spark, tmp_path):
    return frame(spark, tmp_path, ROWS)


@pytest.fixture
def empty(spark, tmp_path):
    return frame(spark, tmp_path, [], "e")


ITEMS = "item_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def reports(spark):
    import public_tokenizers

    items = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (3, " ".join(WORDS), "s")], ITEMS)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (None, 1, 1), (5, None, None)], LABELS)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return {
        "pii": pii.report,
        "sharding": sharding.report,
        "licenses": licenses.report,
        "language": language.report,
        "bpe": lambda d: bpe.report(d, ranks),
        "exact_dedup": exact_dedup.report,
        "decontamination": lambda d: decontamination.report(d, items),
        "toxicity": lambda d: toxicity.report(d, labels),
        "jaccard_join": jaccard_join.report,
    }


NAMES = list("pii sharding licenses language bpe exact_dedup decontamination toxicity jaccard_join".split())


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, docs, name):
    got = reports(spark)[name](docs).collect()
    assert len(got) == (0 if name == "decontamination" else len(ROWS))


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, empty, name):
    assert reports(spark)[name](empty).collect() == []


def test_null_text_values(spark, docs):
    null_text = [r for r in exact_dedup.report(docs).collect() if r.doc_id in (3, 4)]
    assert {(r.keep_id, r.group_size) for r in null_text} == {(4, 3)}  # null counts as empty; the largest id stays
    twice = [r.kept for r in exact_dedup.report(docs).collect() if r.doc_id == 2]
    assert sorted(twice) == [False, True]  # of repeated rows exactly one stays
    assert {r.lang_pred for r in language.report(docs).collect() if r.doc_id in (3, 4, 6)} == {"und"}
    sizes = {r.doc_id: r.size for r in sharding.report(docs).collect()}
    assert sizes[3] == 8 and sizes[4] == 8 and sizes[5] == len(LONG) + 8
    sets = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.report(docs).collect() if r.doc_id in (1, 2, 3, 4)}
    assert sets == {(1, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4)}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, sf, docs, name, stage):
    out = stage(spark, docs, sf)
    rows = out.collect()
    assert rows
    if name != "bpe":
        assert out.columns == docs.columns
        assert set(rows) <= set(docs.collect())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_an_empty_table(spark, sf, empty, name, stage):
    assert stage(spark, empty, sf).collect() == []


def test_pages(spark):
    pages = [(1, None, None), (2, "http://a/x", ""), (3, "http://a/y", "<p>" * 3000 + "deep"), (3, "http://a/y", "no markup &amp; all")]
    given = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_extraction.report(given).collect())
    assert got == [(1, "", 0), (2, "", 0), (3, "deep", 4), (3, "no markup & all", 15)]
    assert html_extraction.report(given.where("page_id > 9")).collect() == []


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, sf, name):
    from checks.compare import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    rel = con.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.collect(), df.columns) == rows_of(rel.fetchall(), rel.columns)
