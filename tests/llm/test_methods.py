"""Each operator against brute force, a round trip, or held-out accuracy."""

import hashlib
import html
import itertools
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
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
from paypanel.llm.expressions import prefix_sums

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )


def one(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_prefix_sums(spark):
    lists = [[], [5], list(range(100)), [1] * 17]
    got = spark.createDataFrame([(x,) for x in lists], "a array<int>").select(prefix_sums(F.col("a")).alias("s")).collect()
    assert [r.s for r in got] == [list(itertools.accumulate(x)) for x in lists]


# --- personal data


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(hit):
    d = [int(c) for c in re.sub(r"\D", "", hit)][::-1]
    return 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def base_spans(text):
    keep = {
        "email": lambda h: True,
        "ip": lambda h: all(int(p) <= 255 for p in h.split(".")),
        "card": luhn,
        "phone": lambda h: 9 <= len(re.sub(r"\D", "", h)) <= 15,
    }
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text) if keep[k](m.group())]


def test_pii_against_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["a@b.co", "_x@y.zz", "1.2.3.4", ".5", "256.1.1.1", "001.2.3.4", "4111 1111 1111 1111", "-", " ", "+49 (30) 123456-7"]
    parts += ["é", "🙂", "@", "+", "4785380592391139", "5", "GB82 WEST 1234 5698 7654 32", "\n", "x.y", "٣"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    got = {r.doc_id: r for r in pii.report(one(spark, texts)).collect()}
    for i, text in enumerate(texts):
        spans = base_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
        assert set(spans) <= set(got[i].spans.split(","))


def test_pii_method_spans_and_long_runs(spark):
    texts = ["iban GB82 WEST 1234 5698 7654 32 ok", "GB83 WEST 1234 5698 7654 32", "ssn 123-45-6789", "123-45-6789", "7" * 200_000]
    got = {r.doc_id: r for r in pii.find_pii(one(spark, texts)).withColumnRenamed("id", "doc_id").collect()}
    assert [s.hit for s in got[0].iban] == ["GB82 WEST 1234 5698 7654 32"] and got[0].iban[0].score == 1.0
    assert got[1].iban == [] and len(got[2].ssn) == 1 and got[3].ssn == [] and got[4].card == []


def test_ibans_end_where_their_country_says(spark):
    de, gb = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    texts = [f"{de} BIC COBADEFF", f"{de} OK BYE", f"{de.replace(' ', '')} {gb}", f"PAY TO {gb} 12 TODAY", "DE88 3704 0044 0532 0130 00 OK"]
    got = {r.id: [s.hit for s in r.iban] for r in pii.find_pii(one(spark, texts)).collect()}
    assert got == {0: [de], 1: [de], 2: [de.replace(" ", ""), gb], 3: [gb], 4: []}


# --- shards


@pytest.mark.parametrize("hot", [0, 900])
def test_shards_are_near_equal_and_gapless(spark, hot):
    rng = random.Random(5)
    texts = ["same text everywhere" * 9] * hot + ["w" * rng.randint(0, 400) + str(i) for i in range(1_500)]
    got = sharding.shard(
        one(spark, texts).select("doc_id", sharding.digest63(F.col("text")).alias("d"), sharding.size_of(F.col("text")).alias("size")),
        "doc_id",
        "d",
        "size",
        shards=7,
    ).collect()
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    assert len(got) == len(texts)
    for s in range(7):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
        assert abs(sum(r.size for r in got if r.shard == s) - total / 7) <= 2 * largest + total * 0.002


# --- licences


def test_license_rules(spark):
    assert len(licenses.RULES) > 300
    texts = [
        "Released under the MIT License.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "gnu general public license version 3, all rights reserved; CC-BY 4.0",
        "a gem and a mitten",
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
    ]
    got = {r.doc_id: r for r in licenses.report(one(spark, texts)).collect()}
    assert got[0].labels == "mit" and got[0].n_base == 0 and got[0].score == 0.95
    assert "gpl-3.0" in got[1].labels.split(",")
    assert got[2].base_labels == "cc-by,gpl,reserved" and (got[2].first_word, got[2].last_word, got[2].n_base) == (1, 9, 3)
    assert got[3].labels == "" and got[3].score == 0.0
    assert "apache-2.0" in got[4].labels.split(",")


# --- language


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = [r for r in language.report(docs).collect() if r.held_out]
    assert len(got) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) / len(got) > 0.97


def test_mixture_names_both_languages():
    counts = np.zeros((language.BUCKETS, 2))
    text = {0: "the house is on the hill " * 40, 1: "das haus liegt auf einem berg " * 40}
    for k, t in text.items():
        for _, _, _, bucket, n in language.gram_counts([t]):
            counts[bucket, k] += n
    model = language.Model(["en", "de"], counts)
    for _, _, doc, bucket, n in language.gram_counts([text[0], text[0] + text[1], "the"]):
        _, share = language.infer(model, doc, bucket, n)
        assert share[0].tolist() == [1.0, 0.0] and 0.3 < share[1][0] < 0.7 and share[2].argmax() == 0


def test_long_texts_count_like_short_ones(monkeypatch):
    text = "some words über alles " * 500
    whole = [(b.tolist(), n.tolist()) for _, _, _, b, n in language.gram_counts([text])]
    monkeypatch.setattr(language, "CHUNK", 1000)
    bucket, n = [(b, n) for _, _, _, b, n in language.gram_counts([text])][0]
    assert set(bucket.tolist()) >= set(whole[0][0]) and abs(int(n.sum()) - sum(whole[0][1])) <= 2 * len(text) // 1000


# --- encoding


def test_encoding_equals_the_library(spark, encoding):
    rng = random.Random(1)
    pieces = ["'s", "'re", "'ll", "'", "s", " ", "  ", "\n", "\t", " ", "é", "1", "²", "!", "漢", "🙂", "'T", "abc", "re", "́", "\x1c"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(3_000)] + ["a" * 2_000, " " * 2_000, ""]
    got = {r.doc_id: r for r in bpe.encode(one(spark, texts), RANKS, {"doc_id": F.col("doc_id")}).collect()}
    for i, t in enumerate(texts):
        ids = encoding.encode_ordinary(t)
        assert got[i].ids == ids and got[i].decoded == t and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


# --- exact copies


def test_weak_digest_still_gives_exact_classes(spark):
    texts = ["a", "b", "a", "c", "b", "d", "a"]
    docs = one(spark, texts)
    weak = lambda t: F.unhex(F.lit("00"))  # noqa: E731  every text collides
    got = exact_dedup.dedup(docs, digest=weak, locator=F.struct(F.col("doc_id").alias("row"))).collect()
    want = {i: (max(j for j, u in enumerate(texts) if u == t), texts.count(t)) for i, t in enumerate(texts)}
    assert {r.id: (r.winner.id, r.group_size) for r in got} == want


def test_state_goes_on_with_later_files(spark, tmp_path):
    def land(n, rows):
        frame = spark.createDataFrame(rows, "id long, locator string, digest binary")
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        return frame.schema

    schema = land(1, [(1, "x", b"p"), (2, "y", b"q")])
    first = exact_dedup.digest_state(spark, f"{tmp_path}/in", schema, f"{tmp_path}/state").collect()
    assert {bytes(r.digest): (r.winner.id, r.group_size) for r in first} == {b"p": (1, 1), b"q": (2, 1)}
    land(2, [(7, "z", b"p")])
    second = exact_dedup.digest_state(spark, f"{tmp_path}/in", schema, f"{tmp_path}/state").collect()
    assert {bytes(r.digest): (r.winner.id, r.group_size) for r in second} == {b"p": (7, 2), b"q": (2, 1)}


# --- pages


def test_pages_against_the_article(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}

    def brute(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = [re.sub(r"<[^>]+>", "", re.sub(r"<br>", " ", b)) for b in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
        return "\n\n".join(t for t in (" ".join(html.unescape(b).split()) for b in parts) if t)

    got = queries.op7_html(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == brute(pages[r.page_id]) and r.n_chars == len(r.text)


def test_host_votes_decide(spark):
    body = "<div class='c1'><p>{}</p></div><div class='extra'><p>{}</p></div><div class='comments'><p>nice post</p></div>"
    pages = [(i, f"http://h/{i}", body.format("long words here " * 20, "short")) for i in range(5)]
    pages.append((9, "http://h/9", body.format("tiny", "much longer block than the other one " * 9)))
    got = {r.page_id: r for r in html_extraction.report(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[9].text == "tiny" and "nice post" not in got[0].text
    assert got[0].host_path.endswith("div.c0")


# --- benchmark questions


def test_questions_with_other_numbers_and_names(spark):
    item = "Alice bought 12 red apples and 7 green pears at the market before she walked 3 miles back to her house with Bob"
    swapped = item.replace("Alice", "Maria").replace("12", "40").replace("7", "9").replace("3 miles", "8 km").replace("Bob", "Tom")
    broken = item.replace("12", "5").replace("7", "5")  # two numbers of the item become one
    filler = "some other words that mean nothing at all but fill the line "
    texts = [filler + item + " " + filler, filler * 2 + swapped, filler + broken, filler * 5, "Alice Bob Maria Tom Ann Eve " * 5]
    items = spark.createDataFrame([(1, item), (2, "too short")], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.report(one(spark, texts), items).collect()}
    assert set(got) == {0, 1} and got[0].n_changed == 0 and got[1].n_changed >= 3


def test_contained_items_are_found(spark):
    sf = "/root/testdata/sf0.01"
    want = set(
        duckdb.sql(
            f"SELECT doc_id, item_id FROM '{sf}/documents.parquet' d JOIN '{sf}/benchmark.parquet' b ON contains(d.text, b.text)"
        ).fetchall()
    )
    got = {(r.doc_id, r.item_id) for r in queries.op8_decontamination(spark, sf).collect()}
    assert got == want


def test_items_in_another_case_are_found(spark):
    item = "Alice bought 12 red apples and 7 green pears at the market before she walked 3 miles back to her house with Bob"
    filler = "some other words that mean nothing at all but fill the line "
    texts = [(filler + form + " " + filler) for form in (item.upper(), item.lower(), item.title())]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.report(one(spark, texts), items).collect()}
    assert set(got) == {0, 1, 2} and all(r.n_changed == 0 for r in got.values())


def test_items_contained_in_any_case_are_found(spark):
    sf = "/root/testdata/sf0.1"
    plain = "' ' || trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
    want = set(
        duckdb.sql(
            f"SELECT doc_id, item_id FROM (SELECT doc_id, {plain.format('text')} AS x FROM '{sf}/documents.parquet') "
            f"JOIN (SELECT item_id, {plain.format('text')} AS y FROM '{sf}/benchmark.parquet') ON contains(x, y)"
        ).fetchall()
    )
    got = {(r.doc_id, r.item_id) for r in queries.op8_decontamination(spark, sf).collect()}
    assert want and want <= got


@pytest.mark.parametrize("phase", range(3))
def test_edited_items_are_found_at_every_place(spark, phase):
    words = "which of these small animals is known to sleep through most of the cold winter months in a burrow".split()
    half = len(words) // 2
    edits = [words[:half] + ["really"] + words[half:], words[:half] + words[half + 1 :], words[:half] + ["zz"] + words[half + 1 :]]
    texts = [" ".join(["zq"] * (2 * phase + 1) + edit + ["zr"] * 9) for edit in edits]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert {r.doc_id for r in decontamination.report(one(spark, texts), items).collect()} == {0, 1, 2}


def test_verbatim_runs_need_no_slots_and_one_phrase_is_no_proof(spark):
    long = "the train leaves at 9 and " + " ".join(f"word{c}x" for c in "abcdefghijklmnopqrstuvwxyzabcdefghijklmn") + " it arrives at 9 in the evening"
    names = "Anna Berta Carla Dora Emma Frida Gerda Hanna Ida Julia Klara Lena"
    short = "which of the following is the largest planet of all"
    filler = " zq" * 7 + " "
    texts = [filler + long[::-1].replace("9", "8", 1)[::-1] + filler, filler + names + filler, "zq " * 6 + "which of the following is the best answer here" + filler]
    items = spark.createDataFrame([(1, long), (2, names), (3, short + " known")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.report(one(spark, texts), items).collect()} == {(0, 1), (1, 2)}


# --- toxicity


def test_toxicity_on_rows_left_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    model = toxicity.learn(docs, labels.where(~left_out), sample=1_000)
    assert np.all(np.diff(model.cuts) > 0)
    truth = {r.doc_id: r.toxic for r in labels.where(left_out).collect()}
    got = [r for r in toxicity.predict(docs, model).collect() if r.doc_id in truth]
    toxic = [r for r in got if truth[r.doc_id]]
    clean = [r for r in got if not truth[r.doc_id]]
    # measured: 0.81 of the toxic rows left out; many of the others hold no word that tells (see README)
    assert sum(r.toxic for r in toxic) / len(toxic) > 0.75 and sum(r.toxic for r in clean) / len(clean) < 0.01
    assert np.mean([r.expected_severity for r in toxic]) > 1 > np.mean([r.expected_severity for r in clean])


# --- near copies


def test_levels_cover_every_pair_of_sizes():
    for rule in (jaccard_join.Rule(), jaccard_join.QUERY_RULE):
        for b in range(1, 400):
            for a in range(-(-b * rule.low // rule.high), b + 1):
                shared = set(jaccard_join.levels(a, rule)) & set(jaccard_join.levels(b, rule))
                assert any(blocks > rule.difference(a + b) for _, blocks in shared), (a, b)


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(7)
    for _ in range(50):
        x = rng.integers(0, 1 << 63, 300, np.uint64)
        y = np.concatenate((x[: rng.integers(0, 300)], rng.integers(0, 1 << 63, 40, np.uint64)))
        for blocks in (1, 5, 60):
            bits = sum(int(v).bit_count() for v in jaccard_join.sketch(np.unique(x), blocks) ^ jaccard_join.sketch(np.unique(y), blocks))
            assert bits <= len(set(x.tolist()) ^ set(y.tolist()))


@pytest.mark.parametrize("before, copies", [(0, 12), (3, 12), (0, 70), (3, 70)])
def test_components_against_brute_force(spark, monkeypatch, before, copies):
    monkeypatch.setattr(jaccard_join, "BEFORE", before)
    monkeypatch.setattr(jaccard_join, "SMALL_KEY", before + 2)
    rng = random.Random(11)
    texts = []
    for _ in range(6):
        words = [f"w{rng.randint(0, 10_000)}" for _ in range(rng.choice([3, 8, 40, 150]))]
        for _ in range(copies):
            copy = list(words)
            for _ in range(rng.randint(0, 4) if copies < 20 else int(rng.paretovariate(0.8)) % 30):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 40 if rng.random() < 0.3 else 10_000)}"
            texts.append(" ".join(copy))
    rule = jaccard_join.QUERY_RULE

    def grams(t):
        w = t.split()
        return {tuple(w[i : i + rule.width]) for i in range(max(1, len(w) - rule.width + 1))}

    sets = [grams(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, j in itertools.combinations(range(len(texts)), 2):
        if rule.high * len(sets[i] & sets[j]) >= rule.low * len(sets[i] | sets[j]):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.report(one(spark, texts)).collect()}
    assert got == {i: (len(s), root(i)) for i, s in enumerate(sets)}


# --- the pipeline


def test_pipeline_end_to_end(spark, sf, encoding):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    texts = [docs[i] for i in got]
    assert len(set(texts)) == len(texts) and 0 < len(got) < len(docs)
    for i, r in got.items():
        assert r.ids == encoding.encode_ordinary(docs[i])
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(item in docs[i] for i in got for item in items)
    # every document that went has a reason: a copy or near copy that stayed, a benchmark question, or no letters
    grams = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in docs.items() for w in [t.lower().split()]}
    for i in set(docs) - set(got):
        near = any(len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]) for j in docs if j != i)
        assert near or any(item in docs[i] for item in items) or not any(c.isalpha() for c in docs[i])
