"""Whitening, spelling variants and the distinct-word encoder against brute force and the tokenizer library."""

import random
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paypanel.llm import bpe, decontamination, jaccard_join, language, pii, spelling, whitening, word_bpe
from paypanel.plans import stages

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CLASH = {"index": "i", "place": "p", "word": "w", "block": "b", "n": "n", "key": "k"}


def clashing(df):
    return df.withColumns({name: F.lit(v) for name, v in CLASH.items()})


# --- whitening


def vectors(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


def check_whitened(got, rows, k):
    usable = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = np.floor(1024 * np.array([v for _, v in usable], np.float32).astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    values, axes = np.linalg.eigh(np.cov((x - s / n).T, bias=True))
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    want = (x - s / n) @ axes / np.sqrt(values)
    rows_of = sorted((r.vec_id, r.component, r.whitened, r.deviation) for r in got)
    assert [(a, b) for a, b, _, _ in rows_of] == sorted((i, c + 1) for i, _ in usable for c in range(k))
    order = sorted(range(n), key=lambda j: usable[j][0])
    found = np.array([r[2] for r in rows_of]).reshape(n, k)
    signs = np.sign((found * want[order]).sum(0))
    assert np.allclose(found * signs, want[order], atol=1e-7)
    assert [r[3] for r in rows_of[::k]] == [int(((n * x[j].astype(object) - s) ** 2).sum()) for j in order]
    assert {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-6
    by = {r.component: r.explained for r in got}
    total = np.cov((x - s / n).T, bias=True).trace()
    assert np.allclose([by[c + 1] for c in range(k)], values / total, rtol=1e-9)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 12)) @ np.diag(np.linspace(2, 0.1, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[0].tolist()) for i in range(150)]
    rows += [(2000, None), (2001, [None] + [0.0] * 11), (2002, [float("nan")] + [0.0] * 11), (2003, [float("inf")] + [0.0] * 11)]
    got = whitening.report(vectors(spark, rows)).collect()
    check_whitened(got, rows, 8)
    # small blocks and several panels give the same
    parts = whitening.whiten(vectors(spark, rows), block_rows=32, panel_blocks=4).withColumnRenamed("id", "vec_id").collect()
    check_whitened(parts, rows, 8)


def test_whitening_odd_tables(spark):
    assert whitening.report(vectors(spark, [])).collect() == []
    assert whitening.report(vectors(spark, [(1, None)])).collect() == []
    assert whitening.report(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # no variance
    few = [(None, [0.0, 1.0]), (1, [1.0, 0.5]), (1, [3.0, 0.0]), (2, [5.0])]  # another length is left out
    got = whitening.report(vectors(spark, few)).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == [("1", 1), ("1", 1), ("1", 2), ("1", 2), ("None", 1), ("None", 2)]
    assert got[0].identity_error < 1e-9


# --- spelling variants


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_groups(counts):
    near = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if abs(len(a) - len(b)) < 2 and edits(a, b) == 1:
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("letters, size", [("ab", 7), ("abcé", 6), ("abcdefgh", 8)])
def test_variants_against_all_pairs(spark, letters, size):
    rng = random.Random(size)
    counts = {"".join(rng.choice(letters) for _ in range(rng.randrange(4, size + 1))): rng.randrange(1, 60) for _ in range(300)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(words).collect()}
    assert got == brute_groups(counts)


def test_long_chain_of_forms(spark):
    counts = {"x" * 6 + "abcdefghij"[:k] + "z" * 6: 2 ** (k + 1) for k in range(11)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(words).collect()}
    assert got == brute_groups(counts)
    assert {r[2] for r in got} == {"xxxxxxabcdefghijzzzzzz"}


def brute_words(docs):
    found = Counter()
    for i, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        run = ""
        for c in low + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 97 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                found[run] += 1
            run = ""
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def test_words_of_odd_texts(spark):
    rng = random.Random(5)
    stock = ["Élan", "straße", "HOUSES", "ÀÉÎàéî", "four", "naïve", "Naïve", "a" * 9, "b×c÷d", "x" * 3000]
    docs = [(rng.choice([None, k]), " ".join(rng.choice(stock) for _ in range(40))) for k in range(60)]
    docs += [(1, None), (1, ""), (2, "houses-houses houses2houses"), (2, "houses-houses houses2houses")]
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {r.word: r.n for r in spelling.counted_words(df).collect()}
    assert got == brute_words(docs)
    assert len(spelling.report(df).collect()) == len(got)
    assert spelling.report(df.where("doc_id > 99")).collect() == []


# --- encoding by distinct words


def encoded(spark, texts):
    df = clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return {r.doc_id: (r.ids, r.decoded) for r in word_bpe.encode(df, VOCABULARY, {"doc_id": F.col("doc_id")}).collect()}


def by_library(texts):
    library = Tokenizer.from_file(VOCABULARY)
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    return {k: (x, library.decode(x, skip_special_tokens=False)) for k, x in enumerate(ids)}


def test_words_equal_the_library(spark):
    rng = random.Random(1)
    texts = [None, "", "a<|endoftext|>b", "  <|endoftext|>  !!<|endoftext|>", "<|endoftext|><|endoftext|>", " <|endo", "'s I'LL it's ''re"]
    stock = list(" \n\t\r'slremdvt!?1²½äЖ中🙂") + ["́", "\u0085", "​", "　", "\x1c", "\xa0", "<|endoftext|>"]
    texts += ["".join(rng.choice(stock) for _ in range(rng.randrange(60))) for _ in range(300)]
    every = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(f"a{c}a {c} 1{c}" for c in every[k : k + 1000]) for k in range(0, len(every), 1000)]
    assert encoded(spark, texts) == by_library(texts)


def test_long_words_and_small_blocks(spark, monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefghijklmnop") for _ in range(100_000)), "ha" * 20_000, "many words " * 5000, None, "x"] * 2
    assert encoded(spark, texts) == by_library(texts)


def test_blocks_are_cut(monkeypatch):
    import pyarrow as pa

    class Task:
        @staticmethod
        def partitionId():
            return 3

    monkeypatch.setattr(word_bpe.TaskContext, "get", lambda: Task)
    monkeypatch.setattr(word_bpe, "BLOCK_CHARS", 10)
    lists = [["ab", "cd"], [], ["ab"] * 30, ["e"], ["f", "ab"], []]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(lists, pa.list_(pa.string()))], names=["doc_id", "_words"])
    out = pa.Table.from_batches(word_bpe.numbering_task(iter([batch.slice(0, 4), batch.slice(4)]))).to_pylist()
    words = {r["block"]: r["words"] for r in out if r["words"] is not None}
    assert len(words) > 1
    back = {r["doc_id"]: [words[r["block"]][k] for k in word_bpe.unpacked(r["places"], r["n_words"])] for r in out if r["words"] is None}
    assert back == dict(enumerate(lists))


def test_encoding_odd_tables(spark):
    assert encoded(spark, []) == {}
    assert encoded(spark, [None, ""]) == {0: ([], ""), 1: ([], "")}


def test_numbered_texts_are_not_exchanged(spark):
    df = spark.createDataFrame([(k, f"text {k % 7} of many") for k in range(50)], "doc_id long, text string")
    out = word_bpe.encode(df, VOCABULARY, {"doc_id": F.col("doc_id")}, with_values=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanged) == 1  # the encoded words alone
    assert "Bucketed: true" in plan and out.count() == 50
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("word_places")]


def test_words_are_merged_once_and_handed_to_every_place():
    import pyarrow as pa

    vocabulary = word_bpe.read_vocabulary(VOCABULARY)
    rows = [(" words", b, n) for b, n in ((1, 5), (0, 2), (1, 0))] + [("xyzzy", 0, 1), ("<|endoftext|>", 1, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["word", "block", "number"])
    out = pa.Table.from_batches(word_bpe.merging_task(vocabulary)(iter([batch.slice(0, 2), batch.slice(2)]))).to_pylist()
    library = Tokenizer.from_file(VOCABULARY)
    got = {}
    for r in out:
        numbers = word_bpe.unpacked(r["numbers"], r["n"]).cumsum()
        ids, ends = word_bpe.unpacked(r["ids"], r["n_ids"]).tolist(), word_bpe.unpacked(r["sizes"], r["n"]).cumsum().tolist()
        got |= {(r["block"], int(k)): ids[a:b] for k, a, b in zip(numbers, [0, *ends], ends)}
    assert got == {(b, n): library.encode(w, add_special_tokens=False).ids for w, b, n in rows}


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):
        word_bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_decoding_joins_pieces(spark):
    vocabulary = word_bpe.read_vocabulary(VOCABULARY)
    library = Tokenizer.from_file(VOCABULARY)
    rows = [(k, library.encode(t, add_special_tokens=False).ids) for k, t in enumerate(["Grüße, 世界!", "plain", "<|endoftext|>x"])]
    rows.append((9, [15339, 99_999]))  # the vocabulary does not have the second
    got = {r.key: bytes(r.decoded).decode() for r in word_bpe.decode(spark.createDataFrame(rows, "key long, ids array<int>"), vocabulary, "key").collect()}
    assert got == {k: library.decode(ids, skip_special_tokens=False) for k, ids in rows}


# --- the language stage


def test_without_labels_only_letterless_rows_go(spark):
    rows = [(1, "plain English words", None), (2, "123 !!", None), (3, None, None), (4, "日本", None), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in language.keep_identified(docs).collect()) == [1, 4]


def test_language_stage_sends_each_text_once_and_hands_on_few_rows(spark):
    import pyarrow as pa

    rows = [(k, "some plain words" if k % 3 else "12 34", "en" if k % 2 else "de") for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [r for r in rows if r[0] % 3]
    assert "_text" not in kept._jdf.queryExecution().executedPlan().toString()
    model = language.learn(docs)
    batch = pa.RecordBatch.from_pylist([dict(zip(docs.columns, r)) for r in rows])
    assert max(b.num_rows for b in language.keeper(model, 1)(iter([batch]))) <= language.ROWS


# --- memory of tasks


def test_few_rows_are_sent_to_python(spark, tmp_path, monkeypatch):
    def sizes(batches):
        yield from (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)

    most = lambda: max(r.n for r in spark.range(3000).coalesce(1).mapInArrow(sizes, "n long").collect())
    with stages.few_rows_sent(spark):
        assert most() == stages.ROWS_SENT
    assert most() == 3000
    limit, seen = stages.ROWS_SENT, []

    def bounded(task):
        def made(rule):
            def run(batches):
                def checked():
                    for batch in batches:
                        assert batch.num_rows <= limit
                        yield batch

                yield from task(rule)(checked())

            seen.append(task)
            return run

        return made

    for name in ("sketch_task", "set_task"):
        monkeypatch.setattr(jaccard_join, name, bounded(getattr(jaccard_join, name)))
    texts = [(i, " ".join(f"w{i // 2}x{j}" for j in range(60 + i % 2))) for i in range(1400)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    got = {r.doc_id: r.component_id for r in jaccard_join.report(spark.read.parquet(f"{tmp_path}/docs")).collect()}
    assert got == {i: i - i % 2 for i in range(1400)} and len(seen) == 2


def test_words_go_when_no_task_asks_for_them(monkeypatch):
    monkeypatch.setattr(bpe, "IDLE", 0.2)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    with bpe.coder_of(ranks, "test") as first:
        pass
    with bpe.coder_of(ranks, "test") as second:
        time.sleep(0.6)
        assert second is first and bpe._CODERS
    time.sleep(1)
    assert not bpe._CODERS


def test_words_are_decoded_from_their_ids():
    coder = bpe.Coder(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    assert [d for _, d in bpe.encode_run(coder, ["plain words", ""])] == [b"plain words", b""] and not coder.decoded
    coder.decode_words = lambda words: [b"?"] * len(words)
    assert [d for _, d in bpe.encode_run(coder, ["other texts words"])] == [b"?? words"]


# --- context words of personal data


def test_common_words_outlive_a_full_cache(monkeypatch):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "KEPT", 12)
    coder, asked = bpe.Coder(ranks), []
    plain = coder.encode_words
    coder.encode_words = lambda words: asked.extend(words) or plain(words)
    for c in "abcdefghijkl":
        text = f"zzcommonqq zqjx{c}kk xqzw{c}vv qqy{c}zz"
        (ids, decoded), = bpe.encode_run(coder, [text])
        assert list(np.frombuffer(ids, np.int32)) == library.encode_ordinary(text) and decoded == text.encode()
        assert len(coder.known) <= 12 and len(coder.decoded) <= 12
    assert asked.count(b"zzcommonqq") == 1 and len(asked) == 1 + 3 * 12


@pytest.mark.parametrize(
    "text, spans",
    [
        ("the hotel 0123 4567 890 room", 0),
        ("the hôtel 0123 4567 890 room", 0),
        ("syntax 123-45-6789 error", 0),
        ("a" * 100 + "tel 0123 4567 890", 0),
        ("tel: 0123 4567 890", 1),
        ("Fax 0123 4567 890", 1),
        ("0123 4567 890 is the phone", 1),
        ("her SSN: 123-45-6789", 1),
    ],
)
def test_context_words_are_whole_words(spark, text, spans):
    row = pii.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_added == spans


def test_context_does_not_raise_scores_by_parts_of_words(spark):
    rows = [(1, "ship 10.0.0.1"), (2, "ip 10.0.0.1")]
    got = {r.doc_id: r.top_score for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] < got[2]


def test_long_unbroken_words_equal_the_library(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3_000)), "a" * 1_001, "ab" * 900 + "=" * 777, "".join(rng.choice("aAéß") for _ in range(3_000))]
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(ranks), special_tokens={})
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.encode(rows, ranks, {"doc_id": F.col("doc_id")}).collect()}
    for i, text in enumerate(texts):
        assert got[i].ids == library.encode_ordinary(text) and got[i].decoded == text


def test_both_forms_of_a_template_are_the_same(spark):
    texts = ["Alice paid $3.50 for 12 kg on 3rd May", "KM km 5km 5 km 1,000 7% x7 É été", "  (Bob), 'tis 4/5 Mile mile--", "", "…"]
    words = decontamination.raw_words(F.col("text"))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select(
        F.array_join(decontamination.template(words), " ").alias("each"), decontamination.template_text(F.array_join(words, " ")).alias("whole")
    )
    assert all(r.each == r.whole for r in rows.collect())


def test_short_items_match_whole_and_word_for_word(spark):
    item = "what is the capital city of sunny northern Portugal today"
    texts = ["zq " * 9 + item + " zr" * 9, "zq " * 9 + item.replace("Portugal", "Spain") + " zr" * 9, item.rsplit(" ", 1)[0] + " zr" * 9]
    items = spark.createDataFrame([(1, item), (2, "five words are no proof")], "item_id long, text string")
    got = decontamination.report(spark.createDataFrame(list(enumerate([*texts, "five words are no proof " * 3])), "doc_id long, text string"), items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(0, 1)}


def test_block_codes_tell_sets_apart():
    rng = np.random.default_rng(3)
    for _ in range(50):
        x = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
        y = np.append(x[3:], rng.integers(0, 1 << 63, 2, dtype=np.uint64))
        differ = jaccard_join.codes(x, 9) != jaccard_join.codes(y, 9)
        assert 1 <= differ.sum() <= 5


def test_blank_blocks_gather_no_strangers(spark, monkeypatch):
    layers, written = {}, jaccard_join.written

    def kept(df, name):
        layers[name] = written(df, name)
        return layers[name]

    monkeypatch.setattr(jaccard_join, "written", kept)
    rng = random.Random(5)
    texts = [" ".join(f"w{i}x{j}" for j in range(rng.randint(98, 104))) for i in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard_join.join(docs, jaccard_join.Rule(), {"id": F.col("doc_id")}, "id")
    assert all(r.component_id == r.id for r in got.collect())
    assert layers["pairs"].count() == layers["pivots"].count() == layers["sets"].count() == 0


def test_texts_at_the_limit_meet_without_their_blank_blocks(spark):
    rng, rule = random.Random(6), jaccard_join.Rule()
    pairs, linked = [], []
    for i in range(600):
        words = [f"w{i}x{j}" for j in range(rng.choice([6, 9, 14, 30, 61, 100, 180]))]
        other = words[rng.randint(0, len(words) // 6) :] + [f"y{i}x{j}" for j in range(rng.randint(0, len(words) // 6))]
        x, y = ({tuple(t[k : k + 5]) for k in range(max(1, len(t) - 4))} for t in (words, other))
        pairs += [" ".join(words), " ".join(other)]
        linked.append(rule.high * len(x & y) >= rule.low * len(x | y))
    docs = spark.createDataFrame(list(enumerate(pairs)), "doc_id long, text string")
    got = {r.id: r.component_id for r in jaccard_join.join(docs, rule, {"id": F.col("doc_id")}, "id").collect()}
    assert 100 < sum(linked) < 500
    assert [got[2 * i + 1] == 2 * i for i in range(600)] == linked


def test_differences_at_a_level_bound_every_linked_pair():
    for rule in (jaccard_join.Rule(), jaccard_join.QUERY_RULE):
        for b in range(1, 300):
            for a in range(-(-b * rule.low // rule.high), b + 1):
                shared = set(jaccard_join.levels(a, rule)) & set(jaccard_join.levels(b, rule))
                most = rule.difference(a + b)
                assert any(n > most and all(jaccard_join.difference_at(s, k, rule) >= most for s in (a, b)) for k, n in shared), (a, b)


def test_words_are_never_broadcast(spark, monkeypatch):
    joins, written = [], spelling.written

    def seen(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins.extend(line.strip(" +-:!*()0123456789") for line in plan.splitlines() if "Join" in line)
        return df

    monkeypatch.setattr(spelling, "written", lambda df, name: written(seen(df), name))
    names = ["lantern", "lanterm", "lanten", "marble", "marbel", "garden", "gardens", "wardens"]
    words = spark.createDataFrame([(w, 4**i) for i, w in enumerate(names)], "word string, n long")
    got = {r.word: r.n_near for r in seen(spelling.group_variants(words)).collect()}
    assert got["garden"] == 1 and got["gardens"] == 2 and got["marble"] == 0
    sides = [j for j in joins if "Broadcast" in j]
    assert len(joins) > 4 and len(sides) == 1 and "gram" in sides[0]
