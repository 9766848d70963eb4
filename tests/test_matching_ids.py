"""Token-set similarity, suggestions and pseudonyms."""

import hashlib
import hmac
import random

import pytest
from pyspark.sql import functions as F

from paypanel.operators import matching as mat
from paypanel.operators import pseudonyms as ps


def lcs_plain(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("a, b", [("", "abc"), ("abc", "abc"), ("kitten", "sitting"), ("MINISTERE DE LA SANTE", "SANTE ET MINISTRE"), ("aaaa", "aa")])
def test_lcs(a, b):
    assert mat.lcs_length(a, b) == lcs_plain(a, b) == mat.lcs_length(b, a)


def test_token_set_ratio():
    assert mat.token_set_ratio("MINISTERE SANTE", "SANTE MINISTERE PUBLIQUE") == 100.0
    assert mat.token_set_ratio("ABC", "XYZ") == 0.0
    assert mat.token_set_ratio("", "XYZ") == 0.0
    # common 'A B', rests 'C' and 'D': the longest pair is 'A B C' / 'A B D'
    assert mat.token_set_ratio("A B C", "A B D") == pytest.approx(80.0)


@pytest.mark.parametrize("floor", [50.0, 1.0, 95.0])
def test_best_suggestion_against_all_pairs(spark, floor):
    refs = ["DIRECTION SANTE", "DIRECTION EDUCATION", "TRESOR PUBLIC", "PUBLIC TRESOR", ""]
    labels = ["DIRECTION DE LA SANTE", "EDUCATION", "TRESOR", "  ", "QQQ", None]
    df = spark.createDataFrame([(x,) for x in labels] * 2, "lib string")
    ref = spark.createDataFrame([(r,) for r in refs], "ref string")
    got = {r["libelle"]: (r["suggestion"], r["score"]) for r in mat.best_suggestions(df, ref, "lib", "ref", floor).collect()}
    assert got["  "] == (mat.NO_SUGGESTION, 0)
    for x in ("DIRECTION DE LA SANTE", "EDUCATION", "TRESOR", "QQQ"):
        best = min(((-mat.token_set_ratio(x, r), r) for r in refs if r), key=lambda p: p)
        assert got[x] == (best[1], int(-best[0]))
    assert len(got) == 5


BLANK_NAMES = ["\t", "\u3000A\x1cB", "É À", "AAAAAAAAAAAAA AAAAAAAAAAAA"]


def drawn_names(rng, n):
    stock = "DIRECTION DE LA SANTE EDUCATION TRESOR PUBLIC SERVICE MINISTERE AGENT CHEF A B AAAAAAAAAAAA".split()
    words = [[rng.choice(stock) for _ in range(rng.randrange(1, 6))] for _ in range(n)]
    odd = ["".join(rng.choice("ABCDEXYZ019") for _ in range(rng.randrange(1, 12))) if rng.random() < 0.3 else "" for _ in range(n)]
    return [" ".join([*w, o]).strip() for w, o in zip(words, odd)]


@pytest.mark.parametrize("floor", [50.0, 80.0, 5.0])
def test_candidate_joins_lose_nothing(spark, floor):
    rng = random.Random(3)
    refs, labels = drawn_names(rng, 80) + BLANK_NAMES[1:3], drawn_names(rng, 100) + BLANK_NAMES
    df = spark.createDataFrame([(x,) for x in labels], "lib string")
    ref = spark.createDataFrame([(r,) for r in refs], "ref string")
    got = {r["libelle"]: (r["suggestion"], r["score"]) for r in mat.best_suggestions(df, ref, "lib", "ref", floor).collect()}
    for x in set(labels):
        best = min((-mat.token_set_ratio(x, r), r) for r in set(refs))
        assert got[x] == (best[1], int(-best[0])), x


def test_few_pairs_are_compared(spark, monkeypatch):
    rng = random.Random(4)
    refs, labels = sorted(set(drawn_names(rng, 300))), sorted(set(drawn_names(rng, 300)))
    seen = []
    kept = mat.written

    def counting(df, name="cut"):
        out = kept(df, name)
        seen.append((name, out))
        return out

    monkeypatch.setattr(mat, "written", counting)
    df = spark.createDataFrame([(x,) for x in labels], "lib string")
    mat.best_suggestions(df, spark.createDataFrame([(r,) for r in refs], "ref string"), "lib", "ref")
    frames = dict(seen)
    by_token = frames["token-pairs"]
    top = by_token.groupBy("libelle").agg(F.max("score").alias("top"))
    unsure = by_token.join(top, "libelle").where("score < 100 and bound > score and bound >= top").count()
    first = frames["best-by-token"].select(F.col("libelle").alias("name"), "score").where("score < 100")
    least = F.greatest("score", F.lit(mat.FLOOR)).alias("least")
    late = mat.letter_pairs(frames["labels"].join(first.select("name", least), "name"), frames["references"], mat.FLOOR).count()
    assert unsure + late < len(refs) * len(labels) / 10


def test_labels_are_worked_out_once_a_row(spark):
    worked_out = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def costly(x):
        worked_out.add(1)
        return x

    labels = spark.createDataFrame([("RED RING 10",), ("OLD BOLT 20",), (" ",), (None,), ("RED RING 10",)], "l string")
    ref = spark.createDataFrame([("RED RING",), ("OLD BOLT",), ("",), ("BLUE GEAR",)], "r string")
    out = mat.best_suggestions(labels.select(costly("l").alias("lib")), ref.select(costly("r").alias("ref")), "lib", "ref")
    assert {r.libelle: (r.suggestion, r.score) for r in out.collect()} == {
        "RED RING 10": ("RED RING", 100), "OLD BOLT 20": ("OLD BOLT", 100), " ": (mat.NO_SUGGESTION, 0)
    }
    assert worked_out.value == 9


def test_auto_apply_fills_only_missing_codes(spark):
    d = spark.createDataFrame([(1, "A", None), (2, "A", "9"), (3, "B", None)], "i int, lib string, code string")
    sugg = spark.createDataFrame([("A", "X", 70, "1"), ("B", "Y", 69, "2")], "libelle string, suggestion string, score int, code string")
    out, audit = mat.auto_apply(d, sugg, "lib", "code", ["i"])
    assert {r["i"]: r["code"] for r in out.collect()} == {1: "1", 2: "9", 3: None}
    assert [(r["i"], r["code_BEFORE"], r["code_AFTER"]) for r in audit.collect()] == [(1, None, "1")]


KEY = "0123456789abcdef"


def test_mapping_is_distinct_trimmed_and_keyed(spark):
    d = spark.createDataFrame([("12",), (" 12 ",), ("13",), ("",), (None,)], "id string")
    got = {r["original"]: r["pseudonyme"] for r in ps.id_mapping(d, "id", KEY).collect()}
    assert got == {x: hmac.new(KEY.encode(), x.encode(), hashlib.sha256).hexdigest() for x in ("12", "13")}
    slow = {r["original"]: r["pseudonyme"] for r in ps.id_mapping(d, "id", KEY, 1000).collect()}
    assert slow["12"] != got["12"] and len(slow["12"]) == 64
    out = ps.apply_ids(d, ps.id_mapping(d, "id", KEY), "id")
    assert out.columns == ["pseudonyme"] and out.where("pseudonyme is null").count() == 2


def test_key_never_shows_in_the_plan(spark):
    m = ps.id_mapping(spark.createDataFrame([("12",)], "id string"), "id", KEY)
    assert KEY not in m._jdf.queryExecution().toString()


def test_missing_key_raises(monkeypatch):
    monkeypatch.delenv(ps.KEY_VARIABLE, raising=False)
    with pytest.raises(OSError):
        ps.key_from_environment()
