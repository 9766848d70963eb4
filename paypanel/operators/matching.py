"""Best-similarity suggestions for labels that no code table knows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paypanel.operators.joins import fill_audit, fill_from_lookup
from paypanel.plans.stages import written

NO_SUGGESTION = "AUCUNE_SUGGESTION"
#: Scores that whole common tokens must be able to reach for names to meet by token.
FLOOR = 50.0


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, on the bits of one integer."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def similarity(a: str, b: str) -> float:
    """Normalised indel similarity, 0 to 100."""
    total = len(a) + len(b)
    return 100.0 * 2 * lcs_length(a, b) / total if total else 100.0


def token_set_ratio(a: str, b: str) -> float:
    """Similarity of the token sets: 100 when one set contains the other."""
    return _set_ratio(set(a.split()), set(b.split()), -1.0)


def _set_ratio(ta: set[str], tb: set[str], beat: float) -> float:
    """Token-set ratio, or any value not above ``beat`` when it cannot exceed it.

    The common tokens are a prefix of both full texts, and a common prefix always belongs to a
    longest common subsequence, so only the remaining tokens are compared.
    """
    if not ta or not tb:
        return 0.0
    both = ta & tb
    if both and (len(both) == len(ta) or len(both) == len(tb)):
        return 100.0
    rest_a, rest_b = " ".join(sorted(ta - both)), " ".join(sorted(tb - both))
    prefix = sum(map(len, both)) + len(both)  # each common token and the blank after it
    la, lb = prefix + len(rest_a), prefix + len(rest_b)
    best = 0.0
    if both:
        common = prefix - 1
        best = 200.0 * common / (common + min(la, lb))
    if 200.0 * min(la, lb) / (la + lb) <= max(best, beat):
        return best
    return max(best, 200.0 * (prefix + lcs_length(rest_a, rest_b)) / (la + lb))


BLANKS = r"\x09-\x0D\x1C-\x20\x85\xA0" + "".join(f"\\x{{{c:04X}}}" for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
PROFILE = ("name", "tokens", "prefix", "length", "bits0", "bits1", "bits2", "bits3", "over")


def _score_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        scores = [token_set_ratio(a, b) for a, b in zip(batch["libelle"], batch["candidat"])]
        yield batch[["libelle", "candidat"]].assign(score=pd.Series(scores, dtype="float64"))


def _profiles(names: DataFrame, rarity: DataFrame | None, floor: float) -> DataFrame:
    """Tokens, length of their text, prefix and letter counts of each ``name``.

    ``prefix`` holds the rarest tokens: without any of them, two names share too few letters in whole tokens for a
    score of ``floor``. Letters fall into 32 classes. The first eight of a class set one bit each, from the lowest on, so
    the common bits of two names count their common letters; those beyond eight are counted in ``over``.
    """
    tokens = F.array_distinct(F.filter(F.split("name", f"[{BLANKS}]+"), lambda t: t != ""))
    held = names.select("name", tokens.alias("tokens"))
    if rarity is None:
        return held
    placed = held.select("name", F.explode("tokens").alias("token")).join(rarity, "token", "left")
    rank = F.struct(F.coalesce("holders", F.lit(0).cast("long")).alias("holders"), "token")
    ordered = placed.groupBy("name").agg(F.array_sort(F.collect_list(rank)).alias("ranked"))
    letters = F.filter(F.split(F.array_join("tokens", " "), ""), lambda c: c != "")
    classes = F.transform(letters, lambda c: F.pmod(F.ascii(c), F.lit(32)))

    def counted(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.size(F.filter(x, lambda c: c == k)))

    # lambdas bind what is used often, so that it is worked out once
    counts = F.element_at(F.transform(F.array(classes), counted), 1)
    held = held.join(ordered, "name", "left").withColumn("length", F.size(letters))

    least = F.col("length") * (floor / (200.0 - floor)) + 1.0

    def onward(i: Column) -> Column:
        return F.aggregate(F.slice("ranked", i + 1, F.size("ranked")), F.lit(0), lambda acc, t: acc + F.length(t.token) + 1)

    prefix = F.transform(F.filter("ranked", lambda t, i: onward(i) >= least - 1e-9), lambda t: t.token)

    def ones(c: Column) -> Column:
        return F.element_at(F.lit([(1 << n) - 1 for n in range(9)]), F.least(c, F.lit(8)) + 1).cast("long")

    def packed(c: Column) -> Column:
        zero = F.lit(0).cast("long")
        words = [F.aggregate(F.slice(c, 8 * w + 1, 8), zero, lambda acc, x: F.shiftleft(acc, 8).bitwiseOR(ones(x))) for w in range(4)]
        over = F.aggregate(c, F.lit(0), lambda acc, x: acc + F.greatest(x - 8, F.lit(0)))
        return F.struct(*[x.alias(f"bits{w}") for w, x in enumerate(words)], over.alias("over"))

    prefix = F.coalesce(prefix, F.array().cast("array<string>")).alias("prefix")
    return held.select("name", "tokens", prefix, "length", F.inline(F.transform(F.array(counts), packed)))


def _side(profiles: DataFrame, side: str, *more: Column) -> DataFrame:
    return profiles.select(*[F.col(c).alias(f"{side}_{c}") for c in PROFILE], *more)


def _shared_letters() -> Column:
    """At least the letters that both names have, so also their longest common subsequence."""
    common = sum((F.bit_count(F.col(f"a_bits{w}").bitwiseAND(F.col(f"b_bits{w}"))) for w in range(4)), F.lit(0))
    return common + F.least("a_over", "b_over")


def _token_score() -> Column:
    """The part of the score that whole common tokens give: 100 when one set holds the other."""
    both = F.array_intersect("a_tokens", "b_tokens")
    common = F.aggregate(both, F.lit(-1), lambda acc, t: acc + F.length(t) + 1)
    holds = F.size(both) == F.least(F.size("a_tokens"), F.size("b_tokens"))
    ratio = 200.0 * common / (common + F.least("a_length", "b_length"))
    return F.when(F.size(both) == 0, 0.0).when(holds, 100.0).otherwise(ratio)


def token_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """(libelle, candidat, score by tokens, bound of the score by letters): all pairs whose token score reaches the floor, and others.

    The shorter name's prefix meets the tokens of the longer one. A pair that meets in several tokens counts at the rarest.
    """
    token = F.explode("prefix").alias("token"), F.explode("tokens").alias("token")
    left = _side(a, "a", token[0]).join(_side(b, "b", token[1]), "token")
    left = left.where((F.col("a_length") <= F.col("b_length")) & (F.col("token") == F.array_intersect("a_prefix", "b_tokens")[0]))
    right = _side(a, "a", token[1]).join(_side(b, "b", token[0]), "token")
    right = right.where((F.col("a_length") > F.col("b_length")) & (F.col("token") == F.array_intersect("b_prefix", "a_tokens")[0]))
    bound = 200.0 * _shared_letters() / (F.col("a_length") + F.col("b_length"))
    return left.unionByName(right).select(
        F.col("a_name").alias("libelle"), F.col("b_name").alias("candidat"), _token_score().alias("score"), bound.alias("bound")
    )


def letter_pairs(a: DataFrame, b: DataFrame, floor: float | None) -> DataFrame:
    """(libelle, candidat) of the pairs that ``token_pairs`` has not, whose letters allow a score of ``a_least`` or more.

    With a floor, ``a_least`` is at least that, so only the longest common subsequence can reach it: names of too different
    lengths cannot. Without one, every length is met, and whole common tokens may count too.
    """
    la, lb, least = F.col("a_length"), F.col("b_length"), F.col("a_least")
    longest = b.agg(F.max("length")).scalar()
    if floor is None:
        low, high = F.lit(0), longest
        allowed = 200.0 * _shared_letters() >= (least - 1e-9) * (_shared_letters() + F.least(la, lb))
    else:
        low = F.ceil(la * least / (200.0 - least) - 1e-9).cast("int")
        high = F.least(F.floor(la * (200.0 - least) / least + 1e-9).cast("int"), longest)
        allowed = 200.0 * _shared_letters() >= (least - 1e-9) * (la + lb)
    lengths = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    met = F.when(la <= lb, F.arrays_overlap("a_prefix", "b_tokens")).otherwise(F.arrays_overlap("b_prefix", "a_tokens"))
    return (
        _side(a, "a", F.col("least").alias("a_least"))
        .withColumn("at_length", F.explode(lengths))
        .join(_side(b, "b", F.col("length").alias("at_length")), "at_length")
        .where(allowed & ~met)
        .select(F.col("a_name").alias("libelle"), F.col("b_name").alias("candidat"))
    )


def _best(scored: DataFrame) -> DataFrame:
    """The best candidate of each label; ties go to the smallest name."""
    rank = F.struct((-F.col("score")).alias("s"), F.col("candidat").alias("c"))
    return scored.groupBy("libelle").agg(F.min(rank).alias("_b")).select("libelle", (-F.col("_b.s")).alias("score"), F.col("_b.c").alias("candidat"))


def best_suggestions(labels: DataFrame, ref: DataFrame, label: str, ref_label: str, floor: float = FLOOR) -> DataFrame:
    """Best reference label of every distinct label, with its 0-100 score: the same as comparing all of them.

    Three steps, each leaving fewer labels open. (1) Names that share enough in whole tokens for ``floor`` meet in their
    rare tokens; that score needs no comparison, and only pairs whose letters allow more than the best so far are
    compared. (2) What is left can win by its longest common subsequence only: names join by length within the band that
    the best score so far (``floor`` at least) leaves, and a pair is compared if the counts of common letters allow that
    score. (3) Labels that resemble nothing by then meet every reference that their letters allow. Comparisons are single rows,
    spread evenly; frequent tokens and lengths are join keys that adaptive execution splits.
    """
    # both are read several times and filtered: written first, so that whatever makes the labels is worked out once a row
    given = written(ref.select(F.col(ref_label).alias("name")).distinct(), "reference-names")
    names = given.select(F.trim("name").alias("name")).where(F.col("name") != "").distinct()
    wanted = written(labels.select(F.col(label).alias("libelle")).distinct(), "wanted-labels").where(F.col("libelle").isNotNull())
    filled = wanted.where(F.trim("libelle") != "").select(F.col("libelle").alias("name"))
    rarity = _profiles(names, None, floor).select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("holders"))
    b = written(_profiles(names, rarity, floor), "references")
    a = written(_profiles(filled, rarity, floor), "labels")

    def compared(pairs: DataFrame) -> DataFrame:
        spread = 4 * labels.sparkSession.sparkContext.defaultParallelism
        return pairs.select("libelle", "candidat").repartition(spread).mapInPandas(_score_pairs, "libelle string, candidat string, score double")

    by_token = written(token_pairs(a, b), "token-pairs")
    top = by_token.groupBy("libelle").agg(F.max("score").alias("top"))
    unsure = by_token.join(top, "libelle").where((F.col("bound") > F.col("score")) & (F.col("bound") >= F.col("top") - 1e-9) & (F.col("score") < 100.0))
    first = written(_best(by_token.select("libelle", "candidat", "score").unionByName(compared(unsure))), "best-by-token")

    def open_labels(best: DataFrame, below: float, least: Column) -> DataFrame:
        known = best.select(F.col("libelle").alias("name"), "score")
        return a.join(known, "name", "left").where(F.coalesce("score", F.lit(0.0)) < below).withColumn("least", least)

    score = F.coalesce("score", F.lit(0.0))
    band = open_labels(first, 100.0, F.greatest(score, F.lit(float(floor))))
    second = written(_best(first.select("libelle", "candidat", "score").unionByName(compared(letter_pairs(band, b, floor)))), "best-by-letters")
    alone = open_labels(second, floor, score)
    best = _best(second.select("libelle", "candidat", "score").unionByName(compared(letter_pairs(alone, b, None))))
    return wanted.join(best, "libelle", "left").select(
        "libelle",
        F.coalesce("candidat", F.lit(NO_SUGGESTION)).alias("suggestion"),
        F.coalesce("score", F.lit(0.0)).cast("int").alias("score"),
    )


def with_codes(suggestions: DataFrame, ref: DataFrame, ref_label: str, code: str) -> DataFrame:
    """Attach the code of the suggested label (smallest one when the label has several)."""
    codes = ref.groupBy(F.col(ref_label).alias("suggestion")).agg(F.min(code).alias(code))
    return suggestions.join(codes, "suggestion", "left")


def auto_apply(df: DataFrame, suggestions: DataFrame, label: str, code: str, ids: list[str], min_score: int = 70):
    """Fill missing codes from suggestions of at least ``min_score``; returns (rows, audit)."""
    good = suggestions.where((F.col("score") >= min_score) & F.col(code).isNotNull())
    lookup = good.select(F.col("libelle").alias(label), code)
    return fill_from_lookup(df, lookup, label, [code]), fill_audit(df, lookup, label, code, ids)


def extend_mapping(mapping: DataFrame, chosen: DataFrame, label: str, code: str) -> DataFrame:
    """Mapping with the chosen aliases; earlier rows of an alias are replaced."""
    alias = chosen.select(F.col("libelle").alias(label), code).distinct()
    kept = mapping.select(label, code).join(alias.select(label), label, "left_anti")
    return kept.unionByName(alias).dropDuplicates([label, code])
