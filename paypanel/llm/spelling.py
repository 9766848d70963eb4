"""Grouping of spelling variants by pivotal grams: words one edit apart, found without comparing all pairs.

A word's grams are its bigrams with their places, ordered by how few words hold them. Its prefix is the three
rarest ones (and all equal to the third). Two of the prefix that do not overlap are its pivots; dynamic programming over
the places picks the two with the fewest holders together. One edit touches at most two neighbouring grams, so it cannot
spoil both pivots, and of two words one edit apart, a pivot of the word whose prefix ends first is in the prefix of the
other. So every word's pivots probe an index of all words' prefixes. Positions limit the probes. Their lengths differ by
one at most, and the edit lies on one side of the common gram, so all up to the gram's end, or all from its start on, is
equal in both. If that is less than half of the shorter word, the part on the other side is halved: the edit leaves one of the
halves as it is, which counts from the gram or from the end of the word. Length, side and equal text, half the
word at least, are the key of the index. Every candidate is verified by its edit distance. Nothing is approximated.

A word's form is its most frequent near word if that is at least twice as frequent; forms are followed to the root by
doubling the steps, as a chain has at most log2(largest count) of them.

Skew: texts are reduced to counted words before any shuffle; each word is then one row. The rarest grams of a word are by
construction the least crowded places of the index; what is still crowded is a join key that adaptive execution may split
on both sides. Gram counts are broadcast only if counted and small; what has a row or more for each word is exchanged whatever
size Spark takes it for, as files hold words in a tenth of their space in memory, and it counts an exploded array as one row.

Defined results: a null text has no words, a null id counts as empty in the hash; words of fewer than five code points
are none (grams need four at least); ties of the largest count go to the word that comes first in code-point order;
repeated rows count as often as they stand; a very long text is read whole; an empty table gives an empty
result. Only the id and the text are read, whatever other columns are named.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paypanel.llm.tables import hinted, shuffled
from paypanel.plans.stages import discard, written

RUN = "[a-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
SPOILED = 97
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def counted_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    spoiled: int = SPOILED,
) -> DataFrame:
    """(word, n): the lower-cased runs of letters; of one in ``spoiled``, told by a hash of id and run, a code point is left out."""
    low = F.translate(F.col(text_col), UPPER, LOWER)
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(name.alias("id"), F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= least_length)
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = hashed.select(F.when(F.col("h") % spoiled == 0, shorter).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


def pivots(prefix: Column) -> Column:
    """The two grams (weight, gram, at) of a prefix that do not overlap and weigh least together, in one pass over the places.

    ``far`` is the lightest gram before ``near``, the one just passed; ``best`` the lightest pair so far. What lies before
    ``near`` overlaps no later gram; ``near`` itself may touch the next one.
    """
    gram = "struct<weight: bigint, gram: string, at: int>"
    pair = f"struct<weight: bigint, first: {gram}, second: {gram}>"
    by_place = F.array_sort(F.transform(prefix, lambda g: F.struct(g.at.alias("at"), g.weight.alias("weight"), g.gram.alias("gram"))))
    start = F.struct(
        F.lit(None).cast(gram).alias("far"), F.lit(None).cast(gram).alias("near"), F.lit(None).cast(pair).alias("best")
    )

    def step(state: Column, g: Column) -> Column:
        this = F.struct(g.weight, g.gram, g.at).cast(gram)
        passed = F.least(state.far, state.near)
        reach = F.when(state.near.at < g.at - 1, passed).otherwise(state.far)
        made = F.when(reach.isNotNull(), F.struct(reach.weight + g.weight, reach, this).cast(pair))
        return F.struct(passed.alias("far"), this.alias("near"), F.least(state.best, made).alias("best"))

    return F.aggregate(by_place, start, step, lambda s: F.array(s.best.first, s.best.second))


def grams(word: Column) -> Column:
    """The bigrams of a word with their places."""
    starts = F.sequence(F.lit(0), F.char_length(word) - 2)
    return F.transform(starts, lambda i: F.struct(F.substring(word, i + 1, F.lit(2)).alias("gram"), i.alias("at")))


def prefixes(words: DataFrame) -> DataFrame:
    """(word, n, length, prefix): the three rarest grams of each word, and all that equal the third, as (weight, gram, at)."""
    holders = words.select(F.explode(F.array_distinct(F.transform(grams(F.col("word")), lambda g: g.gram))).alias("gram"))
    weights = hinted(written(holders.groupBy("gram").agg(F.count(F.lit(1)).alias("weight")), "gram-counts"), 32)
    placed = words.select("word", "n", F.explode(grams(F.col("word"))).alias("g")).select("word", "n", "g.gram", "g.at")
    ordered = (
        placed.join(weights, "gram")
        .groupBy("word", "n")
        .agg(F.array_sort(F.collect_list(F.struct("weight", "gram", "at"))).alias("all"))
    )
    third = F.struct(F.col("all")[2].weight, F.col("all")[2].gram)
    return ordered.select(
        "word",
        "n",
        F.char_length("word").alias("length"),
        F.filter("all", lambda g: F.struct(g.weight, g.gram) <= third).alias("prefix"),
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n), both ways round, for all words of exactly one edit between them.

    ``words`` has distinct words of at least four code points and their counts.
    """
    layer = written(prefixes(words), "word-prefixes")

    word, length = F.col("word"), F.col("length")

    def keys(g: Column, m: Column) -> Column:
        """Hashed keys of one gram for pairs whose shorter word has ``m`` code points; see the docstring above."""

        def first(n: Column | int) -> Column:
            return F.substring(word, F.lit(1), n)

        def last(n: Column) -> Column:
            return F.substring(word, length - n + 1, n)

        upto, onward = g.at + 2, length - g.at
        after, before = F.floor((m - upto) / 2).cast("int"), F.floor((m - onward) / 2).cast("int")
        right = F.when(2 * upto > m, F.array(F.xxhash64(F.lit("<"), m, first(upto)))).otherwise(
            F.array(
                F.xxhash64(F.lit("<1"), m, first(upto + after)),
                F.xxhash64(F.lit("<2"), m, first(upto), last(m - upto - after)),
            )
        )
        left = F.when(2 * onward > m, F.array(F.xxhash64(F.lit(">"), m, last(onward)))).otherwise(
            F.array(
                F.xxhash64(F.lit(">1"), m, first(before), last(onward)),
                F.xxhash64(F.lit(">2"), m, last(m - before)),
            )
        )
        return F.concat(right, left)

    def placed(grams: Column) -> DataFrame:
        every = F.transform(grams, lambda g: F.flatten(F.transform(F.array(length, length - 1), lambda m: keys(g, m))))
        end = F.element_at("prefix", -1).weight
        return layer.select("word", "n", end.alias("end"), F.explode(F.array_distinct(F.flatten(every))).alias("key"))

    held = placed(F.col("prefix")).select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("end").alias("other_end"), "key")
    found = placed(pivots(F.col("prefix"))).join(shuffled(held), "key").where(
        (F.col("end") <= F.col("other_end")) & (F.levenshtein("word", "other", 1) == 1)
    )
    one, two = F.struct("word", "n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"))
    pairs = found.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
    ways = F.array(*[F.struct(x.word.alias("word"), x.n.alias("n"), y.word.alias("other"), y.n.alias("other_n")) for x, y in ((F.col("a"), F.col("b")), (F.col("b"), F.col("a")))])
    return pairs.select(F.inline(ways))


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of words with a form: the pointers are followed twice as far in each round."""
    ends = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        before, ends = ends, written(
            ends.join(shuffled(further), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots"
        )
        discard(before)
    return ends


def group_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct counted words."""
    words = written(words, "words")
    near = near_pairs(words).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("top")
    )
    top_n = -F.col("top.less")
    near = written(
        near.select(
            "word",
            "n_near",
            F.when(top_n >= 2 * F.col("n"), F.col("top.other")).alias("form"),
            F.when(top_n >= 2 * F.col("n"), top_n).alias("form_n"),
        ),
        "near-counts",
    )
    largest = words.agg(F.max("n")).first()[0] or 1
    steps = int(largest).bit_length()  # a chain has fewer
    ends = roots(near.where(F.col("form").isNotNull()), max(0, math.ceil(math.log2(steps))))
    return (
        words.join(shuffled(near), "word", "left")
        .join(shuffled(ends), "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )


def report(docs: DataFrame) -> DataFrame:
    return group_variants(counted_words(docs))


#: The same rows by another way: one edit means an equal rest after one deletion on one side or at one place of both.
ORACLE = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b)
  )
), run AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{RUN}')) AS run
  FROM documents
), counted AS (
  SELECT id, run, hex(encode(id || ':' || run)) AS raw, count(*) AS n FROM run WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(range(length(raw) // 2), lambda i: ('0x' || substr(raw, 2 * i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM counted, crc_table
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {SPOILED} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
    FROM hashed
  ) WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), deleted AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM deleted a JOIN deleted b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN deleted b ON a.word = b.rest
  UNION SELECT a.word, a.n, b.word, b.n FROM deleted a JOIN words b ON a.rest = b.word
), top AS (
  SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word, n
), form AS (
  SELECT word, n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM top
), chain AS (
  SELECT word, form AS root FROM form WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, form.form FROM chain JOIN form ON form.word = chain.root WHERE form.form IS NOT NULL
), ends AS (
  SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM form WHERE form IS NOT NULL)
)
SELECT word, form, coalesce(root, word) AS root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM words LEFT JOIN form USING (word) LEFT JOIN ends USING (word)
"""
