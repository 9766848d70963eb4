"""Benchmark decontamination by template canonicalisation.

Words of documents and benchmark items become template tokens: numbers, names (words with a capital) and
units stand as typed placeholders, everything else lower-cased without punctuation at its ends. Every run of
``WINDOW`` words, of items and of documents, is a window, hashed as template and as lower-cased words, so a
passage in another case meets its item too. Windows meet in a hash join; neighbouring windows of one item
at one offset form a run. A run counts if it equals the item word for word, or if at least half of it are
words, not placeholders, and its slots are consistent: one filler on the item's side always meets the same
filler on the document's side, and the other way round. That catches a question whose numbers and names were
exchanged, and leaves texts alone that only share a sentence form.

The runs of one item whose offsets lie less than the item's length apart are one passage, so inserted or
removed words do not part it. A passage contaminates when its runs that count cover ``COVER`` of the item or one
has ``RUN`` tokens; or, whatever its slots, when windows equal word for word cover ``EXACT_COVER`` or ``RUN`` in a row.
Cover is at least ``LEAST`` tokens, which one window cannot reach. Words between two changes that are fewer than
``WINDOW`` apart are in no window and do not count.

Two passes: the first joins hashes of windows alone and finds the documents that hold any, the second cuts only these
into windows with their places and words. All of it is native. Windows are joined by broadcast only when their counted
size allows it.

Defined results: null or empty texts and items have no windows and match nothing. An item of fewer than ``LEAST``
tokens matches only whole and word for word; one of fewer than ``WINDOW`` is too short to be proof and never matches. Very
long texts are cut like others, a row a window. A repeated document row gives its
pair once per row's id; items of equal text each match. Empty tables give empty results. Only id and text of
both tables are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paypanel.llm.tables import hinted
from paypanel.plans.stages import written

WINDOW = 6
RUN = 24
COVER = 0.6
EXACT_COVER = 0.75
LEAST = 2 * WINDOW - 1

# Units of measure that stand for one another in a template.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds "
    "ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
    "months year years cent cents dollar dollars euro euros percent degree degrees"
).split()
NUMBER = r"^[$€£]?[0-9]+(?:[.,:/][0-9]+)*(?:%|st|nd|rd|th)?$"


def template(raw: Column) -> Column:
    """Template tokens of an array of raw words."""
    unit = F.lit(UNITS)

    def token(word: Column) -> Column:
        return (
            F.when(word.rlike(NUMBER), F.lit("<number>"))
            .when(word.rlike("^\\p{Lu}"), F.lit("<name>"))
            .when(F.array_contains(unit, word), F.lit("<unit>"))
            .otherwise(F.lower(word))
        )

    return F.transform(raw, token)


def folded(raw: Column) -> Column:
    return F.transform(raw, F.lower)


def raw_words(text: Column) -> Column:
    """Words without punctuation at their ends; those that are punctuation only are left out."""
    clean = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}$€£]*\s+[^\p{L}\p{N}$€£]*|^[^\p{L}\p{N}$€£]+|[^\p{L}\p{N}%]+$", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " +"))


def template_text(clean: Column) -> Column:
    """The template of a text of raw words, by the rules of ``template`` but over the whole text at once."""
    number = F.regexp_replace(clean, rf"(?<![^ ]){NUMBER[1:-1]}(?![^ ])", "<number>")
    name = F.regexp_replace(number, r"(?<![^ ])\p{Lu}[^ ]*", "<name>")
    return F.lower(F.regexp_replace(name, rf"(?<![^ ])(?:{'|'.join(UNITS)})(?![^ ])", "<unit>"))


def with_any_window(docs: DataFrame, keys: list[str], text_col: str, found: DataFrame) -> DataFrame:
    """The distinct keys of the rows that hold one of the hashes of ``found`` in either form; hashes only, no words."""
    clean = F.array_join(raw_words(F.col(text_col)), " ")
    # no filters here: pushed down, they would compute the texts once more
    rows = docs.select(*keys, clean.alias("clean"))
    forms = [F.transform(F.split(form, " "), lambda w: F.xxhash64(w)) for form in (template_text(F.col("clean")), F.lower("clean"))]
    # the forms stand one behind the other; a window over their border meets nothing that the second pass confirms
    each = rows.select(*keys, F.concat(*forms).alias("h"))
    whole = F.greatest(F.size("h") - WINDOW + 1, F.lit(0))
    shifted = F.arrays_zip(*[F.slice("h", k + 1, whole).alias(str(k)) for k in range(WINDOW)])
    cut = each.select(*keys, F.explode(shifted).alias("w"))
    hashed = cut.select(*keys, F.xxhash64(*[F.col("w").getField(str(k)) for k in range(WINDOW)]).alias("hash"))
    return hashed.join(hinted(found.select("hash").distinct(), 16), "hash", "left_semi").select(*keys).distinct()


def cut_windows(rows: DataFrame, at: str) -> DataFrame:
    """Every run of WINDOW raw words of every row: the other columns, its first token, raw words, hash (a row each form)."""
    names = [c for c in rows.columns if c != "raw"]
    coded = rows.where(F.size("raw") >= WINDOW).select(
        *names, "raw", F.transform(template(F.col("raw")), lambda w: F.xxhash64(w)).alias("typed"), F.transform("raw", lambda w: F.xxhash64(F.lower(w))).alias("plain")
    )

    # neighbours stand side by side through shifted arrays, which is compiled code; a lambda for each window is not
    whole = F.size("raw") - WINDOW + 1
    shifted = [F.slice(F.col(c), k + 1, whole) for c in ("raw", "typed", "plain") for k in range(WINDOW)]
    cut = coded.select(*names, F.posexplode(F.arrays_zip(*shifted)).alias(at, "w"))
    raw, typed, plain = ([F.col("w").getField(str(c * WINDOW + k)) for k in range(WINDOW)] for c in range(3))
    hashed = cut.select(*names, at, F.array(*raw).alias("raw"), F.xxhash64(*typed).alias("typed"), F.xxhash64(*plain).alias("plain"))
    hashes = F.when(F.col("typed") == F.col("plain"), F.array("plain")).otherwise(F.array("plain", "typed"))
    return hashed.select(*names, at, "raw", F.explode(hashes).alias("hash"))


def windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The windows of every item: item, tokens (of the whole item), item_at, item_raw, hash."""
    rows = items.select(F.col(id_col).alias("item"), raw_words(F.col(text_col)).alias("raw")).where(F.size("raw") >= WINDOW)
    cut = cut_windows(rows.withColumn("tokens", F.size("raw")), "item_at")
    return cut.withColumnRenamed("raw", "item_raw")


def runs(docs: DataFrame, items: DataFrame, keys: list[Column], text_col: str, item_id: str, item_text: str) -> DataFrame:
    """One row per document, item and run of matched windows at one offset: tokens of the item, offset, length, item_at
    (its windows' places), slots (place, both fillers), exact (places of windows equal word for word)."""
    found = written(windows(items, item_id, item_text), "windows")
    texts = docs.select(*keys, F.col(text_col).alias("_text"))
    names = texts.columns[:-1]
    holding = written(with_any_window(texts, names, "_text", found), "holding")
    same_row = F.lit(True)
    for c in names:
        same_row = same_row & F.col(f"t.`{c}`").eqNullSafe(F.col(f"h.`{c}`"))
    # written, so that no filter on the words moves below the join and cuts all documents
    texts = written(texts.alias("t").join(hinted(holding, 200).alias("h"), same_row, "left_semi"), "holding-texts")
    rows = cut_windows(texts.select(*names, raw_words(F.col("_text")).alias("raw")), "at")
    hits = rows.join(hinted(found, 200), "hash")

    def slots_of(item_raw: Column, raw: Column) -> Column:
        pairs = F.zip_with(
            F.transform(item_raw, lambda x, i: F.struct(x.alias("was"), i.alias("i"))),
            raw,
            lambda x, y: F.struct((F.col("item_at") + x.i).alias("place"), F.lower(x.was).alias("x"), F.lower(y).alias("y"), x.was.alias("was")),
        )
        slot = F.filter(pairs, lambda s: s.was.rlike(NUMBER) | s.was.rlike("^\\p{Lu}") | F.array_contains(F.lit(UNITS), s.was))
        return F.transform(slot, lambda s: F.struct(s.place.alias("place"), s.x.alias("x"), s.y.alias("y")))

    # equal hashes are not yet equal words; a pair that meets in both forms counts in one
    exact = folded(F.col("item_raw")) == folded(F.col("raw"))
    same = F.when(exact, F.col("hash") == F.xxhash64(*[F.xxhash64(F.lower(F.get("raw", k))) for k in range(WINDOW)])).otherwise(
        template(F.col("item_raw")) == template(F.col("raw"))
    )
    offset = (F.col("at") - F.col("item_at")).alias("offset")
    kept = hits.where(same).select(*names, "item", "tokens", "item_at", offset, exact.alias("exact"), slots_of(F.col("item_raw"), F.col("raw")).alias("slots"))
    line = Window.partitionBy(*names, "item", "offset").orderBy("item_at")
    return (
        kept.withColumn("island", F.col("item_at") - F.dense_rank().over(line))
        .groupBy(*names, "item", "tokens", "offset", "island")
        .agg(
            F.sort_array(F.collect_set("item_at")).alias("item_at"),
            F.sort_array(F.flatten(F.collect_list("slots"))).alias("slots"),
            F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("item_at")))).alias("exact"),
        )
        .withColumn("length", F.size("item_at") + WINDOW - 1)
        .withColumn("slots", F.filter("slots", lambda s, i: (i == 0) | (s.place != F.get("slots", i - 1).place)))
        .drop("island")
    )


def one_to_one(slots: Column) -> Column:
    """Whether one filler of the item always meets one filler of the document, and the other way round."""
    pairs = F.array_distinct(F.transform(slots, lambda s: F.concat_ws("\n", s.x, s.y)))
    return (F.size(F.array_distinct(F.transform(slots, lambda s: s.x))) == F.size(pairs)) & (
        F.size(F.array_distinct(F.transform(slots, lambda s: s.y))) == F.size(pairs)
    )


def covered(places: Column) -> Column:
    """The item's tokens under the windows at some places."""
    return F.array_distinct(F.flatten(F.transform(places, lambda i: F.sequence(i, i + WINDOW - 1))))


def longest(places: Column) -> Column:
    """Tokens of the longest run of windows at some sorted places."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(acc: Column, i: Column) -> Column:
        now = F.when(i == acc.last + 1, acc.now + 1).otherwise(F.lit(WINDOW))
        return F.struct(i.alias("last"), now.alias("now"), F.greatest(acc.best, now).alias("best"))

    return F.aggregate(places, start, step, lambda acc: acc.best)


def contaminated(found: DataFrame) -> DataFrame:
    """The passages that count as contamination: document, item, tokens, matched, run, n_slots, n_changed."""
    names = [c for c in found.columns if c not in ("item", "tokens", "offset", "item_at", "slots", "exact", "length")]
    changed = F.filter("slots", lambda s: s.x != s.y)
    good = (F.size(changed) == 0) | (one_to_one(F.col("slots")) & (2 * F.size("slots") <= F.col("length")))
    judged = found.select(
        *names, "item", "tokens", "offset", "length", "slots", good.alias("good"), longest(F.col("exact")).alias("exact_run"),
        F.when(good, covered(F.col("item_at"))).otherwise(F.array().cast("array<int>")).alias("tokens_good"), covered(F.col("exact")).alias("tokens_exact"),
    )
    line = Window.partitionBy(*names, "item").orderBy("offset")
    apart = F.coalesce(F.col("offset") - F.lag("offset").over(line) > F.col("tokens"), F.lit(False)).cast("int")
    passage = judged.withColumn("apart", apart).withColumn("passage", F.sum("apart").over(line))
    key = [*names, "item", "tokens", "passage"]

    def marks(places: Column, mark: str) -> Column:
        pair = F.lit(None).cast("struct<changed:boolean,x:string,y:string>").alias("pair")
        return F.transform(places, lambda t: F.struct(t.alias("t"), F.lit(mark == "good").alias("good"), F.lit(mark == "exact").alias("exact"), pair))

    def fillers(s: Column) -> Column:
        pair = F.struct((s.x != s.y).alias("changed"), s.x.alias("x"), s.y.alias("y")).alias("pair")
        return F.struct(s.place.alias("t"), F.lit(False).alias("good"), F.lit(False).alias("exact"), pair)

    # a row each token, so that a passage repeated through a long document makes no large array
    tokens = F.concat(marks(F.col("tokens_good"), "good"), marks(F.col("tokens_exact"), "exact"), F.when(F.col("good"), F.transform("slots", fillers)).otherwise(F.array()))
    each = passage.select(*key, F.when(F.col("good"), F.col("length")).otherwise(0).alias("run"), "exact_run", F.explode(tokens).alias("e")).groupBy(*key, "e.t")
    each = each.agg(F.max("e.good").alias("good"), F.max("e.exact").alias("exact"), F.min("e.pair").alias("pair"), F.max("run").alias("run"), F.max("exact_run").alias("exact_run"))
    total = each.groupBy(*key).agg(
        F.count_if("good").alias("good"),
        F.count_if("exact").alias("exact"),
        F.max("run").alias("run"),
        F.max("exact_run").alias("exact_run"),
        F.collect_set("pair").alias("pairs"),
    )
    by_form = (F.col("good") >= F.greatest(F.ceil(F.col("tokens") * COVER), F.lit(LEAST))) | (F.col("run") >= RUN)
    whole = (F.col("tokens") < LEAST) & (F.col("exact_run") >= F.col("tokens"))
    by_words = whole | (F.col("exact") >= F.greatest(F.ceil(F.col("tokens") * EXACT_COVER), F.lit(LEAST))) | (F.col("exact_run") >= RUN)
    return total.where(by_form | by_words).select(
        *names,
        "item",
        "tokens",
        F.when(by_form, F.col("good")).otherwise(F.col("exact")).alias("matched"),
        F.when(by_form, F.col("run")).otherwise(F.col("exact_run")).alias("run"),
        F.when(by_form, F.size("pairs")).otherwise(0).alias("n_slots"),
        F.when(by_form, F.size(F.filter("pairs", lambda p: p.changed))).otherwise(0).alias("n_changed"),
    )


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per contaminated document and item, with its best alignment's figures."""
    found = contaminated(runs(docs, items, [F.col("doc_id")], "text", "item_id", "text"))
    best = F.max(F.struct("matched", "run", (-F.col("n_changed")).alias("unchanged"), "tokens", "n_slots")).alias("b")
    return (
        found.groupBy("doc_id", F.col("item").alias("item_id"))
        .agg(best)
        .select(
            "doc_id",
            "item_id",
            F.col("b.tokens").cast("long").alias("n_tokens"),
            F.col("b.matched").cast("long").alias("n_matched"),
            F.col("b.run").cast("long").alias("longest_run"),
            F.col("b.n_slots").cast("long").alias("n_slots"),
            (-F.col("b.unchanged")).cast("long").alias("n_changed"),
        )
    )


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a contaminating alignment, all columns; ``docs`` is read from files."""
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    bad = written(
        contaminated(runs(docs, items, at, text_col, item_id, item_text)).select("_file", "_row").distinct(), "contaminated"
    )
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"), *at)
    return packed.join(hinted(bad, 200), ["_file", "_row"], "left_anti").select("_all.*")
