"""Language identification by mixture inference over character trigrams.

Learning counts the hashed trigrams of every training text, per language, in one pass: each task folds its
rows into one count array per language, Spark sums the arrays. The model is a table of ``BUCKETS`` rows and
one column per language, the only thing the driver sees.

Prediction treats a document as a mixture. Expectation-maximisation estimates the languages' proportions
from the trigram likelihoods; the set of languages is the one of highest penalised likelihood among the
nested sets of the most likely languages (each further language must gain ``PENALTY`` times the logarithm of
the number of trigrams). The likelihood is concave in the proportions, so the gradient bounds what any
mixture can still gain; a document whose bound is below one penalty is settled as one language at once.

Defined results: a null text, or one without letters, is ``und`` with score 0. A null id counts as held out
(never learned from). Rows without a language are not learned from. With nothing to learn from every row is
``und``. Repeated rows are learned from as often as they occur. An empty table gives an empty result. Only
text takes part in a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paypanel.plans.stages import few_rows_sent

BUCKETS = 1 << 15
CHUNK = 1 << 20  # characters of one text looked at together
RUN = 1 << 18  # characters of short texts looked at together
ROWS = 256  # rows taken from a batch and handed on together
PENALTY = 2.0
ROUNDS = 40
LANGUAGES_HELD = 64  # count arrays a task holds before it hands them on


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(text: str, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of a lower-cased text, non-letters as single blanks, and the positions kept.

    The blanks at ``starts`` open documents and stay beside the blank that ended the one before.
    """
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    points = np.where(letters()[points], points, np.uint32(32))
    kept = np.ones(points.size, bool)
    kept[1:] = (points[1:] != 32) | (points[:-1] != 32)
    if starts is not None:
        kept[starts] = True
    at = np.flatnonzero(kept)
    points = points[at]
    if points.size < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mixed = points[:-2] * np.uint32(0x9E3779B1) + points[1:-1] * np.uint32(0x85EBCA6B) + points[2:] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(17)).astype(np.int64), at


def gram_counts(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first document, documents, document, bucket, count) for runs of documents of about RUN characters."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        if run and size + len(text) > RUN:
            yield _counted(first, run)
            first, run, size = i, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield _counted(first, run)


def _counted(first: int, run: list[str]):
    if len(run) == 1 and len(run[0]) > CHUNK:  # one long text: piece by piece, two characters shared
        total = np.zeros(BUCKETS, np.int64)
        text = run[0]
        for at in range(0, len(text), CHUNK):
            piece = text[max(0, at - 2) : at + CHUNK].lower()
            grams, _ = _grams((" " if at == 0 else "") + piece + (" " if at + CHUNK >= len(text) else ""))
            total += np.bincount(grams, minlength=BUCKETS)
        bucket = np.flatnonzero(total)
        return first, 1, np.zeros(bucket.size, np.int64), bucket, total[bucket]
    lowered = [f" {t.lower()} " for t in run]
    ends = np.cumsum([len(t) for t in lowered])
    grams, at = _grams("".join(lowered), ends[:-1])
    doc = np.searchsorted(ends, at, "right")
    own = doc[2:] == doc[:-2] if doc.size > 2 else np.zeros(0, bool)
    key, count = np.unique(doc[2:][own] * BUCKETS + grams[own], return_counts=True) if own.any() else (np.zeros(0, np.int64),) * 2
    return first, len(run), key // BUCKETS, key % BUCKETS, count


def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) to rows (lang, bucket, n), folded over the whole task."""
    held: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, total in held.items():
            bucket = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * bucket.size, pa.string()), pa.array(bucket), pa.array(total[bucket])],
                names=["lang", "bucket", "n"],
            )
        held.clear()

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for first, docs, doc, bucket, count in gram_counts(texts):
            by_lang: dict[str, list[int]] = {}
            for i in range(docs):
                by_lang.setdefault(langs[first + i], []).append(i)
            for lang, own in by_lang.items():
                if lang not in held and len(held) >= LANGUAGES_HELD:
                    yield from flush()
                mask = np.isin(doc, own)
                total = np.bincount(bucket[mask], weights=count[mask], minlength=BUCKETS).astype(np.int64)
                held[lang] = held[lang] + total if lang in held else total
    yield from flush()


class Model:
    """Trigram probabilities per language."""

    def __init__(self, langs: list[str], counts: np.ndarray, smoothing: float = 0.5):
        self.langs = langs
        self.probability = ((counts + smoothing) / (counts.sum(0) + smoothing * BUCKETS)).astype(np.float32)


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """The model of all rows of ``docs`` that have a language and a text."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sums = (
        rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
        .mapInArrow(count_task, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    with few_rows_sent(docs.sparkSession):
        found = sums.toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(langs)))
    column = {lang: i for i, lang in enumerate(langs)}
    where = np.array([column[v] for v in found.column("lang").to_pylist()], np.int64)
    counts[found.column("bucket").to_numpy(), where] = found.column("n").to_numpy()
    return Model(langs, counts)


def _log_likelihood(mix: np.ndarray, count: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(count * np.log(mix), starts)


def mixture(p: np.ndarray, count: np.ndarray, starts: np.ndarray, allowed: np.ndarray, best: np.ndarray, penalty: np.ndarray):
    """EM for many documents at once: proportions (documents x languages) and log-likelihoods.

    ``p`` has one row per (document, bucket), grouped by ``starts``; ``allowed`` switches languages on per
    document. A document leaves the loop when its gradient bound shows that no mixture beats ``best`` by
    ``penalty``, or that nothing more than 0.01 is to be gained.
    """
    docs, langs = allowed.shape
    sizes = np.diff(np.append(starts, count.size))
    total = np.add.reduceat(count, starts)
    share = allowed / allowed.sum(1, keepdims=True)
    likelihood = np.full(docs, -np.inf)
    active = np.arange(docs)
    rows, weight, first = p, count, starts
    for step in range(ROUNDS):
        doc = np.repeat(np.arange(active.size), sizes[active])
        mix = np.einsum("ij,ij->i", rows, share[active][doc])
        likelihood[active] = _log_likelihood(mix, weight, first)
        gradient = np.add.reduceat((weight / mix)[:, None] * rows, first, axis=0) / total[active][:, None]
        gradient = np.where(allowed[active], gradient, 0.0)
        gain = total[active] * (gradient.max(1) - 1.0)
        over = (gain < 0.01) | (likelihood[active] + gain < best[active] + penalty[active])
        share[active] = share[active] * gradient
        share[active] /= share[active].sum(1, keepdims=True)
        if step and over.any() or over.all():
            left = active[~over]
            if not left.size:
                break
            keep = np.isin(active, left)[doc]
            rows, weight = rows[keep], weight[keep]
            active = left
            first = np.append(0, np.cumsum(sizes[active])[:-1])
    return share, likelihood


def infer(model: Model, doc: np.ndarray, bucket: np.ndarray, count: np.ndarray):
    """Proportions of the chosen language set for each document present in ``doc`` (sorted)."""
    present, starts = np.unique(doc, return_index=True)
    p = model.probability[bucket].astype(np.float64)
    weight = count.astype(np.float64)
    langs = len(model.langs)
    total = np.add.reduceat(weight, starts)
    single = np.add.reduceat(weight[:, None] * np.log(p), starts, axis=0)
    best = single.max(1)
    penalty = PENALTY * np.log(np.maximum(total, 2.0))
    chosen = np.zeros_like(single)
    chosen[np.arange(present.size), single.argmax(1)] = 1.0
    if langs == 1:
        return present, chosen
    share, likelihood = mixture(p, weight, starts, np.ones_like(single, bool), best, penalty)
    open_docs = np.flatnonzero(likelihood >= best + penalty)
    for d in open_docs:  # documents in more than one language: the nested sets of the most likely ones
        own = slice(starts[d], starts[d + 1] if d + 1 < starts.size else None)
        order = np.argsort(-share[d], kind="stable")
        top, winner = best[d], chosen[d]
        for m in range(2, langs + 1):
            allowed = np.zeros((1, langs), bool)
            allowed[0, order[:m]] = True
            mixed, value = mixture(p[own], weight[own], np.zeros(1, np.int64), allowed, np.full(1, -np.inf), np.zeros(1))
            if value[0] - (m - 1) * penalty[d] > top:
                top, winner = value[0] - (m - 1) * penalty[d], mixed[0]
        chosen[d] = winner
    return present, chosen


def told(model: Model, texts: list[str | None]) -> tuple[list[str], list[float], list[str]]:
    """Per text its language (``und`` without letters), that language's share, and all shares."""
    texts = [t or "" for t in texts]
    pred, score, mixed = ["und"] * len(texts), [0.0] * len(texts), [""] * len(texts)
    if model.langs:
        for first, _, doc, bucket, count in gram_counts(texts):
            if not doc.size:
                continue
            present, share = infer(model, doc, bucket, count)
            for d, row in zip(present.tolist(), share):
                k = int(row.argmax())
                pred[first + d], score[first + d] = model.langs[k], round(float(row[k]), 6)
                mixed[first + d] = ",".join(f"{model.langs[j]}:{row[j]:.4f}" for j in np.argsort(-row) if row[j] >= 0.00005)
    return pred, score, mixed


def few_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut to ``ROWS`` rows, so that a task holds the texts of few rows as strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def predictor(model: Model):
    """Rows (id, held_out, text, ...) to the same key columns and lang_pred, score, languages."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            pred, score, mixed = told(model, batch.column(batch.num_columns - 1).to_pylist())
            keys = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(pred), pa.array(score, pa.float64()), pa.array(mixed)],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "languages"],
            )

    return predict


def keeper(model: Model, text_at: int):
    """Whole rows to those whose language can be told, as they are; each text is sent once."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            pred, _, _ = told(model, batch.column(text_at).to_pylist())
            yield batch.filter(pa.array([p != "und" for p in pred]))

    return keep


def held_out(id_col: Column) -> Column:
    """The fold that is never learned from: checksum of the id as text, by 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5, F.lit(0)) == 0


def predict(docs: DataFrame, model: Model, keys: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The named key columns of every row with lang_pred, score and languages (proportions)."""
    rows = docs.select(*[c.alias(k) for k, c in keys.items()], F.col(text_col).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(predictor(model), f"{fields}, lang_pred string, score double, languages string")


def report(docs: DataFrame) -> DataFrame:
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out(F.col("doc_id"))})


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows whose language can be told; those without any letters (``und``) go. Columns stay as they are.

    Without a labelled row there is nothing to learn, so all rows with letters stay.
    """
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    if not model.langs:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return docs.mapInArrow(keeper(model, [c.lower() for c in docs.columns].index("text")), docs.schema)
