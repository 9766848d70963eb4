"""Toxicity grades by cumulative-link ordinal regression.

One weight vector over sparse text features serves all thresholds: P(grade > k) = sigmoid(w.x - b_k) with
b_0 < b_1 < ... The output is the probability of each threshold, the expected severity (their sum), and the most
fitting grade.

Features are hashed words and, for stems with changing ends, the first letters of words, as presence (a long
text does not gain by repetition alone), scaled by how much they tell: over all labelled rows Spark counts in how
many documents of each grade a feature occurs, and a feature's scale is its smoothed log-odds of being in a
document above grade 0. Features that tell nothing have scale 0.

The counts cover all labelled rows. The weights are fitted on a bounded sample, the ``SAMPLE`` labelled rows
smallest by a hash of their id per side (grade 0 and above), reweighted to the true shares; the bound is the
parameter ``sample``. Grades come from the labels: 0 not toxic; toxic rows are split in two halves by the share of
their words that tell of toxicity, 1 for the lower and 2 for the upper half.

Defined results: a null or empty text has no features and gets the grade of the thresholds alone. Rows without a
label, or with a null label or id, are only predicted. A row labelled twice is learned twice. With nothing to
learn every row has grade 0 and severity 0. Empty tables give empty results. Only id and text of the documents
and id and label of the labels are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paypanel.llm.language import letters
from paypanel.llm.shingles import mix
from paypanel.llm.tables import hinted
from paypanel.plans.stages import written

FEATURES = 1 << 18
STEM = 5
SAMPLE = 4_000
LEAST_SCALE = 1.0
GRADES = 3


def features(text: str) -> tuple[np.ndarray, int]:
    """Distinct hashed features of a text (words, and stems of longer words), and its number of words."""
    if not text:
        return np.zeros(0, np.int64), 0
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    inside = letters()[points]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not starts.size:
        return np.zeros(0, np.int64), 0
    lengths = ends - starts
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    step = np.multiply.accumulate(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    values = mix(points[inside].astype(np.uint64)) * step[place]
    first = np.cumsum(lengths) - lengths
    words = np.add.reduceat(values, first)
    stems = np.add.reduceat(np.where(place < STEM, values, np.uint64(0)), first)[lengths > STEM]
    hashed = np.concatenate((mix(words + lengths.astype(np.uint64)), mix(stems ^ np.uint64(0xA5A5A5A5))))
    return np.unique(hashed >> np.uint64(64 - 18)).astype(np.int64), int(starts.size)


def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (toxic, text) to rows (feature, clean, toxic): documents with the feature, folded over the task."""
    held = np.zeros((2, FEATURES + 1), np.int64)  # the last column counts documents
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found, _ = features(text or "")
            held[int(toxic)][found] += 1
            held[int(toxic)][FEATURES] += 1
    at = np.flatnonzero(held.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[0][at]), pa.array(held[1][at])], names=["feature", "clean", "toxic"])


def sample_task(scale: np.ndarray):
    """Rows (toxic, text) to rows (toxic, share of telling words, features that tell)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share, told = [], []
            for text in batch.column(1).to_pylist():
                found, words = features(text or "")
                found = found[scale[found] != 0]
                told.append(found.astype(np.int32))
                share.append(float((scale[found] > 0).sum()) / max(words, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(share, pa.float64()), pa.array(told, pa.list_(pa.int32()))],
                names=["toxic", "share", "features"],
            )

    return run


@dataclass
class Model:
    weights: np.ndarray  # per feature, scale included
    cuts: np.ndarray  # one per threshold, increasing

    def passed(self, found: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return 1.0 / (1.0 + np.exp(np.clip(self.cuts - self.weights[found].sum(), -500, 500)))


def fit(rows: list[np.ndarray], grade: np.ndarray, weight: np.ndarray, scale: np.ndarray, grades: int, rounds: int = 400) -> Model:
    """Maximum likelihood of the cumulative-link model with a small penalty, by accelerated gradient steps.

    The cuts are a first value and positive gaps, so they stay in order; the weights are shared by all of them.
    """
    used = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.int64)
    column = np.full(FEATURES, -1, np.int64)
    column[used] = np.arange(used.size)
    lengths = np.array([r.size for r in rows])
    doc = np.repeat(np.arange(len(rows)), lengths)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    col, value = column[flat], scale[flat]
    weight = weight / weight.sum()
    beta = np.zeros(used.size)
    first, gaps = 0.0, np.zeros(grades - 2)
    moment = [np.zeros(used.size), 0.0, np.zeros(grades - 2)]
    speed = [np.zeros(used.size), 0.0, np.zeros(grades - 2)]
    for step in range(1, rounds + 1):
        cuts = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        score = np.bincount(doc, weights=value * beta[col], minlength=len(rows))
        passed = 1.0 / (1.0 + np.exp(np.clip(cuts[None, :] - score[:, None], -500, 500)))
        padded = np.concatenate((np.ones((len(rows), 1)), passed, np.zeros((len(rows), 1))), axis=1)
        at = np.arange(len(rows))
        p = np.maximum(padded[at, grade] - padded[at, grade + 1], 1e-9)
        slope = padded * (1 - padded)
        up, down = slope[at, grade], slope[at, grade + 1]  # by the lower and the upper cut of the grade
        by_score = weight * (up - down) / p
        by_cut = np.zeros(grades - 1)
        np.add.at(by_cut, np.maximum(grade - 1, 0), np.where(grade > 0, -weight * up / p, 0.0))
        np.add.at(by_cut, np.minimum(grade, grades - 2), np.where(grade < grades - 1, weight * down / p, 0.0))
        by_beta = np.bincount(col, weights=value * by_score[doc], minlength=used.size) - 1e-4 * beta
        by_gaps = np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(gaps)
        new = []
        for k, (old, grad) in enumerate(zip((beta, first, gaps), (by_beta, by_cut.sum(), by_gaps))):
            moment[k] = 0.9 * moment[k] + 0.1 * grad
            speed[k] = 0.999 * speed[k] + 0.001 * grad * grad
            new.append(old + 0.05 * (moment[k] / (1 - 0.9**step)) / (np.sqrt(speed[k] / (1 - 0.999**step)) + 1e-8))
        beta, first, gaps = new
    weights = np.zeros(FEATURES)
    weights[used] = beta * scale[used]
    return Model(weights, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> Model:
    """The model of the labelled documents (doc_id, toxic of ``labels``)."""
    known = labels.where("doc_id is not null and toxic is not null").select("doc_id", (F.col("toxic") > 0).cast("int").alias("_toxic"))
    texts = docs.select(F.col("doc_id"), F.col(text_col).alias("_text"))
    rows = texts.join(hinted(known, 24), "doc_id")
    counts = (
        rows.select("_toxic", "_text")
        .mapInArrow(count_task, "feature long, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toArrow()
    )
    seen = np.zeros((2, FEATURES + 1))
    at = counts.column("feature").to_numpy()
    seen[0][at], seen[1][at] = counts.column("clean").to_numpy(), counts.column("toxic").to_numpy()
    clean, toxic = seen[0][FEATURES], seen[1][FEATURES]
    if not clean or not toxic:
        return Model(np.zeros(FEATURES), np.full(GRADES - 1, 500.0))
    odds = np.log((seen[1][:-1] + 0.5) / (toxic + 1)) - np.log((seen[0][:-1] + 0.5) / (clean + 1))
    # the log-odds, less one standard error towards zero, so that rare features do not tell by chance
    error = np.sqrt(1 / (seen[1][:-1] + 0.5) + 1 / (seen[0][:-1] + 0.5))
    scale = np.sign(odds) * np.maximum(np.abs(odds) - error, 0.0)
    scale[np.abs(scale) < LEAST_SCALE] = 0.0

    # the sample is drawn from the labels, and only its documents are read again
    parts = [known.where(f"_toxic = {side}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for side in (0, 1)]
    drawn = written(parts[0].unionByName(parts[1]), "toxic-sample")
    picked = written(texts.join(F.broadcast(drawn), "doc_id").select("_toxic", "_text"), "toxic-texts")  # at most 2 * sample rows
    found = picked.mapInArrow(sample_task(scale), "toxic int, share double, features array<int>").toArrow()
    side = found.column("toxic").to_numpy()
    share = found.column("share").to_numpy()
    told = [np.asarray(x, np.int64) for x in found.column("features").to_pylist()]
    if not (side == 0).any() or not (side == 1).any():
        return Model(np.zeros(FEATURES), np.full(GRADES - 1, 500.0))
    middle = float(np.median(share[side == 1]))
    grade = np.where(side == 0, 0, np.where(share > middle, 2, 1)).astype(np.int64)
    weight = np.where(side == 1, toxic / (side == 1).sum(), clean / (side == 0).sum())
    return fit(told, grade, weight, scale, GRADES)


def score_task(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            passed = np.array([model.passed(features(t or "")[0]) for t in texts]).reshape(len(texts), model.cuts.size)
            shares = -np.diff(np.concatenate((np.ones((len(texts), 1)), passed, np.zeros((len(texts), 1))), axis=1), axis=1)
            keys = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    *keys,
                    pa.array(shares.argmax(1), pa.int32()),
                    pa.array(np.round(passed.sum(1), 6), pa.float64()),
                    pa.array(np.round(passed[:, 0], 6), pa.float64()),
                    pa.array(passed[:, 0] >= 0.5, pa.bool_()),
                ],
                names=[*batch.schema.names[:-1], "severity", "expected_severity", "score", "toxic"],
            )

    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Per row: doc_id, severity (grade), expected_severity, score (probability of any toxicity), toxic."""
    rows = docs.select("doc_id", F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        score_task(model), f"doc_id {kind}, severity int, expected_severity double, score double, toxic boolean"
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(docs, learn(docs, labels))
