"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features of a document are the distinct hashed words and word beginnings of its lower-cased text, so inflected forms of
one stem share a feature. All thresholds share one weight per feature:

    P(grade > k) = sigmoid(sum of weights of the features present - threshold_k),   threshold_0 < threshold_1 < ...

and the expected severity is the sum of these chances over k. Labels that only say toxic or not are graded first: a
toxic document is of the higher grade if it holds more marked features than half of the toxic ones do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.decontaminate import word_hashes
from encore.llm.quality import held_out
from encore.llm.words import slices, split_words, texts_of

ROWS_BITS = 20
BEGINNINGS = (4, 5, 6, 7)
PER_CLASS = 1500
FOLDS = 5
LEAST_DOCUMENTS = 3
EPOCHS = 150
RATE = 0.3
DECAY = 1e-4
THRESHOLD = 0.5


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features per distinct word, table rows): the word stripped of marks at its ends, and its beginnings."""
    bare = pc.utf8_trim(pc.cast(words, pa.large_string()), ".,;:!?\"'()[]{}|#$%&*")
    letters = pc.utf8_length(bare).to_numpy(zero_copy_only=False)
    row, many = [], np.zeros(len(words), np.int64)
    owner = []
    limit = np.uint64((1 << ROWS_BITS) - 1)
    for salt, part in [(0, bare), *((n, pc.utf8_slice_codeunits(bare, 0, n)) for n in BEGINNINGS)]:
        usable = np.flatnonzero((letters > 0) if salt == 0 else (letters >= salt))
        hashes = word_hashes(part.take(pa.array(usable)))
        with np.errstate(over="ignore"):
            row.append(((hashes + np.uint64(salt) * np.uint64(0x632BE59BD9B4E019)) >> np.uint64(40) & limit).astype(np.int64))
        owner.append(usable)
        many[usable] += 1
    order = np.argsort(np.concatenate(owner), kind="stable")
    return many, np.concatenate(row)[order]


def present(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature), each pair once; only features marked in `wanted` if given."""
    edges, codes, words = split_words(pc.ascii_lower(texts))
    many, rows = features(words)
    ends = np.cumsum(many)
    if wanted is not None:
        keep = wanted[rows]
        many = np.bincount(np.repeat(np.arange(len(many)), many)[keep], minlength=len(many))
        rows, ends = rows[keep], np.cumsum(many)
    document = np.repeat(np.arange(len(texts)), np.diff(edges))
    if wanted is not None:
        used = many[codes] > 0
        document, codes = document[used], codes[used]
    count = many[codes]
    starts = (ends - many)[codes]
    place = np.repeat(starts - np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64), count) + np.arange(count.sum()) if len(codes) else np.zeros(0, np.int64)
    pairs = np.unique(np.repeat(document, count) * (1 << ROWS_BITS) + rows[place])
    return pairs >> ROWS_BITS, pairs & ((1 << ROWS_BITS) - 1)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(expected severity, chance of any grade above the lowest)."""
        document, rows = present(texts, self.weights != 0)
        total = np.bincount(document, self.weights[rows], len(texts))
        chances = 1 / (1 + np.exp(-np.clip(total[:, None] - self.thresholds, -60, 60)))
        return chances.sum(axis=1), chances[:, 0]


def graded(toxic: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Grades 0, 1 and 2 from labels and the number of marked features."""
    if not (toxic == 1).any():
        return toxic * 0
    return np.where(toxic == 1, 1 + (marks > np.median(marks[toxic == 1])), 0)


def fit_ordinal(document: np.ndarray, rows: np.ndarray, grades: np.ndarray, weight: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds by gradient descent on the likelihood of cumulative links.

    The gap between thresholds is kept positive by learning its logarithm.
    """
    levels = int(grades.max(initial=0))
    weights, first, gaps = np.zeros(size), 1.0, np.zeros(max(0, levels - 1))
    above = (grades[:, None] > np.arange(max(1, levels))).astype(float)
    spread = np.zeros(size) + 1e-8
    for step in range(EPOCHS):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        total = np.bincount(document, weights[rows], len(grades))
        over = 1 / (1 + np.exp(-np.clip(total[:, None] - thresholds, -30, 30)))
        # The likelihood of a grade is the difference of two neighbouring links.
        padded = np.concatenate([np.ones((len(grades), 1)), over, np.zeros((len(grades), 1))], axis=1)
        chance = np.maximum(padded[np.arange(len(grades)), grades] - padded[np.arange(len(grades)), grades + 1], 1e-9)
        slope = np.concatenate([np.zeros((len(grades), 1)), over * (1 - over), np.zeros((len(grades), 1))], axis=1)
        upper, lower = slope[np.arange(len(grades)), grades], slope[np.arange(len(grades)), grades + 1]
        pull = weight * (upper - lower) / chance
        gradient = np.bincount(rows, pull[document], size) / max(1, len(grades)) - DECAY * weights
        spread += gradient * gradient
        weights += RATE * gradient / np.sqrt(spread)
        by_level = np.zeros_like(above)
        np.add.at(by_level, (np.flatnonzero(grades > 0), grades[grades > 0] - 1), (-weight * upper / chance)[grades > 0])
        inner = grades < by_level.shape[1]
        np.add.at(by_level, (np.flatnonzero(inner), grades[inner]), (weight * lower / chance)[inner])
        toward = by_level.mean(axis=0)
        first += RATE * toward.sum() * 4
        for gap in range(len(gaps)):
            gaps[gap] += RATE * toward[gap + 1 :].sum() * np.exp(gaps[gap]) * 4
    return weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def train(texts: list[str], toxic: np.ndarray, prior: float) -> Model:
    """Mark the features that toxic texts hold far more often, grade the texts, and fit on the marked features.

    Without toxic texts no feature counts and the thresholds say the prior.
    """
    size = 1 << ROWS_BITS
    prior = min(max(prior, 0.001), 0.999)
    if len(set(toxic.tolist())) < 2:
        level = float(np.log((1 - prior) / prior))
        return Model(np.zeros(size), np.array([level, level + 1.0]))
    document, rows = present(texts_of(pa.array(texts, pa.large_string())))
    bad = np.bincount(rows[toxic[document] == 1], minlength=size)
    good = np.bincount(rows[toxic[document] == 0], minlength=size)
    here, there = (toxic == 1).sum(), (toxic == 0).sum()
    expected = (good + 0.5) / there * here
    marked = (bad >= LEAST_DOCUMENTS) & (bad - expected > 3 * np.sqrt(expected)) & (bad / here > 10 * (good + 0.1) / there)
    keep = marked[rows]
    document, rows = document[keep], rows[keep]
    used, codes = np.unique(rows, return_inverse=True)
    grades = graded(toxic, np.bincount(document, minlength=len(texts)))
    share = here / len(toxic)
    weight = np.where(toxic == 1, prior / share, (1 - prior) / (1 - share))
    weight = np.where(toxic == 1, np.maximum(weight, 0.3), weight)
    fitted, thresholds = fit_ordinal(document, codes, grades, weight, len(used))
    weights = np.zeros(size)
    weights[used] = fitted
    if len(thresholds) < 2:
        thresholds = np.concatenate([thresholds, thresholds[-1:] + 1.0])
    return Model(weights, thresholds)


def fit_on_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int, folds: int) -> Model:
    """Fit on at most `per_class` labelled documents of each class, the first by a hash of the key, whole texts, none
    of the held-out fold. Only this sample reaches the driver."""
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out(key, folds) & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    totals = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    parts = [known.filter(F.col("_label") == v).orderBy(F.xxhash64("_key"), "_key").limit(per_class) for v in (0, 1)]
    narrow = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    sample = parts[0].union(parts[1])
    rows = narrow.join(sample, narrow["_id"] == sample["_key"]).select("_id", "_label", "_text")
    rows = rows.groupBy("_id").agg(F.min("_label").alias("_label"), F.min("_text").alias("_text")).collect()
    rows.sort(key=lambda r: r["_id"])
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    return train([r["_text"] for r in rows], np.array([r["_label"] for r in rows], np.int64), prior)


def _score(model, column: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, column):
                severity, chance = model.value.severity(texts_of(batch.column(column)))
                kept = [batch.column(n) for n in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(severity), pa.array(chance)], [*keep, "severity", "score"])

    return run


def score_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    per_class: int = PER_CLASS, folds: int = FOLDS,
) -> DataFrame:
    """(key, held_out, severity, score, predicted): expected severity from 0 to 2, the chance of any grade above 0, and
    1 if that is at least a half.

    Edge cases: null, empty and very short texts have no features and the lowest severity. Repeated rows each get a row;
    other columns of docs are left out. Without toxic labels every text gets the prior. An empty table gives an empty
    result.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_on_sample(docs, labels, key, text, label, per_class, folds))
    narrow = docs.select(key, F.col(text).alias("_text"))
    kind = narrow.schema[key].dataType.simpleString()
    scored = narrow.mapInArrow(_score(model, "_text", [key]), f"`{key}` {kind}, severity double, score double")
    return scored.select(
        key, held_out(key, folds).alias("held_out"), "severity", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
