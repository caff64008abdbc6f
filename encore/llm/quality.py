"""Quality classifier: supervised subword embeddings, trained by numpy stochastic gradient descent.

A document is the mean of the learned vectors of all its words and of the character n-grams of its words (hashed into
fixed tables), and a softmax over two classes follows. A word that repeats the one before it adds a vector of its own,
the same for all words, as text stuck on a word is junk whatever the word. As the output is linear in the mean, a trained model is one number
per table row: what that row adds to the log odds. Scoring looks each distinct word of a batch up once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.decontaminate import mixed, powers
from encore.llm.words import segment_sums, slices, split_words, texts_of

ROWS_BITS = 16
GRAMS = (3, 4, 5)
DIM = 8
PER_CLASS = 1000
EPOCHS = 5
RATE = 0.5
BATCH = 16
FOLDS = 5
THRESHOLD = 0.3
REPEAT = 2 << ROWS_BITS
PART = 16_384  # words whose n-grams are cut at a time
# A repeated word counts as many vectors as a word has n-grams, about.
REPEAT_WEIGHT = 16


def held_out(key: str = "doc_id", folds: int = FOLDS) -> Column:
    """Whether crc32 of the key as text leaves no remainder; a null key is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def subwords(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(edges of each distinct word, table rows): the word's own row, then its n-grams with `<` and `>` around it."""
    parts = [_subwords(words.slice(at, PART)) for at in range(0, len(words), PART)]
    counts = np.concatenate([np.zeros(1, np.int64), *(np.diff(edges) for edges, _ in parts)])
    return np.cumsum(counts), np.concatenate([np.zeros(0, np.int32), *(rows for _, rows in parts)])


def _subwords(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    text = pc.binary_join_element_wise("<", pc.cast(words, pa.string()), ">", "")
    lengths = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    letters = np.frombuffer("".join(text.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    size = 1 << ROWS_BITS
    word = np.repeat(np.arange(len(words)), lengths)
    with np.errstate(over="ignore"):
        place = np.arange(len(letters)) - edges[word]
        terms = (letters + np.uint64(1)) * powers(int(lengths.max()))[place]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        own = mixed(sums[edges[1:]] - sums[edges[:-1]])
        rows = [(own % np.uint64(size)).astype(np.int64) + size]
        owner = [np.arange(len(words))]
        for n in GRAMS:
            count = len(letters) - n + 1
            if count <= 0:
                continue
            weights = powers(n)
            total = np.full(count, np.uint64(n), np.uint64)
            for at in range(n):
                total += (letters[at : at + count] + np.uint64(1)) * weights[at]
            inside = word[:count] == word[n - 1 :]
            rows.append((mixed(total[inside]) % np.uint64(size)).astype(np.int64))
            owner.append(word[:count][inside])
    owner, rows = np.concatenate(owner), np.concatenate(rows)
    order = np.argsort(owner, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))]), rows[order].astype(np.int32)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one range after the other."""
    lengths = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())


def repeats(edges: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Per text, how many words equal the word before them."""
    same = np.zeros(len(codes), np.int64)
    same[1:] = codes[1:] == codes[:-1]
    starts = edges[:-1]
    same[starts[starts < len(codes)]] = 0
    return segment_sums(same, edges)


@dataclass
class Model:
    """Log odds per table row, and the constant."""

    odds: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        edges, codes, words = split_words(texts)
        word_edges, rows = subwords(words)
        per_word = segment_sums(self.odds[rows].astype(np.float64), word_edges)
        counts = np.diff(word_edges)
        again = REPEAT_WEIGHT * repeats(edges, codes)
        total = segment_sums(per_word[codes], edges) + again * float(self.odds[REPEAT])
        many = segment_sums(counts[codes], edges) + again
        return 1 / (1 + np.exp(-np.clip(self.bias + total / np.maximum(1, many), -60, 60)))


def train(texts: list[str], labels: np.ndarray, prior: float, seed: int = 11) -> Model:
    """Fit on texts with labels 0 and 1; `prior` is the share of label 1 that scores should assume.

    With one class only, the score is the prior for every text.
    """
    if len(set(labels.tolist())) < 2:
        prior = min(max(prior, 0.01), 0.99)
        return Model(np.zeros(REPEAT + 1, np.float32), float(np.log(prior / (1 - prior))))
    random = np.random.default_rng(seed)
    edges, codes, words = split_words(texts_of(pa.array(texts, pa.large_string())))
    word_edges, rows = subwords(words)
    grams = np.diff(word_edges)
    table = ((random.random((REPEAT + 1, DIM)) - 0.5) / DIM).astype(np.float32)
    out = np.zeros((DIM, 2), np.float32)
    constant = np.zeros(2, np.float32)
    share = labels.mean()
    weight = np.where(labels == 1, prior / share, (1 - prior) / (1 - share)).astype(np.float32)
    again = REPEAT_WEIGHT * repeats(edges, codes)
    many = np.maximum(1, segment_sums(grams[codes], edges) + again).astype(np.float32)
    steps, step = EPOCHS * -(-len(texts) // BATCH), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            where = np.repeat(np.arange(len(docs)), edges[docs + 1] - edges[docs])
            used, place = np.unique(codes[_ranges(edges[docs], edges[docs + 1])], return_inverse=True)
            counts = np.bincount(where * len(used) + place, minlength=len(docs) * len(used)).reshape(len(docs), -1).astype(np.float32)
            counts /= many[docs][:, None]
            cells = rows[_ranges(word_edges[used], word_edges[used + 1])]
            inner = np.concatenate([[0], np.cumsum(grams[used])])
            vectors = np.add.reduceat(table[cells], inner[:-1], axis=0) if len(used) else np.zeros((0, DIM), np.float32)
            stuck = (again[docs] / many[docs])[:, None].astype(np.float32)
            means = counts @ vectors + stuck * table[REPEAT]
            logits = means @ out + constant
            chances = np.exp(logits - logits.max(axis=1, keepdims=True))
            chances /= chances.sum(axis=1, keepdims=True)
            error = chances
            error[np.arange(len(docs)), labels[docs]] -= 1
            error *= weight[docs][:, None]
            pull = error @ out.T
            back = counts.T @ pull
            table[REPEAT] -= rate * (stuck * pull).sum(axis=0)
            out -= rate * means.T @ error
            constant -= rate * 0.1 * error.sum(axis=0)
            np.add.at(table, cells, -rate * np.repeat(back, grams[used], axis=0))
    return Model((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(constant[1] - constant[0]))


def fit_on_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int, folds: int) -> Model:
    """Fit on at most `per_class` labelled documents of each class, the first by a hash of the key, whole texts.

    Rows of the held-out fold are never read. Labels other than 0 and 1 count as no label; a document labelled twice
    has its larger label. Only the sample reaches the driver.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out(key, folds) & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_label"))
    totals = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    sample = None
    for value in (0, 1):
        part = known.filter(F.col("_label") == value).orderBy(F.xxhash64("_key"), "_key").limit(per_class)
        sample = part if sample is None else sample.union(part)
    narrow = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = narrow.join(sample, narrow["_id"] == sample["_key"]).select("_id", "_label", "_text")
    first = rows.groupBy("_id").agg(F.min("_label").alias("_label"), F.min("_text").alias("_text")).collect()
    first.sort(key=lambda r: r["_id"])
    total = max(1, sum(totals.values()))
    return train([r["_text"] for r in first], np.array([r["_label"] for r in first], np.int64), totals.get(1, 0) / total)


def _score_batches(model, column: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, column):
                scores = model.value.score(texts_of(batch.column(column)))
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(scores)], [*keep, "_score"])

    return run


def score_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_class: int = PER_CLASS, folds: int = FOLDS,
) -> DataFrame:
    """`docs` with columns held_out, score and predicted; earlier columns of those names go.

    The score depends on the text alone. Edge cases: null and empty texts get the score of no words (the constant).
    Very long texts are read whole. Repeated rows stay, each scored. Without labels the score is 0.01 for every text,
    and with one class the share of label 1 (within 0.01 and 0.99). An empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_on_sample(docs, labels, key, text, label, per_class, folds))
    docs = docs.drop("held_out", "score", "predicted")
    keep = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    scored = docs.mapInArrow(_score_batches(model, text, keep), f"{schema}, _score double")
    return scored.select(
        *keep, held_out(key, folds).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
