"""Toxicity by logistic regression that is held to equal scores for swapped identity terms.

Features say which words, and which beginnings of words, a text has. Every labelled text of the
sample that names a group gets a counterfactual in which the terms are exchanged for others of
their set; the loss adds the squared difference of both scores, so that a mention of a group
carries no weight of its own. The fit reads a bounded sample of labelled texts
(``max_rows``), copies once; scoring covers every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import durable, slices, texts_of

THRESHOLD = 0.3
#: Bounds of what the fit reads: labelled texts, and features kept of those found in them.
MAX_ROWS, MAX_FEATURES = 20_000, 4_096
#: A feature needs so many texts.
LEAST_TEXTS = 3
WORDS_KEPT = 300_000
PREFIXES = (4, 5)
LETTERS = re.compile(r"[^\W\d_]+")
#: Sets of terms that may stand for each other, by language.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "refugees", "natives", "foreigners"),
    ("old", "young"), ("deaf", "blind", "disabled"),
    ("frauen", "männer"), ("muslime", "christen", "juden", "hindus"), ("ausländer", "flüchtlinge", "deutsche"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "réfugiés", "français"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "refugiados", "españoles"),
)


def swaps(terms: tuple[tuple[str, ...], ...]) -> dict[str, str]:
    """The next term of its set for each term."""
    return {a: b for group in terms for a, b in zip(group, group[1:] + group[:1])}


def word_features(word: str) -> list[str]:
    """The word, and its beginnings, which carry a mark that no word has."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def features(words: set[str]) -> set[str]:
    return {f for w in words for f in word_features(w)}


@dataclass
class Model:
    """Weight of each kept feature; an intercept."""

    weights: dict[str, float]
    intercept: float


def sample(labels: DataFrame, label: str, key: str, max_rows: int) -> DataFrame:
    """``key, y`` of at most ``max_rows`` ids in hash order; of several labels of an id the highest."""
    y = F.col(label).cast("int")
    one = labels.where(y.isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(y).alias("y"))
    return one.orderBy(F.xxhash64(F.lit(5), "key"), "key").limit(max_rows)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, max_rows: int) -> DataFrame:
    """``key, y, text`` of at most ``max_rows`` different texts of sampled ids.

    Each id gives one text first; then further texts of repeated ids follow in hash order while
    there is room. Nulls count as empty texts.
    """
    # At most max_rows narrow rows, which is the bound of each broadcast here.
    few = F.broadcast(sample(labels, label, key, max_rows))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(few, "key")
    rows = rows.select("key", "y", F.xxhash64("text").alias("place"), "text")
    pairs = durable(rows.select("key", "place").distinct())
    first = F.broadcast(pairs.groupBy("key").agg(F.min("place").alias("first")))
    taken = pairs.join(first, "key").orderBy(F.col("place") != F.col("first"), F.xxhash64(F.lit(5), "key", "place"), "key", "place").limit(max_rows)
    return durable(rows.join(F.broadcast(taken.select("key", "place")), ["key", "place"]).groupBy("key", "place").agg(
        F.first("y").alias("y"), F.min("text").alias("text"))).select("key", "y", "text")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
          terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, max_rows: int = MAX_ROWS,
          max_features: int = MAX_FEATURES, fairness: float = 1.0) -> Model:
    """Fit on the texts of a sample of ``labels``; without rows of both labels, all scores are the base rate."""
    rows = labelled_texts(docs, labels, label, key, text, max_rows)
    other = swaps(terms)
    always = {f for t in other for f in word_features(t)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for part in slices(batches):
            for t, y in zip(texts_of(part), part.column("y").to_pylist()):
                found[y][""] += 1
                found[y].update(features(set(LETTERS.findall(t.lower()))))
        for y, counter in enumerate(found):
            yield pa.RecordBatch.from_arrays([pa.array(list(counter), pa.string()), pa.array([y] * len(counter), pa.int32()), pa.array(list(counter.values()), pa.int64())],
                                             names=["feature", "y", "n"])

    counts = rows.mapInArrow(count, "feature string, y int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("neg")).cache()
    try:
        size = counts.where("feature = ''").first()
        pos, neg = (size["pos"], size["neg"]) if size else (0, 0)
        if not pos or not neg:
            rate = (pos + 0.5) / (pos + neg + 1.0)
            return Model({}, float(np.log(rate / (1 - rate))))
        a, b = F.col("pos") + 0.5, F.col("neg") + 0.5
        gap = F.abs(F.log(a / (pos + 1 - a)) - F.log(b / (neg + 1 - b)))
        noise = F.sqrt(1 / a + 1 / b)
        kept = (counts.where((F.col("feature") != "") & (F.col("pos") + F.col("neg") >= LEAST_TEXTS)).select("feature", (gap / noise).alias("z"))
                .orderBy(F.desc("z"), "feature").limit(max_features).toArrow())
    finally:
        counts.unpersist()
    chosen = sorted({*kept.column("feature").to_pylist(), *always})
    place = {f: i for i, f in enumerate(chosen)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            own, swapped = [], []
            for t in texts_of(part):
                words = set(LETTERS.findall(t.lower()))
                own.append(sorted(place[f] for f in features(words) if f in place))
                turned = {other.get(w, w) for w in words} if not words.isdisjoint(other) else None
                swapped.append(turned and sorted(place[f] for f in features(turned) if f in place))
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("y"), pa.array(own, pa.list_(pa.int32())), pa.array(swapped, pa.list_(pa.int32()))],
                                             names=["key", "y", "own", "swapped"])

    kind = rows.schema["key"].dataType.simpleString()
    table = rows.mapInArrow(encode, f"key {kind}, y int, own array<int>, swapped array<int>").orderBy("key", "own").toArrow()
    y = table.column("y").to_numpy().astype(float)
    weights, intercept = fit(lists(table.column("own")), y, lists(table.column("swapped")), len(chosen), fairness)
    return Model({f: float(w) for f, w in zip(chosen, weights) if w}, intercept)


def lists(column: pa.ChunkedArray) -> list[np.ndarray | None]:
    return [None if v is None else np.array(v, np.int64) for v in column.to_pylist()]


def fit(own: list[np.ndarray], y: np.ndarray, swapped: list[np.ndarray | None], size: int, fairness: float,
        ridge: float = 3e-4, rounds: int = 400, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise log loss, ridge and ``fairness`` times the squared swap gaps (Adam)."""
    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([np.zeros(0, np.int64), *rows])

    row, col = flat(own)
    pairs = [i for i, s in enumerate(swapped) if s is not None]
    plus_row, plus_col = flat([own[i] for i in pairs])
    minus_row, minus_col = flat([swapped[i] for i in pairs])
    n, w, b = len(y), np.zeros(size), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(b + np.bincount(row, w[col], n))))
        error = (p - y) / n
        grad = np.bincount(col, error[row], size) + ridge * w
        if pairs:
            gap = np.bincount(plus_row, w[plus_col], len(pairs)) - np.bincount(minus_row, w[minus_col], len(pairs))
            pull = 2 * fairness * gap / len(pairs)
            grad += np.bincount(plus_col, pull[plus_row], size) - np.bincount(minus_col, pull[minus_row], size)
        full = np.r_[grad, error.sum()]
        mean, square = 0.9 * mean + 0.1 * full, 0.999 * square + 0.001 * full ** 2
        move = rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


class Tokens(dict):
    """Model features of white-space tokens, filled as tokens turn up."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> tuple[str, ...]:
        found = {f for w in LETTERS.findall(token) for f in word_features(w) if f in self.weights}
        value = self[token] = tuple(found)
        return value


def scorer(model: Model):
    """A function from texts to scores that remembers tokens."""
    state = [Tokens(model.weights)]

    def score(texts: list[str]) -> np.ndarray:
        if len(state[0]) > WORDS_KEPT:
            state[0] = Tokens(model.weights)
        known, weights = state[0], model.weights
        sums = [sum(weights[f] for f in sorted(set().union(*map(known.__getitem__, set(t.lower().split()))))) for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(sums, float) + model.intercept, -500, 500)))

    return score


def score_texts(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and ``score`` per row of ``df``; null and empty texts get the score of the intercept."""
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared.value)
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(score(texts_of(part)))], names=["key", "score"])

    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)


def drop_toxic(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``df`` whose text scores below ``threshold``, with all columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared.value)
        for part in slices(batches, text):
            yield part.filter(pa.array(score(texts_of(part, text)) < threshold))

    return df.mapInArrow(run, df.schema)
