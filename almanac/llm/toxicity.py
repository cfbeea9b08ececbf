"""Toxicity by bags of subwords: character n-grams have vectors, a text is the mean of its vectors, and a linear
softmax tells the classes apart. Vectors and softmax are trained jointly, in numpy, on a bounded sample of labelled
texts. A misspelling that was never seen shares most of its n-grams with the word it comes from.

Since the softmax is linear, each n-gram ends up with one number, its share in the difference of the two logits.
Scoring adds these up, word by word, in tasks that remember the words they have met.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import bound_batches, text_of

#: Lengths of character n-grams of a word between its marks < and >, and the buckets that they are hashed into.
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
DIMENSIONS = 8
EPOCHS = 6
BATCH = 64
RATE = 0.5
SEED = 17
#: At most this many labelled texts of each class are sampled for training; scoring always covers all rows.
SAMPLE = 3_000
#: N-grams without weight that every mean includes, so that few words decide little.
PADDING = 150
#: Labelled texts longer than this are not sampled for training.
SAMPLE_CHARS = 50_000
#: Words whose n-grams a task remembers.
KNOWN_WORDS = 400_000

_WORD = re.compile(r"\w+")


def word_grams(word: str) -> list[int]:
    """Buckets of a word's n-grams; of a short word, at least the word with its marks."""
    marked = f"<{word}>".encode("utf-16-le")  # two bytes a character
    size = len(marked)
    grams = {marked[i : i + 2 * n] for n in GRAMS for i in range(0, size - 2 * n + 1, 2)} or {marked}
    return [b & (BUCKETS - 1) for b in map(zlib.crc32, grams)]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Model:
    """Share of each bucket in the difference of the logits, and the difference of the biases."""

    weights: np.ndarray
    bias: float


class Scorer:
    """Scores texts, remembering the words that it met: sums of n-gram weights and numbers of n-grams."""

    def __init__(self, model: Model):
        self.weights, self.bias = model.weights.tolist(), model.bias
        self.sums: dict[str, float] = {}
        self.sizes: dict[str, int] = {}

    def scores(self, texts: Iterable[str]) -> list[float]:
        """Probabilities of label 1. A text without words has only the bias."""
        out, weight, sums, sizes = [], self.weights.__getitem__, self.sums, self.sizes
        for text in texts:
            words = words_of(text)
            for w in set(words).difference(sums):
                grams = word_grams(w)
                sums[w] = sum(map(weight, grams))
                sizes[w] = len(grams)
            total, size = sum(map(sums.__getitem__, words)), sum(map(sizes.__getitem__, words))
            logit = self.bias + total / (size + PADDING)
            out.append(float(1 / (1 + np.exp(-np.clip(logit, -500, 500)))))
            if len(sums) > KNOWN_WORDS:
                sums.clear()
                sizes.clear()
        return out


def _bags(texts: Iterable[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its buckets and their shares among its n-grams; eight bytes per distinct bucket stay in memory."""
    bags = []
    for text in texts:
        words = Counter(words_of(text))
        grams = [word_grams(w) for w in words]
        flat = np.fromiter(chain.from_iterable(grams), np.int32)
        times = np.repeat(np.fromiter(words.values(), np.int64), [len(g) for g in grams])
        buckets, at = np.unique(flat, return_inverse=True)
        share = np.bincount(at, times, len(buckets)) / (times.sum() + PADDING)
        bags.append((buckets, share.astype(np.float32)))
    return bags


def train(
    texts: list[str],
    labels: list[int],
    weights: tuple[float, float] = (1.0, 1.0),
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = SEED,
) -> Model:
    """Joint training of n-gram vectors and softmax by Adagrad; weights: how much a text of each class counts."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.int64)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    linear = rng.normal(0, 0.1, (DIMENSIONS, 2))
    bias = np.zeros(2)
    seen_v, seen_l, seen_b = np.full(BUCKETS, 1e-8), np.full((DIMENSIONS, 2), 1e-8), np.full(2, 1e-8)
    balance = np.asarray(weights) * len(y) / np.asarray(weights)[y].sum()
    bags = _bags(texts)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            flat = np.concatenate([bags[r][0] for r in rows])
            share = np.concatenate([bags[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(bags[r][0]) for r in rows])
            mean = np.stack([np.bincount(owner, share * vectors[flat, d], len(rows)) for d in range(DIMENSIONS)], axis=1)
            logits = mean @ linear + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= (balance[y[rows]] / len(rows))[:, None]
            back = p @ linear.T
            used, at = np.unique(flat, return_inverse=True)
            slope = np.stack([np.bincount(at, share * back[owner, d], len(used)) for d in range(DIMENSIONS)], axis=1)
            step_l, step_b = mean.T @ p, p.sum(axis=0)
            seen_v[used] += (slope**2).mean(axis=1)
            vectors[used] -= rate * slope / np.sqrt(seen_v[used])[:, None]
            seen_l += step_l**2
            linear -= rate * step_l / np.sqrt(seen_l)
            seen_b += step_b**2
            bias -= rate * step_b / np.sqrt(seen_b)
    side = linear[:, 1] - linear[:, 0]
    return Model(vectors @ side, float(bias[1] - bias[0]))


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of documents that training never sees, by the checksum of the id as text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, size: int = SAMPLE):
    """Texts and labels for training, and each class's weight: of each class up to ``size`` labelled ids, those with
    the least hashes; a weight is the labelled number over the sampled number."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    known = known.groupBy(F.col(doc_id).alias("__id")).agg(F.max(F.col(label).cast("int")).alias("__y"))
    ranked = known.withColumn("__h", F.xxhash64("__id"))
    parts = [ranked.filter(F.col("__y") == y).orderBy("__h", "__id").limit(size) for y in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))  # 2 x size rows
    rows = docs.select(F.col(doc_id).alias("__id"), text_of(text).alias("__text"))
    rows = rows.filter(F.length("__text") <= SAMPLE_CHARS).join(chosen, "__id")
    rows = rows.groupBy("__h", "__id", "__y").agg(F.min("__text").alias("t")).orderBy("__h", "__id")
    found = rows.select("t", "__y").collect()
    shares = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}
    drawn = [sum(r[1] == y for r in found) for y in (0, 1)]
    weights = tuple(shares.get(y, 0) / max(drawn[y], 1) for y in (0, 1))
    return [r[0] for r in found], [r[1] for r in found], weights


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "toxic",
    size: int = SAMPLE,
    **options,
) -> Model:
    """Trains on rows whose id is not held out; a class that was sampled more thinly counts more. An id with both
    labels counts as toxic. Without both classes, all weights stay zero."""
    texts, y, weights = sample(docs, labels, text, doc_id, label, size)
    if len(set(y)) < 2:
        return Model(np.zeros(BUCKETS), 0.0)
    return train(texts, y, weights, **options)


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: doc_id, held_out, score and predicted. A null text counts as empty; a row without an id counts as
    not held out; repeated rows are scored each."""
    bound_batches(docs.sparkSession)
    light = Model(model.weights.astype(np.float32), model.bias)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(light)
        for texts in batches:
            yield pd.Series(scorer.scores(texts), dtype="float64")

    scored = docs.select(
        F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), scores.asNondeterministic()(text_of(text)).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
