import random
import zlib

import numpy as np

from almanac.llm import toxicity

RUDE = ["worthless", "disgusting", "pathetic", "stupidity"]


def corpus(rng, n):
    plain = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(3, 9))) for _ in range(800)]
    texts, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(60, 200))]
        if i % 4 == 0:
            for _ in range(len(words) // 20):
                words[rng.randrange(len(words))] = rng.choice(RUDE)
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, labels


def test_learns_words_and_unseen_misspellings():
    rng = random.Random(1)
    texts, labels = corpus(rng, 600)
    model = toxicity.train(texts[:400], labels[:400])
    score = toxicity.Scorer(model).scores
    right = [(s >= 0.5) == bool(y) for s, y in zip(score(texts[400:]), labels[400:])]
    assert np.mean(right) >= 0.97
    clean = [t for t, y in zip(texts[400:], labels[400:]) if not y][:60]
    wrong = {"worthless": "worthlesss", "disgusting": "dissgusting", "pathetic": "pathetick", "stupidity": "stuupidity"}
    spoilt = [" ".join(w if i % 12 else rng.choice(list(wrong.values())) for i, w in enumerate(t.split())) for t in clean]
    assert np.mean(np.array(score(spoilt)) >= 0.5) >= 0.9
    assert np.mean(np.array(score(clean)) >= 0.5) <= 0.1


def test_score_is_the_softmax_of_the_mean():
    rng = random.Random(2)
    texts, labels = corpus(rng, 60)
    model = toxicity.train(texts, labels, epochs=1)
    for text, got in zip(texts, toxicity.Scorer(model).scores(texts)):
        grams = [g for w in toxicity.words_of(text) for g in toxicity.word_grams(w)]
        logit = model.bias + sum(model.weights[g] for g in grams) / (len(grams) + toxicity.PADDING)
        assert abs(got - 1 / (1 + np.exp(-logit))) < 1e-9


def test_one_step_against_a_dense_softmax():
    """Vectors, softmax and bias move as in a dense network over all buckets, with classes that count differently."""
    texts, labels = corpus(random.Random(3), 8)
    weights, rate, seed = (1.0, 3.0), 0.2, 5
    n, y = len(texts), np.array(labels)
    assert n <= toxicity.BATCH
    bags = np.zeros((n, toxicity.BUCKETS))
    for i, text in enumerate(texts):
        grams = [g for w in toxicity.words_of(text) for g in toxicity.word_grams(w)]
        for g in grams:
            bags[i, g] += 1 / (len(grams) + toxicity.PADDING)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (toxicity.BUCKETS, toxicity.DIMENSIONS))
    linear = rng.normal(0, 0.1, (toxicity.DIMENSIONS, 2))
    logits = bags @ vectors @ linear
    chances = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    counts = np.array(weights)[y] * n / np.array(weights)[y].sum()
    off = (chances - np.eye(2)[y]) * counts[:, None] / n
    slope_v, slope_l, slope_b = bags.T @ off @ linear.T, (bags @ vectors).T @ off, off.sum(axis=0)
    vectors -= rate * slope_v / np.sqrt(1e-8 + (slope_v**2).mean(axis=1, keepdims=True))
    linear -= rate * slope_l / np.sqrt(1e-8 + slope_l**2)
    bias = -rate * slope_b / np.sqrt(1e-8 + slope_b**2)
    side = linear[:, 1] - linear[:, 0]
    got = toxicity.train(texts, labels, weights, epochs=1, rate=rate, seed=seed)
    used = np.flatnonzero(bags.any(axis=0))
    assert np.allclose(got.weights[used], (vectors @ side)[used], rtol=1e-3, atol=1e-5)
    assert np.isclose(got.bias, bias[1] - bias[0], rtol=1e-6)


def test_held_out_accuracy(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    docs, labels = read("documents").select("doc_id", "text"), read("labels")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).join(labels.filter("quality = 1"), "doc_id").filter("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id)
    assert (scored.predicted == scored.toxic).mean() >= 0.95


def test_odd_rows(spark, docs_of):
    docs = docs_of((None, None), (1, ""), (1, ""), (2, "word " * 60000)).selectExpr("*", "1 as score", "2 as __y")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert sorted(str(r.doc_id) for r in scored) == ["1", "1", "2", "None"]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)
    assert all(r.held_out is False for r in scored if r.doc_id is None)
    nothing = toxicity.fit(docs_of(), labels.limit(0))
    assert toxicity.score(docs_of(), nothing).count() == 0
