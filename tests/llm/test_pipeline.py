"""The pipeline against a plain version of each stage, and the queries without SQL against brute force."""

import collections
import functools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import brute_tiles
from test_packing import check as check_packing
from test_quality import brute as brute_counts
from test_secrets import masked
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from almanac.llm import decontaminate, packing, quality, queries, toxicity

SF_DIR = "/root/testdata/sf0.001"


def bucketed(v):
    shift = max(0, len(f"{v:b}") - (quality.PRECISION + 1))
    return v >> shift << shift


def rates_of(text):
    n, chars, *_ = quality.text_counts(text)
    return {"word_length": 1000 * chars // max(n, 1), "mark_rate": 100000 * len(re.findall(r"[^\w\s]", text)) // max(chars, 1), "n_words": n}


def brute_quality(rows):
    """rows: (doc_id, text, lang, source); the ids that stay."""
    found = [(i, lang, source, rates_of(t or ""), brute_counts(t)) for i, t, lang, source in rows]
    passes = lambda c: c[0] >= quality.MIN_WORDS and 100 * c[4] <= quality.MAX_REPEAT_PERCENT * c[0]
    sound = [f for f in found if passes(f[4])]

    @functools.cache
    def mixture(rate, lang, source):
        """Median and lower quantile of the source's, its language's and all values, weighed."""
        groups = [
            [bucketed(r[rate]) for _, a, b, r, _ in sound if (a, b) == (lang, source)],
            [bucketed(r[rate]) for _, a, _, r, _ in sound if a == lang],
            [bucketed(r[rate]) for _, _, _, r, _ in sound],
        ]
        sizes = [float(len(g)) for g in groups]
        w, v = (n / (n + float(quality.PRIOR_ROWS)) for n in sizes[:2])
        counts = [collections.Counter(g) for g in groups]
        upto, ranked = 0.0, []
        for bucket in sorted(counts[2]):
            own, wide, every = (c[bucket] / n for c, n in zip(counts, sizes, strict=True))
            upto += w * own + (1.0 - w) * (v * wide + (1.0 - v) * every)
            ranked.append((bucket, upto))
        return tuple(next(x for x, u in ranked if u >= q * upto) for q in (0.5, quality.LOWER))

    def stays(lang, source, rate, counts):
        typical = mixture("n_words", lang, source)[0]
        for name, both in quality.TAILS.items():
            mid, low = mixture(name, lang, source)
            away = abs(rate[name] - mid) if both else max(rate[name] - mid, 0.0)
            room = quality.SPREAD * (mid - low)
            if mid - low > 0 and away * away * min(counts[0], typical) > room * room * typical:
                return False
        return True

    return [i for i, lang, source, rate, counts in sound if stays(lang, source, rate, counts)]


def brute_pipeline(rows, items, tokenizer):
    """rows: (doc_id, text, lang, source), unique ids. Token ids of each document that is left."""
    texts = {i: t or "" for i, t, _, _ in rows}
    kept = brute_quality(rows)
    prints = {i: brute_fingerprint(texts[i]) for i in kept}
    roots = brute_components(sorted(kept), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    kept = [i for i in kept if roots[i] == i]

    def leaked(text):
        words = decontaminate.words_of(text)
        for item in items:
            own = decontaminate.words_of(item)
            least = min(decontaminate.SEED, len(own))
            if own and sum(t[2] for t in brute_word_tiles(own, words, least)) >= decontaminate.COVERAGE * len(own):
                return True
        return False

    kept = [i for i in kept if not leaked(texts[i])]
    return {i: tokenizer.encode(masked(texts[i]), add_special_tokens=False).ids + [0] for i in kept}


def brute_word_tiles(item, words, least):
    number = {w: n for n, w in enumerate(dict.fromkeys(item))}
    coded = [number.get(w, -1) for w in words]
    if not any(c >= 0 for c in coded):
        return []
    near = [i for i in range(len(coded)) if any(c >= 0 for c in coded[max(0, i - least) : i + least])]
    return brute_tiles([number[w] for w in item], [coded[i] for i in near], least)


def pipeline_rows():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgilmnorstu") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    item = prose(30)
    base = prose(300)
    rows = [(i, prose(rng.randrange(60, 200)), "en", f"s{i % 2}") for i in range(60)]
    rows += [(100 + i, base, "en", "s0") for i in range(5)] + [(110, base + " end", "en", "s1")]
    rows += [(120, prose(60) + " " + item + " " + prose(60), "de", "s0")]
    swapped = " ".join(item.split()[15:] + prose(3).split() + item.split()[:15])
    rows += [(121, prose(60) + " " + swapped.upper(), "de", "s0")]
    rows += [(122, prose(60) + " " + " ".join(item.split()[:9]) + " " + prose(60), "de", "s0")]
    rows += [(130, prose(80) + " password = hunter2222 " + "deadbeef" * 4, "en", "s0")]
    rows += [(140, prose(80).replace(" ", "*** "), "en", "s0"), (141, "word " * 90, "en", "s0"), (142, "few words", "en", "s0")]
    rows += [(150, None, None, None), (151, "", "en", "s0"), (152, prose(3000), None, "s1")]
    rng.shuffle(rows)
    return rows, [item, "", prose(12)]


def run_stages(spark, docs, folder):
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    return docs


def test_pipeline_against_brute_force(spark, tmp_path):
    rows, items = pipeline_rows()
    docs = spark.createDataFrame(
        [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = brute_pipeline(rows, items, Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)))
    assert {100, 122, 130, 152} <= set(want) and not {101, 110, 120, 121, 140, 141, 142, 150, 151} & set(want)
    check_packing(corpus_pipeline.run(spark, str(tmp_path)).collect(), want, packing.CAPACITY)


def test_stages_keep_columns_and_odd_rows(spark, tmp_path, docs_of):
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    text = " ".join(f"w{i}" for i in range(80))
    docs = docs_of((1, text), (1, text), (None, text + " more"), (2, None), (3, ""))
    extra = "kept fp spans blob new keeper least row counts __counts __lang __blob __spans __new __keeper".split()
    docs = docs.selectExpr("*", *[f"{i} as {name}" for i, name in enumerate(extra)], "map('a', 1) as length")
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
    assert [r.doc_id for r in now.collect()] == [1]
    assert [now.first()[name] for name in extra] == list(range(len(extra)))
    assert run_stages(spark, docs.limit(0), str(tmp_path)).count() == 0


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def rows_of(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).collect()


def test_op2(spark, documents):
    rows = rows_of(spark, "op2_toxicity")
    assert {r.doc_id for r in rows} == set(documents) and len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.Scorer(toxicity.Model(np.zeros(toxicity.BUCKETS), 0.0)).scores([""]) == [0.5]


def test_op5(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = {i: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0] for i, r in documents.items()}
    check_packing(rows_of(spark, "op5_packing"), want, packing.CAPACITY)


def test_op6(spark, documents):
    prints = {i: brute_fingerprint(r.text) for i, r in documents.items()}
    roots = brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(spark, "op6_simhash")}
    assert got == {i: (f"{p:016x}", roots[i]) for i, p in prints.items()}


def test_op7(spark, documents):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    plain = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    whole = {(d, i) for d, r in documents.items() for i, t in items.items() if plain(t) in plain(r.text)}
    assert {(r.doc_id, r.item_id) for r in rows_of(spark, "op7_decontaminate")} == whole


def test_op8(spark, documents):
    rows = rows_of(spark, "op8_quality")
    kept = set(brute_quality([(r.doc_id, r.text, r.lang, r.source) for r in documents.values()]))
    for r in rows:
        counts = brute_counts(documents[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert r.kept == (r.doc_id in kept)
    assert len(rows) == len(documents)


def test_op10(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows_of(spark, "op10_token_counts"):
        text = documents[r.doc_id].text or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024)
