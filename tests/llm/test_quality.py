import random
import re

import pytest

from almanac.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
    )


def test_counts():
    rng = random.Random(5)
    texts = ["", "a", "a b c a b c", "x\n\n x\nx\nx", "é ü \x1c ß", "a a a a"]
    texts += ["".join(rng.choice("ab #|\n\t\x0cé\r") for _ in range(rng.randrange(80))) for _ in range(300)]
    for t in texts:
        assert quality.text_counts(t) == brute(t), repr(t)


def clean(rng, n=120):
    return " ".join(f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(n)) + ".\nend"


def corpus(spark, rows=400):
    rng = random.Random(6)
    data = []
    for i in range(rows):
        text, lang, source = clean(rng), rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None])
        if i % 4 == 1:
            text = text.replace(" ", "*** ")
        if i % 40 == 2:
            text = "THE!! " * 10 + text.upper().replace(" ", "!! ")
        data.append((i, text, lang, source, len(text)))
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")


def test_verdicts(spark):
    docs = corpus(spark)
    got = {r.doc_id: r.kept for r in quality.assess(docs).collect()}
    assert got == {i: i % 4 != 1 and i % 40 != 2 for i in range(400)}
    kept = quality.keep_good(docs.selectExpr("*", "1 as counts", "2 as kept", "3 as total"))
    assert kept.columns == [*docs.columns, "counts", "kept", "total"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k in got.items() if k)


def test_sketch_merges_and_bounds_the_error(spark):
    rng = random.Random(7)
    values = sorted(int(rng.lognormvariate(6, 2)) for _ in range(4000))
    rows = spark.createDataFrame([("l", f"s{i % 7}", v) for i, v in enumerate(values)], "lang string, source string, v long")

    def bounds(df):
        parts = quality.sketch(df, "lang", "source", {"r": df.v}).groupBy("lang", "bucket").agg({"n": "sum"})
        return quality.quantile_bounds(parts.withColumnRenamed("sum(n)", "weight"), ["lang"]).first()

    whole = bounds(rows)
    for got, q in ((whole.mid, 0.5), (whole.low, quality.LOWER)):
        exact = values[int(q * len(values))]
        assert abs(got - exact) <= max(1, exact / 32)
    assert bounds(rows.repartition(9)) == whole


def test_odd_rows(spark, docs_of):
    docs = docs_of((None, None), (1, ""), (1, ""), (2, "word " * 100000))
    got = sorted((str(r.doc_id), r.n_words, r.base_failed, r.kept) for r in quality.assess(docs).collect())
    assert got == [("1", 0, True, False)] * 2 + [("2", 100000, True, False), ("None", 0, True, False)]
    assert quality.assess(docs_of()).count() == 0 and quality.keep_good(docs_of()).count() == 0


def test_sketches_decide(spark):
    """Texts of one shape pass in one source and fail in another; no fixed number separates them."""
    rng = random.Random(9)
    made = lambda low, high, comma: " ".join(
        "x" * rng.randint(low, high) + ("," if rng.random() < comma else "") for _ in range(rng.randint(80, 300))
    )
    shapes = {"short": (2, 6, 0.15), "long": (9, 15, 0.15), "terse": (2, 6, 0.6)}
    rows = []
    for source in shapes:
        for _ in range(6 * quality.PRIOR_ROWS):
            rows.append((len(rows), made(*shapes[source]).replace("xxxx", f"x{rng.randrange(90):02}x"), "en", source, 1))
    own = len(rows)
    for source in shapes:
        for shape in shapes.values():
            rows.append((len(rows), made(*shape).replace("xxxx", f"x{rng.randrange(90):02}x"), "en", source, 1))
    # all windows differ, so that only the shape of the words decides
    rows = [(i, " ".join(_named(w, k) for k, w in enumerate(t.split())), *rest) for i, t, *rest in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality.assess(docs).collect()}
    assert all(not r.base_failed for r in got.values())
    assert all(got[i].kept for i in range(own))
    mixed = {(s, t): got[own + 3 * a + b].kept for a, s in enumerate(shapes) for b, t in enumerate(shapes)}
    assert mixed == {(s, t): s == t or (s, t) == ("terse", "short") for s in shapes for t in shapes}


def _named(word, k):
    """The word with its length and marks, spelt by its place."""
    body = word.rstrip(",")
    return f"{k:x}".rjust(len(body), "q")[-len(body) :].translate(str.maketrans("0123456789", "ghijklmnop")) + word[len(body) :]


def test_short_texts_have_room(spark):
    rng = random.Random(10)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    text = lambda n: " ".join(word(rng.randint(1, 9)) + rng.choice(["", "", "", ",", "."]) for _ in range(n))
    rows = [(i, text(1000), "en", "a", 1) for i in range(250)] + [(1000 + i, text(50), "en", "a", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert all(r.kept for r in quality.assess(docs).collect())


def test_weights_of_the_mixture(spark):
    """A source's own sketch weighs n / (n + prior), its language's the same share of the rest."""
    for n in (1, 10, 100, 199, 200, 201, 5000):
        parts = [("en", "big", "r", 5000, 900), ("en", "own", "r", 9000, n), (None, "x", "r", 7000, 50)]
        sketches = spark.createDataFrame(parts, "lang string, source string, rate string, bucket long, n long")
        got = {r.bucket: r.weight for r in quality.mixed_sketches(sketches, 100).filter("source = 'own'").collect()}
        own, wide = n / (n + 100), (900 + n) / (1000 + n)
        whole = 950 + n
        want = {
            5000: (1 - own) * (wide * 900 / (900 + n) + (1 - wide) * 900 / whole),
            9000: own + (1 - own) * (wide * n / (900 + n) + (1 - wide) * n / whole),
            7000: (1 - own) * (1 - wide) * 50 / whole,
        }
        assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(1)
        other = quality.mixed_sketches(sketches, 100).filter("lang is null").collect()
        assert {r.bucket for r in other} == {5000, 7000, 9000}


def test_helper_names_as_columns(spark):
    docs = corpus(spark, 60).selectExpr("*", "1 as __counts", "2 as counts", "3 as counts_", "4 as __lang", "5 as mid_n_words", "6 as Kept")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(60) if i % 4 != 1 and i % 40 != 2]
    assert {tuple(r)[5:] for r in kept.collect()} == {(1, 2, 3, 4, 5, 6)}
