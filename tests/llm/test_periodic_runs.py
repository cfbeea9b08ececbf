import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from almanac.llm import periodic_runs
from almanac.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def brute_runs(words, least=6, repeats=4):
    """All maximal stretches whose smallest period has at least ``repeats`` repeats, by looking at every period."""
    n, found = len(words), set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - start
            if size >= max(least, repeats * q):
                part = words[start : start + size]
                if not any(all(part[j] == part[j + p] for j in range(size - p)) for p in range(1, q)):
                    found.add((start, size, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def numbers(words):
    return np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else np.empty(0, dtype=np.int64)


@settings(deadline=None, max_examples=300)
@given(
    st.lists(
        st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 40)), min_size=0, max_size=5
    )
)
def test_runs_as_by_brute_force(parts):
    words = [str(w) for period, n in parts for w in (period * n)[:n]]
    assert [tuple(r) for r in periodic_runs.runs_of(numbers(words)).tolist()] == brute_runs(words)


def test_two_runs_that_share_words():
    words = list("abababab" + "babbabbabbab")
    got = [tuple(r) for r in periodic_runs.runs_of(numbers(words)).tolist()]
    assert got == brute_runs(words) and len(got) == 2


def test_other_lengths_and_repeats():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice("ab") for _ in range(40)]
        got = [tuple(r) for r in periodic_runs.runs_of(numbers(words), least=12, repeats=5).tolist()]
        assert got == brute_runs(words, 12, 5)
    with pytest.raises(ValueError, match="four periods"):
        periodic_runs.runs_of(np.zeros(9), repeats=3)


def test_long_text(spark):
    """A long period between other words, and one very long word."""
    rng = random.Random(1)
    period = [str(rng.random()) for _ in range(30_000)]
    words = ["x" * 1_000_000, *[str(rng.random()) for _ in range(500)], *period * 4, period[0], "end"]
    df = spark.createDataFrame([(1, "\n".join(words))], "doc_id long, text string")
    row = periodic_runs.find_runs(df).first()
    assert [tuple(r) for r in row.runs] == [(501, 120_001, 30_000)]
    assert row.collapsed == " ".join(words[: 501 + 30_000] + ["end"])


def test_odd_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (2, " \t\n", 3), (3, "a a a a a a", 4), (3, "a a a a a a", 4), (4, "a\u00a0a a a a a", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Runs int").withColumnRenamed("Runs", "runs")
    got = sorted(periodic_runs.find_runs(df).collect(), key=lambda r: (r.doc_id or 0, r.n_words))
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (None, 0, [], ""),
        (1, 0, [], ""),
        (2, 0, [], ""),
        (3, 6, [(0, 6, 1)], "a"),
        (3, 6, [(0, 6, 1)], "a"),
        (4, 5, [], "a\u00a0a a a a a"),
    ]
    assert periodic_runs.digest(periodic_runs.find_runs(df.limit(0))).count() == 0


def test_longest_run_breaks_ties_by_start(spark):
    text = "a b a b a b a b x c d c d c d c d"
    row = periodic_runs.digest(periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (2, 0, 8, 2, 4000)


def test_query(spark):
    """All documents against brute force, the planted stretches included."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        words = periodic_runs.words_of(text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if n > 4000:  # brute force takes the square of the length; the planted run is looked at below
            continue
        if h % 10 == 0 and n:
            first = h // 10 % n
            period = 1 + (n - first) // (3 + h // 10 % 8)
            words = [words[i] if i < first else words[first + (i - first) % period] for i in range(n)]
            planted += 1
        runs = brute_runs(words)
        row = got[doc_id]
        assert row.n_runs == len(runs)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
        if runs:
            start, size, period = min(runs, key=lambda r: (-r[1], r[0], r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (start, size, period, 1000 * size // period)
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
    assert planted > 10
