import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from almanac.llm import lexical_search


def terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"(?:[0-9a-zA-Z]|[^\x00-\x7f])+", lowered)


def brute(docs, queries, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    total = sum(sum(c.values()) for _, c in counted)
    n_docs = sum(1 for _, c in counted if c)
    df = Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for row, (doc_id, c) in enumerate(counted):
            n = sum(c.values())
            m = 50 + (50 * n * n_docs) // max(total, 1)
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, row))
        for rank, (score, null, doc_id, _) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if null else doc_id, -score))
    return sorted(out, key=str)


def searched(spark, docs, queries, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(queries, "item_id long, text string")
    return sorted(map(tuple, lexical_search.search(d, q, **how).collect()), key=str)


def random_texts(rng, n, words, low, high):
    common = [f"w{i}" for i in range(words)]
    return [" ".join(common[min(int(rng.expovariate(6 / words)), words - 1)] for _ in range(rng.randint(low, high))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(400))
def test_bounds_resolve_what_brute_force_finds(seed):
    """Membership, order and scores, with many ties, from any size of first read."""
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(1, 60)), int(rng.integers(1, 12))
    lists = []
    for _ in range(int(rng.integers(0, 7))):
        docs = rng.permutation(n)[: int(rng.integers(1, n + 1))]
        impacts = rng.integers(1, int(rng.choice([2, 4, 100])) + 1, len(docs))
        order = np.lexsort((docs, -impacts))
        lists.append((docs[order], impacts[order]))
    total = np.zeros(n, dtype=np.int64)
    for d, s in lists:
        total[d] += s
    want = sorted((-s, i) for i, s in enumerate(total.tolist()) if s > 0)[:k]
    got = lexical_search.top_by_bounds(lists, n, k, first_read=int(rng.integers(1, 9)))
    assert [(-s, i) for i, s in zip(*map(np.ndarray.tolist, got), strict=True)] == want


def test_reading_stops_early():
    """A clear winner in short lists: the long tail of a list with small impacts is not needed."""

    class Watched(np.ndarray):
        read = 0

        def __getitem__(self, at):
            if isinstance(at, slice) and at.stop is not None:
                Watched.read = max(Watched.read, at.stop)
            return super().__getitem__(at)

    n = 100_000
    long = (np.arange(n).view(Watched), np.full(n, 1))
    best, score = lexical_search.top_by_bounds([long, (np.array([7]), np.array([50]))], n, 1, first_read=16)
    assert (best.tolist(), score.tolist()) == ([7], [51]) and Watched.read < 1000


@pytest.mark.parametrize("how", [{}, {"shard_docs": 7, "block_terms": 40}, {"broadcast_terms": 0, "k": 5}])
def test_search_as_by_brute_force(spark, how):
    rng = random.Random(5)
    docs = list(enumerate(random_texts(rng, 150, 80, 0, 60)))
    docs += [(200 + i, docs[i % 5][1]) for i in range(60)]  # equal scores
    queries = list(enumerate(random_texts(rng, 25, 90, 1, 12)))
    how = {"k": 20} | how
    assert searched(spark, docs, queries, **how) == brute(docs, queries, how["k"])


def test_odd_rows(spark):
    long = "lang " * 200_000 + "needle"
    docs = [(1, None), (2, ""), (3, "...!"), (None, "Tea-time ÄÖ"), (4, "tea"), (4, "tea"), (None, "tea"), (5, long), (6, "ÄÖ äö\u2003x")]
    queries = [(1, "TEA"), (1, "time"), (2, None), (3, "!"), (None, "needle"), (7, "äö"), (8, "ÄÖ"), (9, "absent"), (10, "tea Tea TEA")]
    assert searched(spark, docs, queries, k=50) == brute(docs, queries, 50)


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "tea", 3, "x")], "doc_id long, text string, row int, score string")
    queries = spark.createDataFrame([(1, "tea", "y", 3)], "item_id long, text string, doc_id string, rank int")
    assert lexical_search.search(docs.limit(0), queries).collect() == []
    assert lexical_search.search(docs, queries.limit(0)).collect() == []
    assert [r.doc_id for r in lexical_search.search(docs, queries).collect()] == [1]
    assert lexical_search.search(docs, queries).columns == ["item_id", "rank", "doc_id", "score"]


def test_a_term_of_all_documents_weighs_little_but_counts(spark):
    docs = [(i, "tea milk" if i % 2 else "tea") for i in range(40)]
    assert searched(spark, docs, [(1, "tea")], k=3) == brute(docs, [(1, "tea")], 3)
