import random

import numpy as np
import pytest

from almanac.llm import decontaminate


def brute_tiles(item, text, least):
    """Greedy string tiling by comparing all positions."""
    item, text, covered = list(item), list(text), []
    while True:
        best, size = [], least - 1
        for p in range(len(item)):
            for q in range(len(text)):
                n = 0
                while p + n < len(item) and q + n < len(text) and item[p + n] == text[q + n] and item[p + n] >= 0:
                    n += 1
                if n > size:
                    best, size = [(p, q)], n
                elif n == size and n >= least:
                    best.append((p, q))
        if not best:
            return covered
        for p, q in sorted(best, key=lambda x: (x[1], x[0])):
            if min(item[p : p + size]) >= 0 and min(text[q : q + size]) >= 0:
                covered.append((p, q, size))
                item[p : p + size] = [-1] * size
                text[q : q + size] = [-2] * size


def test_tiles_against_brute():
    rng = random.Random(8)
    for _ in range(150):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 25))]
        text = [rng.randrange(-1, 4) for _ in range(rng.randrange(1, 40))]
        got = decontaminate.tile(np.array(item), np.array(text), 3)
        assert got == brute_tiles(item, text, 3)


def test_word_hashes(monkeypatch):
    """As many as words, equal for equal words and no others, whatever the chunks; a word may exceed a chunk."""
    rng = random.Random(12)
    texts = ["", " .!", "İstanbul ΣΑΣ straße", "a b a", "\ud800 x", "x_1 x-1"]
    texts += ["".join(rng.choice("aAbé_1 .\n日") for _ in range(rng.randrange(60))) for _ in range(500)]
    texts += ["q" * 3000 + " ab " + "z" * 2000 + " q", " ".join(f"w{i % 70}" for i in range(3000))]
    seen = {}
    for chunk in (decontaminate._CHUNK, 64):
        monkeypatch.setattr(decontaminate, "_CHUNK", chunk)
        for text in texts:
            words, hashes = decontaminate.words_of(text), decontaminate.word_hashes(text).tolist()
            assert len(words) == len(hashes), text
            for w, h in zip(words, hashes, strict=True):
                assert seen.setdefault(w, h) == h < 2**63
    assert len(set(seen.values())) == len(seen) > 500
    many = [f"{a}{b}" for a in range(400) for b in ("x", "yy", "zzz")]
    assert len(set(decontaminate.word_hashes(" ".join(many)).tolist())) == len(set(many))


ITEM = [f"word{i}" for i in range(40)]


@pytest.fixture(scope="module")
def leaks(spark, docs_of):
    """(item, its words, words covered, tiles) per text, all texts at once."""

    def found(texts, **options):
        items = spark.createDataFrame([(5, " ".join(ITEM)), (6, "tiny item"), (7, ""), (8, None)], "item_id long, text string")
        out = {i: [] for i in range(len(texts))}
        for r in decontaminate.find_leaks(docs_of(*texts), items, **options).collect():
            out[r.doc_id].append(tuple(r)[1:])
        return [sorted(v) for v in out.values()]

    return found


def test_leaks(leaks):
    noise = [f"noise{i}" for i in range(500)]
    whole = " ".join(ITEM)
    moved = ITEM[20:] + noise[:7] + ITEM[10:20] + noise[7:9] + ITEM[:10]
    cases = {
        whole: [(5, 40, 40, 1)],
        " ".join(noise + moved + noise): [(5, 40, 40, 3)],
        " ".join(noise).upper() + "! " + whole.upper().replace(" ", ", "): [(5, 40, 40, 1)],
        " ".join(ITEM[:23]): [],
        " ".join(noise): [],
        "": [],
        " ".join(ITEM[i] for i in range(0, 40, 2)): [],
        "a tiny, item b": [(6, 2, 2, 1)],
        "item tiny": [],
        whole + " tiny item " + whole: [(5, 40, 40, 1), (6, 2, 2, 1)],
    }
    assert leaks(list(cases)) == list(cases.values())
    assert leaks([" ".join(ITEM[:23])], coverage=0.5) == [[(5, 40, 23, 1)]]


def brute_leaks(docs, items, seed, coverage):
    out = []
    for item_id, item in items:
        own = decontaminate.words_of(item or "")
        for doc_id, text in docs:
            words = decontaminate.words_of(text or "")
            number = {w: n for n, w in enumerate(dict.fromkeys(own))}
            tiles = brute_tiles([number[w] for w in own], [number.get(w, -1) for w in words], min(seed, len(own))) if own else []
            covered = sum(t[2] for t in tiles)
            if own and covered >= coverage * len(own):
                out.append((doc_id, item_id, len(own), covered, len(tiles)))
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"frequent_items": 1}, {"frequent_items": 3, "bits": 64}])
def test_against_brute_force(spark, docs_of, options):
    """Few words, so that items share seeds, repeat words and begin alike; with frequent seeds left out and not, and
    with a bitmap so small that nearly all runs pass."""
    rng = random.Random(11)
    words = lambda n, k: [f"w{rng.randrange(k)}" for _ in range(n)]
    prompt = words(9, 30)
    items = [(i, " ".join(prompt[: rng.choice([0, 6, 9])] + words(rng.randrange(1, 16), rng.choice([2, 6, 30])))) for i in range(24)]
    docs = []
    for i in range(60):
        parts = words(rng.randrange(12), 30)
        for _ in range(rng.randrange(1, 4)):
            item = rng.choice(items)[1].split()
            cut = rng.randrange(len(item))
            parts += rng.choice([item, item[cut:] + words(1, 30) + item[:cut], item[cut:], prompt]) + words(rng.randrange(3), 30)
        docs.append((i, " ".join(parts)))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(docs_of(*docs), table, seed=3, coverage=0.6, **options)
    want = brute_leaks(docs, items, 3, 0.6)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_a_prompt_that_all_items_begin_with(spark):
    """Its seeds bring no pairs into question, as they cannot cover any of the items."""
    prompt = " ".join(f"please{i}" for i in range(12))
    items = spark.range(3000).selectExpr("id AS item_id", f"concat('{prompt} ', array_join(transform(sequence(1, 20), i -> concat('q', id, 'x', i)), ' ')) AS text")
    known, seeds = decontaminate.item_seeds(items, "item_id", "text", 5)
    generating = decontaminate.generating_seeds(known, seeds, 0.6, 64)
    assert seeds.count() == 3000 * 28 and generating.count() == 3000 * 20
    texts = spark.createDataFrame([("a", prompt), ("b", items.filter("item_id = 7").first().text)], "text_key string, text string")
    hits = decontaminate.text_hits(texts, [5], decontaminate.seed_bitmap(seeds))
    assert sorted(map(tuple, hits.join(generating, "seed").select("text_key").distinct().collect())) == [("b",)]
    found = decontaminate.leaked_texts(texts, items, "item_id", "text", 5, 0.6).collect()
    assert [tuple(r) for r in found] == [("b", 7, 32, 32, 1)]


def test_spark(spark, docs_of, monkeypatch):
    whole = " ".join(ITEM)
    docs = docs_of((1, whole), (1, whole), (2, None), (None, "x " + whole), (4, "clean " * 30000), (5, ""))
    docs = docs.selectExpr("*", "1 as item_id", "2 as tiles", "'x' as item")
    items = spark.createDataFrame([(9, whole), (None, "clean clean"), (3, None), (9, whole)], "item_id long, text string")
    want = sorted([("1", "9")] * 4 + [("None", "9")] * 2 + [("4", "None")])
    found = decontaminate.find_leaks(docs, items)
    assert sorted((str(r.doc_id), str(r.item_id)) for r in found.collect()) == want
    named = docs.selectExpr("*", "1 as text_key", "2 as seed")
    for broadcast in (10**6, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_TEXTS", broadcast)
        kept = decontaminate.drop_leaks(named, items)
        assert kept.schema == named.schema and sorted(r.doc_id for r in kept.collect()) == [2, 5]
    assert decontaminate.find_leaks(docs_of(), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs, items.limit(0)).count() == docs.count()
