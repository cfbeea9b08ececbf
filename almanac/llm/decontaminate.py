"""Benchmark passages in documents, found by greedy string tiling.

Texts become lower-case words, words become 64-bit hashes. Every run of SEED words of a test item is a seed (an item
with fewer words is one seed). Documents and items meet by a join of the seeds with the documents' runs; of these only
such are shuffled as a bitmap of all seeds lets pass, which is of one size however many items there are. A pair that
shares a seed is tiled: again and again the longest run of words that both have, and that no earlier tile touches, is
searched by Karp-Rabin hashes and marked, down to SEED words. An item counts as leaked if its tiles cover enough of
it, in whatever order they stand in the document.

A tile consists of seeds, so a pair is tiled from its shared seeds alone: neither texts nor documents' words are
shuffled. A seed of very many items, such as a prompt that all of them begin with, says little. Where an item could
not be covered by such seeds alone, a pair must share one of its rarer seeds to come into question; the others count
only for pairs that do. Equal texts are one text until the end. Neither side passes the driver.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.common import bound_batches, spare_names, stored, text_of

#: Words of a seed and of the shortest tile; items with fewer words must appear whole.
SEED = 5
#: Covered share of an item's words from which on the document counts as contaminated.
COVERAGE = 0.6
#: A seed that more items have brings pairs into question only for items that it could cover.
FREQUENT_ITEMS = 64
#: Bits of the bitmap of seeds (a power of two).
BITMAP_BITS = 1 << 24
#: Texts found to leak (a digest each) that may be sent to every task; more are joined by a shuffle.
BROADCAST_TEXTS = 200_000

_WORD, _NO_WORD = re.compile(r"\w+"), re.compile(r"\W+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** n, modulo 2**64."""
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, base))))


#: ASCII with a blank for whatever is no part of a word.
_ASCII = bytes(b if b < 128 and _WORD.fullmatch(chr(b)) else 32 for b in range(256))
#: Bytes of a text whose words are hashed at once.
_CHUNK = 1 << 18
_BYTES = np.random.default_rng(7).integers(1, 2**64, 256, dtype=np.uint64)
_UP = _powers(_BASE, _CHUNK)
_DOWN = _powers(np.uint64(pow(int(_BASE), -1, 2**64)), _CHUNK)


def _piece_hashes(raw: np.ndarray) -> np.ndarray:
    """Hashes of the words between blanks: each from prefix sums of its bytes' values times powers."""
    inside = np.concatenate(([False], raw != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    whole = len(raw) <= _CHUNK
    up, down = (_UP, _DOWN) if whole else (_powers(_BASE, len(raw)), _powers(_DOWN[1], len(raw)))  # a word of that length
    sums = np.concatenate(([np.uint64(0)], np.cumsum(_BYTES[raw] * up[: len(raw)])))
    h = (sums[ends] - sums[starts]) * down[starts]
    h = (h ^ (h >> np.uint64(32))) * _BASE
    return (h ^ (h >> np.uint64(32))) >> np.uint64(1)


def word_hashes(text: str) -> np.ndarray:
    """The words of a text as 63-bit numbers, equal for equal words."""
    low = text.lower()
    plain = low.encode().translate(_ASCII) if low.isascii() else _NO_WORD.sub(" ", low).encode("utf-8", "surrogatepass")
    raw = np.frombuffer(plain, np.uint8)
    parts, at = [np.empty(0, np.uint64)], 0
    while at < len(raw):
        end = len(raw)
        if end - at > _CHUNK:
            blanks = np.flatnonzero(raw[at : at + _CHUNK] == 32)
            if len(blanks):
                end = at + int(blanks[-1])
            else:  # a word that is longer than a chunk
                rest = np.flatnonzero(raw[at:] == 32)
                end = at + int(rest[0]) if len(rest) else end
        parts.append(_piece_hashes(raw[at:end]))
        at = end + 1
    return np.concatenate(parts)


def run_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``size`` words, modulo 2**64."""
    h = np.zeros(max(0, len(ids) - size + 1), np.uint64)
    for k in range(size):
        h = h * _BASE + ids[k : k + len(h)].astype(np.uint64) + np.uint64(1)
    return h


def tile(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (position in item, position in text, words) of greedy string tiling. Negative words match nothing."""
    item, text = item.copy(), text.copy()
    tiles = []
    longest = min(len(item), len(text))
    while longest >= least and len(_unmarked(item, least)):
        found = _common_runs(item, text, longest)  # most often a whole item, or nothing that long
        size = longest if found else 0
        low, high = least, longest - 1
        while low <= high and not size == longest:  # a common run of some length contains common runs of all shorter ones
            middle = (low + high) // 2
            common = _common_runs(item, text, middle)
            if common:
                size, found, low = middle, common, middle + 1
            else:
                high = middle - 1
        if not size:
            break
        for p, q in found:
            if item[p : p + size].min() >= 0 and text[q : q + size].min() >= 0:
                tiles.append((p, q, size))
                item[p : p + size] = -1  # marked
                text[q : q + size] = -2
        longest = size
    return tiles


def _common_runs(item: np.ndarray, text: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Positions of equal unmarked runs: the first place in the text for each place in the item, and others once
    that one is taken."""
    places: dict[int, list[int]] = {}
    own = _unmarked(item, size)
    for p, h in zip(own.tolist(), run_hashes(item, size)[own].tolist()):
        places.setdefault(h, []).append(p)
    free = _unmarked(text, size)
    hashes = run_hashes(text, size)[free]
    hit = np.isin(hashes, np.array(list(places), np.uint64)) if places else np.zeros(len(free), bool)
    return [
        (p, q)
        for q, h in zip(free[hit].tolist(), hashes[hit].tolist())
        for p in places[h]
        if np.array_equal(item[p : p + size], text[q : q + size])
    ]


def _unmarked(ids: np.ndarray, size: int) -> np.ndarray:
    """Starts of runs without a marked or unknown word."""
    bad = np.r_[0, np.cumsum(ids < 0)]
    n = len(ids) - size + 1
    return np.flatnonzero(bad[size:] == bad[:n]) if n > 0 else np.empty(0, np.int64)


def seed_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hashes of runs, mixed so that all bits depend on all words and on the size."""
    h = run_hashes(ids, size) + np.uint64(size)
    h = (h ^ (h >> np.uint64(31))) * _BASE
    return h ^ (h >> np.uint64(29))


_HIT = T.StructType([T.StructField("seed", T.LongType()), T.StructField("at", T.IntegerType())])


def _lists(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """(seeds, places) of each row as an array of lists of structs."""
    offsets = np.concatenate(([0], np.cumsum([len(a) for _, a in parts]))).astype(np.int32)
    seeds = np.concatenate([s for s, _ in parts] or [np.empty(0, np.uint64)]).view(np.int64)
    places = np.concatenate([a for _, a in parts] or [np.empty(0, np.int32)]).astype(np.int32)
    entries = pa.StructArray.from_arrays([pa.array(seeds), pa.array(places)], _HIT.names)
    return pa.ListArray.from_arrays(pa.array(offsets), entries)


def item_seeds(items: DataFrame, item_id: str, text: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """The items that have words, numbered, as (item, item_id, words, size), and their seeds as (item, seed, p); stored."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def words(texts: pa.Array) -> pa.Array:
        return pa.array([word_hashes(t).view(np.int64) for t in texts.to_pylist()], pa.list_(pa.int64()))

    @F.arrow_udf(T.ArrayType(_HIT))
    def seeds(rows: pa.Array) -> pa.Array:
        ids = [np.array(r, np.int64).view(np.uint64) for r in rows.to_pylist()]
        found = [seed_hashes(i, min(seed, len(i))) for i in ids]
        return _lists([(f, np.arange(len(f))) for f in found])

    rows = items.select(F.col(item_id).alias("item_id"), words(text_of(text)).alias("words")).filter(F.size("words") > 0)
    numbered = rows.withColumn("item", F.monotonically_increasing_id())
    known = stored(numbered.withColumn("size", F.least(F.size("words"), F.lit(seed))), "items")
    each = known.select("item", "size", F.explode(seeds("words")).alias("hit"))
    return known, stored(each.select("item", "size", F.col("hit.seed").alias("seed"), F.col("hit.at").alias("p")), "seeds")


def seed_bitmap(seeds: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bit for the low digits of every seed; of one size, whatever the number of seeds."""
    bit = F.pmod("seed", F.lit(bits))
    word = F.shiftright(bit, 5).cast("int").alias("word")
    marked = seeds.groupBy(word).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(32)).cast("int"))).alias("marks"))
    out = np.zeros(bits // 32, np.uint32)
    for r in marked.toLocalIterator():  # at most bits / 32 rows
        out[r.word] = r.marks
    return out


def text_hits(texts: DataFrame, sizes: list[int], bitmap: np.ndarray) -> DataFrame:
    """(text_key, seed, q) for the runs of texts (text_key, text) that the bitmap lets pass, once for equal texts."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf(T.ArrayType(_HIT))
    def hits(rows: pa.Array) -> pa.Array:
        marks = shared.value
        mask, parts = np.uint64(32 * len(marks) - 1), []
        for text in rows.to_pylist():
            ids = word_hashes(text)
            found, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for size in sizes:
                h = seed_hashes(ids, size)
                low = h & mask
                at = np.flatnonzero(marks[low >> np.uint64(5)] >> (low & np.uint64(31)).astype(np.uint32) & np.uint32(1))
                found.append(h[at])
                places.append(at)
            parts.append((np.concatenate(found), np.concatenate(places)))
        return _lists(parts)

    each = texts.select("text_key", F.explode(hits("text")).alias("hit"))
    return each.select("text_key", F.col("hit.seed").alias("seed"), F.col("hit.at").alias("q")).distinct()


def generating_seeds(items: DataFrame, seeds: DataFrame, coverage: float, frequent_items: int) -> DataFrame:
    """(seed, item) of the seeds one of which a pair must share to come into question.

    An item's frequent seeds are left out if all of them together cover less of it than ``coverage``: a document that
    covers enough then holds a word outside of them inside a tile, and with it another of the item's seeds.
    """
    shared = seeds.groupBy("seed").agg(F.count_distinct("item").alias("n")).filter(F.col("n") > frequent_items).select("seed")
    frequent = seeds.join(shared, "seed", "left_semi")
    covered = frequent.select("item", F.explode(F.sequence(F.col("p"), F.col("p") + F.col("size") - 1)).alias("word"))
    share = covered.groupBy("item").agg(F.count_distinct("word").alias("covered")).join(items.select("item", F.size("words").alias("n")), "item")
    spared = share.filter(F.col("covered") < F.lit(coverage) * F.col("n")).select("item")
    rare = seeds.join(shared, "seed", "left_anti")
    needed = frequent.join(spared, "item", "left_anti")
    return rare.unionByName(needed).select("seed", "item").distinct()


_TILED = T.StructType([T.StructField(n, T.IntegerType()) for n in ("covered_words", "tiles")])


def tiled(words: np.ndarray, size: int, hits: list[tuple[int, int]], coverage: float) -> tuple[int, int]:
    """(words covered, tiles) of an item's words by a document, given as (place in it, place in the item) of the seeds
    that both have; (0, 0) where they cannot cover enough."""
    own = np.unique(words, return_inverse=True)[1].astype(np.int64)
    starts = np.array(sorted(hits), np.int64).reshape(-1, 2)
    shared = seed_hashes(words.view(np.uint64), size)
    reach = np.zeros(len(own), bool)  # tiles consist of seeds, so this is the most that they can cover
    for p in np.flatnonzero(np.isin(shared, shared[starts[:, 1]])):
        reach[p : p + size] = True
    if reach.sum() < coverage * len(own):
        return 0, 0
    parts, end = [], -1
    for q, p in starts.tolist():  # the document's words are the item's, as far as they are in shared seeds
        if q > end:
            parts.append(np.array([-1]))
            end = q
        parts.append(own[p + end - q : p + size])
        end = q + size
    tiles = tile(own, np.concatenate(parts), size)
    return sum(t[2] for t in tiles), len(tiles)


def leaked_texts(
    texts: DataFrame, items: DataFrame, item_id: str, item_text: str, seed: int, coverage: float,
    frequent_items: int = FREQUENT_ITEMS, bits: int = BITMAP_BITS,
) -> DataFrame:
    """(text_key, item_id, item_words, covered_words, tiles) for the texts that hold an item, stored."""
    bound_batches(texts.sparkSession)
    known, seeds = item_seeds(items, item_id, item_text, seed)
    sizes = sorted(r[0] for r in seeds.select("size").distinct().collect())  # 1 to seed
    hits = stored(text_hits(texts, sizes, seed_bitmap(seeds, bits)), "hits")
    pairs = hits.join(generating_seeds(known, seeds, coverage, frequent_items), "seed").select("text_key", "item").distinct()
    places = seeds.groupBy("item", "seed").agg(F.min("p").alias("p"), F.count("*").cast("int").alias("times"))
    shared = pairs.join(places, "item").join(hits, ["text_key", "seed"])
    gathered = shared.groupBy("text_key", "item").agg(F.collect_list(F.struct("q", "p", "times")).alias("hits"))
    # tiles consist of shared seeds, so those must be enough to cover what is asked for
    distinct = F.array_distinct(F.transform("hits", lambda h: F.struct(h["p"].alias("p"), h["times"].alias("times"))))
    reach = F.col("size") * F.aggregate(distinct, F.lit(0), lambda sum_, h: sum_ + h["times"])
    likely = gathered.join(known, "item").filter(reach >= F.lit(coverage) * F.size("words"))
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    likely = likely.repartition(tasks, "text_key", "item")  # few bytes a pair, but much to do: not for a few tasks

    @F.arrow_udf(_TILED)
    def tiling(words: pa.Array, sizes: pa.Array, hits: pa.Array) -> pa.Array:
        rows = zip(words.to_pylist(), sizes.to_pylist(), hits.to_pylist(), strict=True)
        done = [tiled(np.array(w, np.int64), n, [(h["q"], h["p"]) for h in found], coverage) for w, n, found in rows]
        return pa.StructArray.from_arrays([pa.array([d[i] for d in done], pa.int32()) for i in (0, 1)], _TILED.names)

    compared = likely.withColumn("found", tiling("words", "size", "hits"))
    counted = compared.select("text_key", "item_id", F.size("words").alias("item_words"), "found.*")
    return stored(counted.filter(F.col("covered_words") >= F.lit(coverage) * F.col("item_words")), "leaks")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    seed: int = SEED,
    coverage: float = COVERAGE,
    **options,
) -> DataFrame:
    """Per contaminated document row and leaked item row: doc_id, item_id, item_words, covered_words, tiles.

    Null texts are empty; an empty item leaks nowhere; null and repeated ids are reported as they are, a row each.
    Other columns of either table are not read, and either may be empty.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text")).withColumn("text_key", F.sha2("text", 256))
    found = leaked_texts(slim.select("text_key", "text"), items, item_id, item_text, seed, coverage, **options)
    rows = slim.select("doc_id", "text_key")
    return rows.join(found, "text_key").select("doc_id", "item_id", "item_words", "covered_words", "tiles")


def drop_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    seed: int = SEED,
    coverage: float = COVERAGE,
    **options,
) -> DataFrame:
    """The rows without any leaked item, with their columns as they came, whatever their names.

    Rows with a null or empty text stay, as do all rows if there are no items with words; repeated rows stay or go
    together, and an empty table gives an empty one.
    """
    (key,) = spare_names(docs.columns, "text_key")
    slim = docs.select(text_of(text).alias("text")).withColumn("text_key", F.sha2("text", 256)).select("text_key", "text")
    found = leaked_texts(slim, items, item_id, item_text, seed, coverage, **options)
    leaking = stored(found.select(F.col("text_key").alias(key)).distinct(), "leaking")
    if leaking.count() <= BROADCAST_TEXTS:
        leaking = F.broadcast(leaking)
    return docs.withColumn(key, F.sha2(text_of(text), 256)).join(leaking, key, "left_anti").select(docs.columns)
