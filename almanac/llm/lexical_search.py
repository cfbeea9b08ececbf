"""Ranked lexical search by lists of impacts, read in order with no random access (NRA; Fagin, Lotem and Naor, 2003).

A term's impact on a document does not depend on the query, so every term has one list of documents by falling
impact, and a score is the sum of a document's entries in the lists of the query's terms. The lists are read from the
front, block by block. A document's score lies between the sum of its entries met so far and that sum plus, for every
list it has not been met in, the last impact read there. A document whose upper bound falls below the least of the k
best lower bounds is out, and reads pass over it from then on. Reading goes on until the k best are certain, in this
order, and their bounds have met, so that scores are exact and ties are settled by document.

Spark deals the documents to shards of a bounded number, each with its own lists, and gives every shard the queries in
blocks of a bounded number of terms. A shard resolves its own k best; the k best of all come from those. Neither the
documents nor the queries pass the driver, and what a task holds does not grow with either.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.common import bound_batches, stored, text_of

#: How many documents, on average, a shard holds.
SHARD_DOCS = 8192
#: How many terms, on average, the queries have together that a task reads lists for at a time.
BLOCK_TERMS = 50_000
#: Terms that may be sent to every task (about 60 bytes each).
BROADCAST_TERMS = 200_000
#: Entries of a list that the first read takes; every read takes twice as many as the one before.
FIRST_READ = 256

# What ends a term, and the constants of the score.
SEPARATORS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UNIT, SATURATION, LENGTH_SHARE = 1_000_000_000, 20, 50

_TERM = re.compile(SEPARATORS)
_LOWER = {u: u + 32 for u in range(ord("A"), ord("Z") + 1)}
_ENTRY = T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
_COUNTED = T.StructType([T.StructField("n_terms", T.LongType()), T.StructField("entries", T.ArrayType(_ENTRY))])


def terms_of(text: str) -> list[str]:
    return _TERM.findall(text.lower() if text.isascii() else text.translate(_LOWER))


@F.arrow_udf(_COUNTED)
def _counted(texts: pa.Array) -> pa.Array:
    """How many terms each text has, and its distinct terms with their counts."""
    terms: list[str] = []
    counts: list[int] = []
    offsets, sizes = [0], []
    for text in texts.to_pylist():
        all_terms = terms_of(text)
        found = Counter(all_terms)
        terms += found.keys()
        counts += found.values()
        offsets.append(len(terms))
        sizes.append(len(all_terms))
    entries = pa.StructArray.from_arrays([pa.array(terms, pa.string()), pa.array(counts, pa.int64())], _ENTRY.names)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)
    return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), lists], _COUNTED.names)


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, term): the distinct terms of each query; rows with one key are one query. Stored."""
    entries = queries.select(F.col(key).alias("item_id"), F.explode(_counted(text_of(text))["entries"]).alias("entry"))
    return stored(entries.select("item_id", "entry.term").distinct(), "query-terms")


def numbered_terms(terms: DataFrame) -> DataFrame:
    """(term, term_id), stored, so that the numbers stay."""
    return stored(terms.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "terms")


def _sized(df: DataFrame, rows: int, most: int) -> DataFrame:
    return F.broadcast(df) if rows <= most else df


def postings(docs: DataFrame, terms: DataFrame, key: str, text: str) -> DataFrame:
    """(row, doc_id, n_terms, term_id, tf) for the numbered terms in each document, stored: rows get their numbers here."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"), _counted(text_of(text)).alias("counted")
    )
    entries = rows.select("row", "doc_id", F.col("counted.n_terms"), F.inline("counted.entries"))
    return stored(entries.join(terms, "term").select("row", "doc_id", "n_terms", "term_id", "tf"), "postings")


def collection_size(docs: DataFrame, text: str = "text"):
    """How many documents have a term, and how many terms they have together."""
    n = docs.select(F.regexp_count(text_of(text), F.lit(SEPARATORS)).cast("long").alias("n"))
    return n.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()


def term_weights(index: DataFrame, documents: int) -> DataFrame:
    """(term_id, weight) from the number of documents that hold the term."""
    found = index.groupBy("term_id").agg(F.count("*").alias("df"))
    share = F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")
    return found.select("term_id", F.floor(F.lit(1000.0) * F.log(share)).cast("long").alias("weight"))


def _saturated(documents: int, terms: int) -> Column:
    """What a term's count adds to a document's score, per weight."""
    m = f"{100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n_terms * {documents}L) div {max(terms, 1)}L"
    return F.expr(f"({UNIT}L * tf) div (1000 * tf + {SATURATION} * ({m}))")


class _Lists:
    """The lists of a shard: per term, documents by falling impact."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        terms, first = np.unique(term[order], return_index=True)
        self.spans = dict(zip(terms.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(term)], strict=True), strict=True))

    def of(self, terms, weights) -> list[tuple[np.ndarray, np.ndarray]]:
        spans = [(*self.spans[t], w) for t, w in zip(terms, weights, strict=True) if t in self.spans]
        return [(self.doc[a:b], self.impact[a:b] * w) for a, b, w in spans]


def top_by_bounds(lists: list, n_docs: int, k: int, first_read: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents with their scores, best first, ties by smaller number, from lists of (documents, impacts).

    Documents are numbers below ``n_docs``, impacts are above 0 and fall along a list. What is still unread of a list
    is at most the impact read last, or 0 at its end, so bounds meet at the latest when all lists have ended.
    """
    lists = list(lists)
    lower = np.zeros(n_docs, dtype=np.int64)
    unmet = np.ones((len(lists), n_docs), dtype=bool)
    bound = np.array([s[0] for _, s in lists], dtype=np.int64)
    alive = np.arange(n_docs)
    size = first_read
    while True:
        for i, (d, s) in enumerate(lists):
            read, got = d[:size], s[:size]
            if len(read):
                lower[read] += got
                unmet[i, read] = False
                bound[i] = got[-1] if len(d) > size else 0
                lists[i] = (d[size:], s[size:])
        low = lower[alive]
        least = np.partition(low, len(low) - k)[len(low) - k] if len(low) >= k else 0
        high = low + bound @ unmet[:, alive]
        ahead = low >= max(least, 1)
        if _settled(low, high, ahead, least, k):
            best = np.flatnonzero(ahead)
            best = best[np.lexsort((best, -low[best]))][:k]
            return alive[best], low[best]
        stays = high >= max(least, 1)
        if stays.sum() * 2 <= len(alive):
            alive = alive[stays]
            in_play = np.zeros(n_docs, dtype=bool)
            in_play[alive] = True
            for i, (d, s) in enumerate(lists):
                keep = in_play[d]
                lists[i] = (d[keep], s[keep])
                bound[i] = min(bound[i], lists[i][1][0]) if keep.any() else 0
        size *= 2


def _settled(low: np.ndarray, high: np.ndarray, ahead: np.ndarray, least: int, k: int) -> bool:
    """Whether the k best, their order and their scores can no longer change."""
    is_open = high > low
    if not is_open.any():
        return True
    if least == 0 or is_open[ahead].any():
        return False
    others = high[~ahead]  # their scores may still grow; one that can reach the least score could win a tie
    return not (others >= least).any()


def _resolve(index: pa.Table, wanted: pa.Table, k: int) -> pa.Table:
    """The k best documents of a shard for each query of a block."""
    names = ["item_id", "row", "doc_id", "score"]
    types = [wanted.schema.field("item_id").type, pa.int64(), index.schema.field("doc_id").type, pa.int64()]
    schema = pa.schema(zip(names, types, strict=True))
    if not index.num_rows or not wanted.num_rows:
        return schema.empty_table()
    rows, first, at = np.unique(index["row"].to_numpy(), return_index=True, return_inverse=True)
    docs = pa.table({"doc_id": index["doc_id"].take(first), "row": rows})
    order = pc.sort_indices(docs, [("doc_id", "ascending"), ("row", "ascending")]).to_numpy()  # nulls last
    place = np.empty(len(rows), dtype=np.int64)
    place[order] = np.arange(len(rows))
    lists = _Lists(index["term_id"].to_numpy(), place[at], index["impact"].to_numpy())
    found, scores, items = [], [], []
    for i, (terms, weights) in enumerate(zip(wanted["terms"].to_pylist(), wanted["weights"].to_pylist(), strict=True)):
        best, score = top_by_bounds(lists.of(terms, weights), len(rows), k)
        found.append(order[best])
        scores.append(score)
        items.append(np.full(len(best), i))
    chosen = docs.take(np.concatenate(found))
    columns = [wanted["item_id"].take(np.concatenate(items)), chosen["row"], chosen["doc_id"], pa.array(np.concatenate(scores))]
    return pa.table(columns, schema=schema)


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    key: str = "doc_id",
    text: str = "text",
    query_key: str = "item_id",
    query_text: str = "text",
    shard_docs: int = SHARD_DOCS,
    block_terms: int = BLOCK_TERMS,
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for each query, ties by ``key``.

    Null and empty texts have no terms: such documents are in no result, such queries have none. Queries with one key
    (null is one, too) are one query with the terms of all. Documents with one key stay documents of their own, each
    with its rank; a null key comes after all others of its score. Either table may be empty, and the result then is.
    Other columns of either table are not read. Whole texts are used.
    """
    bound_batches(docs.sparkSession)
    docs, queries = docs.select(key, text), queries.select(query_key, query_text)
    asked = query_terms(queries, query_key, query_text)
    terms = numbered_terms(asked)
    n_terms = terms.count()
    terms = _sized(terms, n_terms, broadcast_terms)
    size = collection_size(docs, text)
    index = postings(docs, terms, key, text)
    weights = _sized(term_weights(index, size.documents), n_terms, broadcast_terms)

    n_shards = max(1, -(-size.documents // shard_docs))
    n_blocks = max(1, -(-asked.count() // block_terms))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    wanted = (
        asked.join(terms, "term")
        .join(weights, "term_id")
        .filter("weight > 0")
        .groupBy("item_id")
        .agg(F.collect_list("term_id").alias("terms"), F.collect_list("weight").alias("weights"))
        .withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)).cast("int"))
        .withColumn("shard", numbers(n_shards))
    )
    lists = index.select(
        "row", "doc_id", "term_id", _saturated(size.documents, size.terms).alias("impact")
    ).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int"))
    lists = lists.withColumn("block", numbers(n_blocks))
    out = T.StructType(
        [
            T.StructField("item_id", queries.schema[query_key].dataType),
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", docs.schema[key].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    pair = ["shard", "block"]
    tops = lists.groupBy(*pair).cogroup(wanted.groupBy(*pair)).applyInArrow(lambda a, b: _resolve(a, b, k), out)
    best_first = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    ranked = tops.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
