"""Near-duplicates by SimHash, with pivot distance tables deciding which pairs are compared.

Texts become 64-bit fingerprints of word shingles; equal fingerprints are merged first, so a group of exact copies
counts once. Every distinct fingerprint gets its row of the pivot table: Hamming distances to PIVOTS reference
fingerprints. By the triangle inequality two fingerprints within MAX_BITS bits differ by at most MAX_BITS in every
coordinate; pairs that differ by more in any one are discarded, and only the others are compared bit by bit.

Which pairs meet at all: two fingerprints within k bits agree in at least one of k + 1 blocks of their bits, which
means equal distances to all references within that block. A bucket is one block and its bits. A bucket of more
than BUCKET_ROWS fingerprints is split again by blocks of its open bits, where the same argument holds, until it
is small enough, or until no more than k bits are open and all of its rows are linked anyway. So no link is lost,
no task gets more than BUCKET_ROWS fingerprints of a bucket at once, and no table of all pairs is made: a bucket
returns at most one link per fingerprint, enough to connect those that pairs connect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.common import bound_batches, spare_names, stored, text_of
from almanac.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: References of the pivot table and the seed they are drawn with.
PIVOTS = 24
PIVOT_SEED = 7
#: Buckets above this many distinct fingerprints are split.
BUCKET_ROWS = 2048

#: Tables up to this many rows (a number each) are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Hashes of a text that are unpacked into bits at once.
_CHUNK = 8192


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the shingle hashes; without words the fingerprint is zero."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    stops = ends[k - 1 :].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[i:j], SEED) for i, j in zip(starts, stops)), np.uint64, len(stops))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i : i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(docs: DataFrame, into: str, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Adds the fingerprint as a long with the same 64 bits; a null text has no words."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf(T.LongType())
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(into, fingerprints.asNondeterministic()(text_of(text)))


def pivots() -> np.ndarray:
    return np.random.default_rng(PIVOT_SEED).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def _blocks(open_mask: int, parts: int) -> list[int]:
    """The set bits of a mask, dealt into masks of nearly equal size."""
    bits = [i for i in range(64) if open_mask >> i & 1]
    return [sum(1 << i for i in bits[len(bits) * p // parts : len(bits) * (p + 1) // parts]) for p in range(parts)]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _rooted(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position connected to each of n positions by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if np.array_equal(before, root):
            return root


def bucket_links(prints: np.ndarray, table: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint of one bucket, the position of the smallest one it is connected to in the bucket."""
    n = len(prints)
    left, right = [], []
    order = np.argsort(table[:, 0], kind="stable")
    first = table[order, 0].astype(np.int32)
    ends = np.searchsorted(first, first + max_bits, side="right")
    for i in range(n - 1):
        others = order[i + 1 : ends[i]]
        if len(others) == 0:
            continue
        apart = np.abs(table[others].astype(np.int16) - table[order[i]].astype(np.int16)).max(axis=1)
        others = others[apart <= max_bits]
        others = others[np.bitwise_count(prints[others] ^ prints[order[i]]) <= max_bits]
        if len(others):
            left.append(np.full(len(others), order[i]))
            right.append(others)
    if not left:
        return np.arange(n)
    return _rooted(n, np.concatenate(left), np.concatenate(right))


def _tiny_links(keys: np.ndarray, prints: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of many buckets at once, rows sorted by bucket: each row against the next, the one after, and so on."""
    left, right = [], []
    for step in range(1, len(keys)):
        same = np.flatnonzero(keys[step:] == keys[:-step])
        if len(same) == 0:
            break
        apart = np.abs(table[same].astype(np.int16) - table[same + step].astype(np.int16)).max(axis=1)
        same = same[apart <= max_bits]
        same = same[np.bitwise_count(prints[same] ^ prints[same + step]) <= max_bits]
        left.append(same)
        right.append(same + step)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


#: Buckets up to this size are compared together with their neighbours in the partition.
_TINY = 64


def _link_partition(max_bits: int):
    references = pivots()

    def emit(prints, roots):
        far = roots != np.arange(len(prints))
        return prints[far].view(np.int64), prints[roots[far]].view(np.int64)

    def solve(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        table = np.stack([np.bitwise_count(prints ^ p) for p in references], axis=1)
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        tiny = np.repeat(sizes <= _TINY, sizes)
        a, b = [], []
        if tiny.any():
            k, p = keys[tiny], prints[tiny]
            left, right = _tiny_links(k, p, table[tiny], max_bits)
            x, y = emit(p, _rooted(len(p), left, right))
            a.append(x)
            b.append(y)
        for s, n in zip(starts[sizes > _TINY], sizes[sizes > _TINY]):
            x, y = emit(prints[s : s + n], bucket_links(prints[s : s + n], table[s : s + n], max_bits))
            a.append(x)
            b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints, held = [], [], 0
        for batch in batches:
            keys.append(batch.column("bucket").to_numpy())
            prints.append(batch.column("fp").to_numpy().view(np.uint64))
            held += len(keys[-1])
            if held >= 16 * BUCKET_ROWS:
                k, p = np.concatenate(keys), np.concatenate(prints)
                cut = int(np.argmax(k == k[-1]))  # the last bucket may go on in the next batch
                if cut:
                    yield solve(k[:cut], p[:cut])
                keys, prints, held = [k[cut:]], [p[cut:]], len(k) - cut
        if held:
            yield solve(np.concatenate(keys), np.concatenate(prints))

    return run


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints ``fp`` which pairs within max_bits bits connect."""
    spark = prints.sparkSession
    full = 2**64 - 1
    level = prints.select("fp", F.lit(0).cast("long").alias("bucket"), F.lit(_signed(full)).cast("long").alias("open"))
    masks, links = [full], spark.createDataFrame([], "a long, b long")
    while masks:
        blocks = {_signed(m): [_signed(b) for b in _blocks(m, max_bits + 1) if b] for m in masks}
        if len(masks) == 1:
            each = F.array(*[F.lit(b).cast("long") for b in next(iter(blocks.values()))])
            dealt = level.withColumn("block", F.explode(each))
        else:
            pairs = [(m, b) for m, own in blocks.items() for b in own]
            dealt = level.join(F.broadcast(spark.createDataFrame(pairs, "open long, block long")), "open")
        dealt = dealt.select(
            "fp",
            F.xxhash64("bucket", "block", F.col("fp").bitwiseAND(F.col("block"))).alias("bucket"),
            F.col("open").bitwiseAND(F.bitwise_not("block")).alias("open"),
        )
        dealt = stored(dealt, "buckets")
        large = stored(dealt.groupBy("bucket").count().filter(F.col("count") > bucket_rows).select("bucket"), "large")
        n_large = large.count()
        some = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
        small = dealt.join(some, "bucket", "left_anti") if n_large else dealt
        found = small.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket", "fp")
        links = links.union(found.mapInArrow(_link_partition(max_bits), "a long, b long"))
        if not n_large:
            break
        level = dealt.join(some, "bucket", "left_semi")
        masks = [m % 2**64 for (m,) in level.select("open").distinct().collect()]  # set by the choices of blocks alone
        closed = [_signed(m) for m in masks if m.bit_count() <= max_bits]
        masks = [m for m in masks if m.bit_count() > max_bits]
        if closed:
            near = level.filter(F.col("open").isin(closed))
            least = near.groupBy("bucket").agg(F.min("fp").alias("b"))
            links = links.union(near.join(least, "bucket").filter("fp != b").select(F.col("fp").alias("a"), "b"))
            level = level.filter(~F.col("open").isin(closed))
    return links


def _members(docs: DataFrame, text: str, doc_id: str, shingle: int, max_bits: int) -> DataFrame:
    """Per row: doc_id, fp, component (its smallest fingerprint) and component_id (its smallest doc_id)."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = stored(with_fingerprint(slim, "fp", shingle=shingle).drop("text"), "fingerprints")
    groups = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    joined = components(fingerprint_links(groups.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    own = groups.join(joined, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = own.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = stored(own.join(named, "component").select("fp", "component", "component_id"), "classes")
    return marked.join(classes, "fp")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links.

    A null or empty text has fingerprint zero, which links like any other. Rows without an id are members of their
    component but never name it; it is null if no member has an id. Repeated rows are members each.
    """
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _members(docs, text, doc_id, shingle, max_bits).select("doc_id", hexed, "component_id")


def keep_first(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of each component stays, with its columns as they came: that of the smallest doc_id, or one without
    an id if no member has one. If several rows of a component bear that id, the one of the smallest fingerprint and
    then the smallest text stays, null after all others."""
    keeper, least, fp, row = spare_names(docs.columns, "keeper", "least", "fp", "row")
    rows = stored(_members(docs, text, doc_id, shingle, max_bits), "members")
    single = rows.groupBy("doc_id").count().filter("count = 1 and doc_id is not null").select(F.col("doc_id").alias(keeper))
    named = rows.filter("doc_id <=> component_id").groupBy("component").agg(
        F.first("component_id").alias(keeper), F.min("fp").alias(least)
    )
    once = named.join(single, keeper, "left_semi").select(keeper)
    kept = docs.join(once, F.col(doc_id) == F.col(keeper), "left_semi")
    more = stored(named.join(single, keeper, "left_anti").select(keeper, least), "keepers")
    if more.isEmpty():
        return kept
    again = docs.join(more.select(keeper).distinct(), F.col(doc_id).eqNullSafe(F.col(keeper)), "left_semi")
    marked = with_fingerprint(again, fp, text, shingle)
    wanted = F.col(doc_id).eqNullSafe(F.col(keeper)) & (F.col(fp) == F.col(least))
    picked = marked.join(more, wanted, "left_semi").groupBy(doc_id, fp).agg(
        F.min_by(F.struct(*docs.columns), F.struct(F.col(text).isNull(), text_of(text))).alias(row)
    )
    return kept.union(picked.select(f"{row}.*"))
