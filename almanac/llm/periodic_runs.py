"""Periodic runs of words, found by a dictionary of basic factors.

A run is a stretch of words with smallest period q (words q apart are equal), at least ``repeats`` periods and
``least`` words long, that cannot be made longer on either side. The dictionary names, for every power of two L, the
blocks of L words: two blocks have one name if and only if they are equal. Names of blocks twice as long are pairs of
names, so one sort a level gives them, and with them every block's next equal block, its successor.

A period q belongs to the level with L / 2 < q <= L. Inside a run a block's successor is exactly q words on: were it
nearer, the run would have a smaller period. So a block at i whose successor lies at i + q and whose successor's
successor lies at i + 2q, the three within twice the length, form an arithmetic progression that proposes q. The
progressions that begin at neighbouring words with one difference belong to one run. Each proposal is then extended
over equal words to both sides, and equal results are one run. Two sorts of the words a level, whatever the periods.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.common import bound_batches, text_of

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_REPEATS = 6, 4

_WORD = re.compile("[^ \t-\r]+")

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("runs", T.ArrayType(RUN, False), False),
        T.StructField("collapsed", T.StringType(), False),
    ]
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text)


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the blocks, equal for equal keys, and each block's successor (its own place where it has none)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    names = np.empty(len(keys), dtype=np.int64)
    names[order] = np.concatenate(([0], np.cumsum(~same)))
    successor = np.arange(len(keys))
    successor[order[:-1][same]] = order[1:][same]
    return names, successor


def _proposed(successor: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, period) of what the progressions of one level cover, neighbouring ones with one period joined."""
    at = np.arange(len(successor))
    step = successor - at
    fits = (2 * step > length) & (step <= length)
    fits &= step[successor] == step
    start = np.flatnonzero(fits)
    if not len(start):
        return start, start, start
    period = step[start]
    breaks = np.flatnonzero((np.diff(start) != 1) | (np.diff(period) != 0)) + 1
    first, last = np.concatenate(([0], breaks)), np.concatenate((breaks, [len(start)])) - 1
    return start[first], start[last] + 2 * period[last] + length, period[first]


def _extended(ids: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Each stretch made as long as words a period apart stay equal."""
    n = len(ids)
    start, end = start.copy(), end.copy()
    growing = np.arange(len(start))
    while len(growing):
        before = start[growing] - 1
        grows = (before >= 0) & (ids[before] == ids[before + period[growing]])
        growing = growing[grows]
        start[growing] -= 1
    growing = np.arange(len(end))
    while len(growing):
        after = end[growing]
        grows = (after < n) & (ids[np.minimum(after, n - 1)] == ids[after - period[growing]])
        growing = growing[grows]
        end[growing] += 1
    return start, end


def runs_of(ids: np.ndarray, least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> np.ndarray:
    """Rows (start, length, period) of the runs among word numbers, by start, then period. ``repeats`` is 4 at least."""
    if repeats < 4:
        raise ValueError("a progression of three blocks needs runs of four periods")
    found = []
    keys, length = np.asarray(ids, dtype=np.int64), 1
    while len(keys) > 1 and length // 2 + 1 <= len(ids) // repeats:
        names, successor = _named(keys)
        if names.max() == len(names) - 1:  # no block occurs twice, so no longer one does
            break
        start, end, period = _proposed(successor, length)
        if len(start):
            start, end = _extended(ids, start, end, period)
            size = end - start
            long = size >= np.maximum(least, repeats * period)
            found.append(np.column_stack((start, size, period))[long])
        keys = names[:-length] * len(names) + names[length:]
        length *= 2
    if not found:
        return np.empty((0, 3), dtype=np.int64)
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _find(text: str) -> tuple[int, np.ndarray, str]:
    words = words_of(text)
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    runs = runs_of(ids)
    if len(runs):
        dropped = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
        np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
        words = [w for w, d in zip(words, np.cumsum(dropped).tolist(), strict=False) if not d]
    return len(ids), runs, " ".join(words)


@F.arrow_udf(FOUND)
def _found(texts: pa.Array) -> pa.Array:
    counts, parts, collapsed = [], [], []
    for text in texts.to_pylist():
        n, runs, rest = _find(text)
        counts.append(n)
        parts.append(runs)
        collapsed.append(rest)
    offsets = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32))
    rows = np.concatenate(parts) if parts else np.empty((0, 3), dtype=np.int64)
    runs = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], RUN.names)
    lists = pa.ListArray.from_arrays(offsets, runs)
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), lists, pa.array(collapsed, pa.string())], FOUND.names)


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with n_words, its runs (start, length, period) and the text with each run cut to its first period.

    A word is left out of ``collapsed`` if any run holds it after that run's first period; the words left are joined by
    one blank. A null or empty text has no words, no runs and an empty ``collapsed``. Rows are looked at one by one, so
    repeated rows give equal results, and other columns may hold nulls; an empty table gives an empty one. Columns of
    the input named n_words, runs or collapsed are replaced. Texts are read whole; a task holds one batch of them.
    """
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in FOUND.names]
    found = _found(text_of(text))
    return docs.select(*kept, *[found[name].alias(name) for name in FOUND.names])


def digest(found: DataFrame) -> DataFrame:
    """One row a document: how many runs, the longest one, and digests of all runs and of the collapsed text.

    The longest run is that of greatest length, then smallest start, then smallest period; without runs it is null.
    """
    by_size = F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in RUN.names]), F.lit("\n")))
    flat = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.array_min(by_size).alias("longest"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return flat.selectExpr(
        "doc_id",
        "n_runs",
        "longest.start AS start",
        "-longest.size AS length",
        "longest.period AS period",
        "(1000 * -longest.size) div longest.period AS exponent_milli",
        "runs_sha256",
        "collapsed_sha256",
    )
