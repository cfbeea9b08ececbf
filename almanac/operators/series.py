"""Splitting long series so that ordered windows do not run one key in one task.

A window partitioned by the series key sends a whole series to one task. Where a single series may
hold a large share of the table, its time axis is cut at row quantiles, and every piece is given
copies of the ``lookback`` rows that come before it. Frames that look back at most that far then
see exactly the rows they would see in the whole series. The copies are dropped afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions.temporal import sort_key

PIECE = "_piece"
COPY = "_copy"

DEFAULT_PIECE_ROWS = 2_000_000
# The cut points travel to every task, so their number is bounded whatever the table size.
MOST_PIECES = 8192


@dataclass(frozen=True)
class SeriesProfile:
    """How many series there are, and how many rows a task should take at most."""

    n_series: int
    n_rows: int
    longest: int
    piece_rows: int

    @property
    def has_long_series(self) -> bool:
        return self.longest > self.piece_rows


def profile_series(df: DataFrame, keys: Sequence[str], piece_rows: int = DEFAULT_PIECE_ROWS) -> SeriesProfile:
    """One pass over the key columns; a superset of the rows also serves (it only cuts earlier)."""
    return profile_of_sizes(df.groupBy(*keys).agg(F.count("*").alias("n")), piece_rows)


def profile_of_sizes(sizes: DataFrame, piece_rows: int = DEFAULT_PIECE_ROWS) -> SeriesProfile:
    """The same from a table with the number of rows ``n`` of each series."""
    row = sizes.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.max("n").alias("top")).first()
    total = row.n or 0
    return SeriesProfile(row.k, total, row.top or 0, max(piece_rows, math.ceil(total / MOST_PIECES)))


def _cuts_passed(cuts: Column, n_cuts: int, at: Column) -> Column:
    """How many entries of the ascending array are <= ``at`` (binary search)."""
    steps = [1 << b for b in range(max(n_cuts, 1).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda passed, step: F.when(F.get(cuts, passed + step - 1) <= at, passed + step).otherwise(passed),
    )


def _row_quantiles(df, keys, sizes, piece_rows, longest):
    """Ascending cut points per long series, about ``piece_rows`` rows apart."""
    most = math.ceil(longest / piece_rows)
    fractions = [i / most for i in range(1, most)]
    marks = df.groupBy(*keys).agg(
        F.percentile_approx("_at", fractions, max(10_000, 20 * most)).alias("marks")
    )
    wanted = F.ceil(F.col("n") / F.lit(piece_rows)).cast("int")
    picked = F.transform(
        F.sequence(F.lit(1), wanted - 1),
        lambda j: F.get("marks", F.floor(j * F.lit(most) / wanted).cast("int") - 1),
    )
    return marks.join(F.broadcast(sizes), keys).select(
        *keys, F.when(wanted > 1, F.array_sort(F.array_distinct(picked))).alias("cuts")
    )


def _pieces(axis, keys, cuts, cuts_schema, lookback):
    """Per piece of the cut series: its rows, and where the last ``lookback`` of them begin (if it has that many)."""
    table = axis.sparkSession.createDataFrame([k + (c,) for k, c in cuts.items()], cuts_schema)
    n_cuts = max(map(len, cuts.values()))
    placed = axis.join(F.broadcast(table), keys).select(
        *keys, "_at", _cuts_passed(F.col("cuts"), n_cuts, F.col("_at")).alias(PIECE)
    )
    from_end = F.row_number().over(Window.partitionBy(*keys, PIECE).orderBy(F.col("_at").desc()))
    start = F.max(F.when(F.col("_back") == max(lookback, 1), F.col("_at"))).alias("start")
    rows = placed.withColumn("_back", from_end).groupBy(*keys, PIECE).agg(F.count("*").alias("n"), start).collect()
    return {(*[r[k] for k in keys], r[PIECE]): r for r in rows}


def split_long_series(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    lookback: int,
    profile: SeriesProfile,
) -> DataFrame:
    """Add the piece number and the copy mark; rows must be unique on keys and order.

    ``df`` is read several times when there are long series, so pass a stored table then.
    """
    if not profile.has_long_series:
        return df.withColumns({PIECE: F.lit(0), COPY: F.lit(False)})

    spark = df.sparkSession
    keys = list(keys)
    piece_rows = max(profile.piece_rows, lookback)
    key_fields = [df.schema[k] for k in keys]

    # At most n_rows / piece_rows series are that long.
    sizes_schema = T.StructType(key_fields + [T.StructField("n", T.LongType())])
    long_sizes = (
        df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > piece_rows).select(*keys, "n")
    ).collect()
    if not long_sizes:
        return df.withColumns({PIECE: F.lit(0), COPY: F.lit(False)})
    sizes = spark.createDataFrame(long_sizes, sizes_schema)
    axis = df.select(*keys, sort_key(F.col(order)).alias("_at")).join(
        F.broadcast(sizes.select(*keys)), keys, "left_semi"
    )

    longest = max(r.n for r in long_sizes)
    cut_rows = _row_quantiles(axis, keys, sizes, piece_rows, longest).collect()
    cuts_schema = T.StructType(key_fields + [T.StructField("cuts", T.ArrayType(T.LongType()))])

    # Count the pieces exactly and drop cuts that would leave a piece shorter than the lookback:
    # the rows before a cut then always lie in the one piece before it. The same pass tells where the last
    # ``lookback`` rows of each piece begin, which holds unless cuts were dropped.
    found = {tuple(r[k] for k in keys): r.cuts for r in cut_rows}
    pieces = _pieces(axis, keys, found, cuts_schema, lookback)
    kept = {}
    for key, cuts in found.items():
        good, filled = [], 0
        for i, cut in enumerate(cuts):
            filled += pieces[key + (i,)].n if key + (i,) in pieces else 0
            if filled >= max(lookback, 1):
                good.append(cut)
                filled = 0
        kept[key] = good
    n_cuts = max(map(len, kept.values()))
    if n_cuts == 0:
        return df.withColumns({PIECE: F.lit(0), COPY: F.lit(False)})
    if kept != found:
        pieces = _pieces(axis, keys, kept, cuts_schema, lookback)
    plan_schema = T.StructType(
        cuts_schema.fields + [T.StructField("tails", T.ArrayType(T.LongType()))]
    )
    tails = {k: [pieces[k + (i,)].start for i in range(len(cuts))] for k, cuts in kept.items()}
    plan = spark.createDataFrame([k + (cuts, tails[k]) for k, cuts in kept.items()], plan_schema)

    at = sort_key(F.col(order))
    placed = (
        df.join(F.broadcast(plan), keys, "left")
        .withColumn("_at", at)
        .withColumn(
            "_own", F.when(F.col("cuts").isNull(), 0).otherwise(_cuts_passed(F.col("cuts"), n_cuts, F.col("_at")))
        )
    )
    own = F.struct(F.col("_own").alias(PIECE), F.lit(False).alias(COPY))
    ahead = F.struct((F.col("_own") + 1).alias(PIECE), F.lit(True).alias(COPY))
    in_tail = F.col("_at") >= F.get("tails", F.col("_own")) if lookback > 0 else F.lit(False)
    places = F.when(in_tail, F.array(own, ahead)).otherwise(F.array(own))
    return placed.select(*df.columns, F.inline(places))


def without_copies(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(COPY)).drop(PIECE, COPY)
