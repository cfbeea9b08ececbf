"""Exact quantiles of many columns in a bounded number of passes, by one method for all table sizes.

Each pass sketches the wanted ranks of a column within a bracket and counts exactly on which side of its ends they
lie, until a value is hit or few rows are left between the ends, whose wanted elements are then picked in the JVM.
The two ranks that a quantile interpolates between nearly always share a bracket, and then its sketch and counts.
Often repeated values are hit, so they cannot stall the search.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Values a single aggregation buffer may hold per column.
DIRECT_ROWS = 50_000
ACCURACY = 5_000


def known_sql(column: str) -> str:
    """The value as double; NaN counts as missing."""
    return f"nanvl(double(`{column}`), double(NULL))"


def known(column: str) -> Column:
    return F.expr(known_sql(column))


@dataclass(frozen=True)
class _Bracket:
    """Known values of a column strictly between two bounds: how many, and how many lie below."""

    column: str
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None

    def values(self) -> Column:
        value = known(self.column)
        if self.low is not None:
            value = F.when(value > F.lit(self.low), value)
        return value if self.high is None else F.when(value < F.lit(self.high), value)

    def sketch(self, ranks: list[int]) -> Column:
        """Values surely around the ranks, up to the sketch's error; shares are on a coarse grid."""
        at = [(r - self.below + 0.5) / self.inside * ACCURACY for r in (min(ranks), max(ranks))]
        shares = [max(0, math.floor(at[0]) - 2) / ACCURACY, min(ACCURACY, math.ceil(at[1]) + 2) / ACCURACY]
        return F.percentile_approx(self.values(), shares, ACCURACY)

    def counts(self, low: float, high: float) -> list[Column]:
        value = known(self.column)
        tests = (value < F.lit(low), value <= F.lit(low), value < F.lit(high), value <= F.lit(high))
        return [F.count_if(t) for t in tests]

    def narrowed(self, rank: int, low: float, high: float, counted: list[int]) -> _Bracket | float:
        """Exact counts decide: at one of the values, between them, or (sketch missed) outside."""
        under_low, upto_low, under_high, upto_high = counted
        if rank < under_low:
            return replace(self, high=low, inside=under_low - self.below)
        if rank < upto_low:
            return low
        if rank < under_high:
            return replace(self, low=low, high=high, below=upto_low, inside=under_high - upto_low)
        if rank < upto_high:
            return high
        return replace(self, low=high, below=upto_high, inside=self.below + self.inside - upto_high)


def _aggregate(df: DataFrame, columns: Iterable[Column]) -> list:
    return list(df.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def _picked(bracket: _Bracket, ranks: list[int]) -> Column:
    """The elements of the ranks, in order, out of the few values of a bracket."""
    ordered = F.array_sort(F.collect_list(bracket.values()))
    first = min(ranks) - bracket.below
    return F.slice(ordered, first + 1, max(ranks) - min(ranks) + 1)


def _find(
    df: DataFrame, wanted: dict[_Bracket, list[int]], found: dict[tuple[str, int], float], direct_rows: int
) -> dict[tuple[str, int], float]:
    """The value of each (column, rank), added to those that are found already."""
    while wanted:
        near = {b: r for b, r in wanted.items() if b.inside <= direct_rows}
        if near:
            for (b, ranks), values in zip(near.items(), _aggregate(df, [_picked(b, r) for b, r in near.items()]), strict=True):
                found.update({(b.column, r): values[r - min(ranks)] for r in ranks})
        far = {b: r for b, r in wanted.items() if b.inside > direct_rows}
        if not far:
            break
        marks = _aggregate(df, [b.sketch(r) for b, r in far.items()])
        counted = _aggregate(df, [c for b, m in zip(far, marks, strict=True) for c in b.counts(*m)])
        wanted = {}
        for i, ((b, ranks), m) in enumerate(zip(far.items(), marks, strict=True)):
            for r in ranks:
                got = b.narrowed(r, *m, counted[4 * i : 4 * i + 4])
                if isinstance(got, _Bracket):
                    wanted.setdefault(got, []).append(r)
                else:
                    found[b.column, r] = got
    return found


def exact_quantiles(
    df: DataFrame,
    quantiles: dict[str, float],
    direct_rows: int = DIRECT_ROWS,
    hints: dict[str, tuple[float, float]] | None = None,
) -> dict[str, float | None]:
    """Linearly interpolated quantile per column over its known values; None if there are none.

    ``df`` is read once per pass; each pass over a large table cuts the candidates to about a thousandth. ``hints``
    gives values between which a column's quantile probably lies (``sketches.brackets``) and spares the first sketch;
    wrong ones do no harm.
    """
    marks = {c: m for c, m in (hints or {}).items() if c in quantiles}
    sides = [x for c, m in marks.items() for x in _Bracket(c, 0).counts(*m)]
    first = _aggregate(df, [*[F.count(known(c)) for c in quantiles], *sides])
    counts = dict(zip(quantiles, first, strict=False))
    counted = {c: first[len(quantiles) + 4 * i :][:4] for i, c in enumerate(marks)}
    places = {}
    for c, n in counts.items():
        if n:
            position = (n - 1) * quantiles[c]
            low = math.floor(position)
            places[c] = (low, min(low + 1, n - 1), position - low)
    wanted: dict[_Bracket, list[int]] = {}
    found: dict[tuple[str, int], float] = {}
    for c, (a, b, _) in places.items():
        whole = _Bracket(c, counts[c])
        for rank in sorted({a, b}):
            got = whole.narrowed(rank, *marks[c], counted[c]) if c in marks else whole
            if isinstance(got, _Bracket):
                wanted.setdefault(got, []).append(rank)
            else:
                found[c, rank] = got
    _find(df, wanted, found, direct_rows)
    result: dict[str, float | None] = dict.fromkeys(quantiles)
    for c, (a, b, weight) in places.items():
        result[c] = found[c, a] + (found[c, b] - found[c, a]) * weight
    return result


def quantile_table(
    df: DataFrame, quantiles: dict[str, float], direct_rows: int = DIRECT_ROWS, hints: dict | None = None
) -> DataFrame:
    """The quantiles as rows (column, quantile, value)."""
    found = exact_quantiles(df, quantiles, direct_rows, hints)
    rows = [(c, float(quantiles[c]), v) for c, v in found.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, quantile double, value double")
