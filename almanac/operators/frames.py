"""Row-counted rolling frames, lags and whole-group statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.operators.series import (
    PIECE,
    SeriesProfile,
    profile_series,
    split_long_series,
    without_copies,
)

# A sliding frame is evaluated afresh for every row, so its cost grows with its length. Frames
# longer than this are put together from shorter ones: equal blocks, and a shorter one in front where the length
# asks for it. (A week is seven of the day's frames, which are then evaluated once for both.)
LONGEST_DIRECT = 24


@dataclass(frozen=True)
class Rolling:
    """``fn`` over the current row and the ``rows - 1`` rows before it; short frames count as they are.

    ``fn`` is avg, sum, var, std (sample), min or max.
    """

    name: str
    column: str
    fn: str
    rows: int

    @property
    def blocks(self) -> list[tuple[int, int]]:
        """(length, back) of the blocks that make up the frame: each ends ``back`` rows before the current row."""
        if self.rows <= LONGEST_DIRECT:
            return [(self.rows, 0)]
        fits = [b for b in range(LONGEST_DIRECT // 2, LONGEST_DIRECT + 1) if self.rows % b == 0]
        length = max(fits, default=LONGEST_DIRECT)
        rest = self.rows % length
        whole = [(length, back) for back in range(0, self.rows - rest, length)]
        return whole + ([(rest, self.rows - rest)] if rest else [])

    @property
    def statistics(self) -> list[str]:
        if self.fn in ("min", "max"):
            return [self.fn]
        return ["n", "sum", "m2"] if self.fn in ("var", "std") else ["n", "sum"]

    @property
    def lengths(self) -> list[int]:
        return sorted({length for length, _ in self.blocks})

    def block_column(self, what: str, length: int, back: int | None = None) -> str:
        """Column with a statistic of the block that ends ``back`` rows before the current one."""
        end = "" if back is None else f"_{back}"
        return f"`_{what}_{self.column}_{length}{end}`"

    def frame_column(self, what: str) -> str:
        return f"`_{what}_{self.column}_all{self.rows}`"

    def parts(self, what: str) -> list[str]:
        return [self.block_column(what, *block) for block in self.blocks]


@dataclass(frozen=True)
class Lag:
    name: str
    column: str
    back: int


def lookback_of(rolling: Sequence[Rolling], lags: Sequence[Lag]) -> int:
    return max([r.rows - 1 for r in rolling] + [g.back for g in lags], default=0)


def _block_statistics(r: Rolling, ordered: str) -> dict[str, str]:
    calls = {"n": "count", "sum": "sum", "m2": "var_pop", "min": "min", "max": "max"}
    return {
        r.block_column(s, n): f"{calls[s]}(`{r.column}`) OVER ({ordered} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in r.lengths
        for s in r.statistics
    }


def _mergeable(r: Rolling) -> dict[str, str]:
    """The block statistics as numbers that add up: squared deviations, and 0 for no rows."""

    def value(s: str, length: int) -> str:
        n, own = f"double({r.block_column('n', length)})", r.block_column(s, length)
        return {"n": n, "sum": f"coalesce({own}, 0D)", "m2": f"coalesce({own} * {n}, 0D)"}.get(s, own)

    return {r.block_column(s, n, 0): value(s, n) for n in r.lengths for s in r.statistics}


def _earlier_blocks(r: Rolling, ordered: str) -> dict[str, str]:
    columns = {}
    for s in r.statistics:
        default = "NULL" if s in ("min", "max") else "0D"
        for length, back in r.blocks[1:]:
            earlier = f"lag({r.block_column(s, length, 0)}, {back}, {default}) OVER ({ordered})"
            columns[r.block_column(s, length, back)] = earlier
    return columns


def _totals(r: Rolling) -> dict[str, str]:
    if r.fn in ("min", "max"):
        return {}
    n, total = " + ".join(r.parts("n")), " + ".join(r.parts("sum"))
    return {
        r.frame_column("n"): n,
        r.frame_column("sum"): total,
        r.frame_column("mean"): f"({total}) / nullif({n}, 0D)",
    }


def _squares(r: Rolling) -> str:
    """Squared deviations of the whole frame: those within its blocks and those between them."""
    if len(r.blocks) == 1:
        return r.block_column("m2", *r.blocks[0])
    between = [
        f"{n} * pow({total} / greatest({n}, 1D) - {r.frame_column('mean')}, 2D)"
        for n, total in zip(r.parts("n"), r.parts("sum"), strict=True)
    ]
    return " + ".join(r.parts("m2") + between)


def _result(r: Rolling) -> str:
    if r.fn in ("min", "max"):
        pick = "least" if r.fn == "min" else "greatest"
        parts = r.parts(r.fn)
        return f"{pick}({', '.join(parts)})" if len(parts) > 1 else parts[0]
    n = r.frame_column("n")
    if r.fn == "avg":
        return r.frame_column("mean")
    if r.fn == "sum":
        return f"CASE WHEN {n} > 0D THEN {r.frame_column('sum')} END"
    variance = f"CASE WHEN {n} > 1D THEN ({_squares(r)}) / ({n} - 1D) END"
    return f"sqrt({variance})" if r.fn == "std" else variance


def _added(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{e} AS {n}" for n, e in columns.items()]) if columns else df


def with_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    rolling: Sequence[Rolling] = (),
    lags: Sequence[Lag] = (),
    profile: SeriesProfile | None = None,
) -> DataFrame:
    """Add all frame columns over one shared shuffle and sort.

    A long frame merges the counts, sums and squared deviations of equal blocks: the one ending at
    the current row, and earlier ones fetched by lag. Nothing is ever subtracted, so the result is
    as accurate as the direct frame, at a cost of some lags instead of ``rows`` updates.
    """
    profile = profile or profile_series(df, keys)
    framed = split_long_series(df, keys, order, lookback_of(rolling, lags), profile)
    group = [*keys, PIECE] if profile.has_long_series else list(keys)
    ordered = f"PARTITION BY {', '.join(f'`{k}`' for k in group)} ORDER BY `{order}`"

    def each(stage) -> dict[str, str]:
        return {name: e for r in rolling for name, e in stage(r).items()}

    backwards = {f"`{g.name}`": f"lag(`{g.column}`, {g.back}) OVER ({ordered})" for g in lags}
    framed = _added(framed, backwards | each(lambda r: _block_statistics(r, ordered)))
    framed = _added(framed, each(_mergeable))
    framed = _added(framed, each(lambda r: _earlier_blocks(r, ordered)))
    framed = without_copies(framed)  # they have served once the lags are taken
    framed = _added(framed, each(_totals))
    results = [f"{_result(r)} AS `{r.name}`" for r in rolling]
    return framed.selectExpr(*[f"`{c}`" for c in df.columns], *results, *[f"`{g.name}`" for g in lags])


# Rows of group statistics that may be sent to every task (13 numbers each, about 50 MB).
BROADCAST_GROUPS = 400_000


def with_group_stats(
    df: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    stats: dict[str, Column],
    most_groups: int | None = None,
) -> DataFrame:
    """Attach aggregates over all ``rows`` of its group to every row of ``df``.

    Pre-aggregates, then joins. Keys must not be NULL. ``most_groups`` is a known upper bound on
    the number of groups; the statistics are broadcast only if it is small, otherwise Spark joins
    on the keys (and splits skewed join partitions at run time).
    """
    grouped = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    if most_groups is not None and most_groups <= BROADCAST_GROUPS:
        grouped = F.broadcast(grouped)
    return df.join(grouped, list(keys), "left").select(*df.columns, *stats)
