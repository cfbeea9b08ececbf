"""Mergeable quantile sketches (KLL) per part of a table.

Sketches of parts merge to one of the whole, so a changed part asks for its own sketches only. They tell between which
values a rank lies; which value it is, ``exact_quantiles`` finds out by counting. A sketch that is a little out of date
therefore costs time at most, never exactness.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.operators.quantiles import known

#: Size of a sketch (a few kilobytes), and the error of its ranks that is allowed for, as a share of the values.
SIZE, ERROR = 800, 0.006


def part_sketches(df: DataFrame, columns: Sequence[str], part: Column) -> DataFrame:
    """One row per part and column: (part, column_name, n, sketch) of the known values; one pass over the rows."""
    sketch = lambda c: F.struct(F.count(known(c)).alias("n"), F.kll_sketch_agg_double(known(c), F.lit(SIZE)).alias("sketch"))
    wide = df.groupBy(part.alias("part")).agg(*[sketch(c).alias(c) for c in columns])
    return wide.unpivot(["part"], list(columns), "column_name", "found").select("part", "column_name", "found.*")


def brackets(sketches: DataFrame, quantiles: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Values between which each column's quantile lies, from the merged sketches of its parts.

    A column without known values, or without sketches, is left out.
    """
    of_columns = sketches.filter(F.col("column_name").isin(list(quantiles)) & (F.col("n") > 0))
    merged = of_columns.groupBy("column_name").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    shares = sorted(set(quantiles.values()))
    ends = [x for q in shares for x in (max(q - ERROR, 0.0), min(q + ERROR, 1.0))]
    values = [F.kll_sketch_get_quantile_double("sketch", F.lit(r)).alias(f"v{i}") for i, r in enumerate(ends)]
    rows = {r.column_name: r for r in merged.select("column_name", *values).collect()}  # one per column
    place = {q: 2 * i for i, q in enumerate(shares)}
    return {c: (r[f"v{place[quantiles[c]]}"], r[f"v{place[quantiles[c]] + 1}"]) for c, r in rows.items()}
