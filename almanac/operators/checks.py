"""Declarative data tests and quality counts; each is one aggregation over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: how many rows lack a value."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "failures")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    failed = [r.column_name for r in null_counts(df, columns).filter("failures > 0").collect()]
    if failed:
        raise ValueError(f"NULL values in columns: {sorted(failed)}")


def not_null_counters(columns: Sequence[str]) -> dict[str, Column]:
    """Missing values per column, as aggregates to be taken of rows on their way."""
    return {f"{c}_missing": F.count_if(F.col(c).isNull()) for c in columns}


def refuse_nulls(counted: dict[str, int], columns: Sequence[str]) -> None:
    """Fail if counters that were taken on the way saw a missing value."""
    if failed := sorted(c for c in columns if counted[f"{c}_missing"]):
        raise ValueError(f"NULL values in columns: {failed}")


def _outcomes(flag: str) -> dict[str, Column]:
    value = F.col(flag)
    return {"invalid": F.count_if(value), "valid": F.count_if(~value), "unknown": F.count_if(value.isNull())}


def rule_counters(flags: Sequence[str]) -> dict[str, Column]:
    """Rows per flag by truth value, as aggregates to be taken of rows on their way."""
    return {f"{f}_{outcome}": count for f in flags for outcome, count in _outcomes(f).items()}


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"Rows are not unique on {list(keys)}")


def tests_report(df: DataFrame, not_null: Sequence[str], unique: Sequence[str]) -> DataFrame:
    """Failures per declared test."""
    nulls = null_counts(df, not_null).select(
        F.concat(F.lit("not_null_"), "column_name").alias("test"), "failures"
    )
    copies = duplicate_keys(df, unique).agg(F.count("*").alias("failures"))
    return nulls.unionByName(copies.select(F.lit("unique_key").alias("test"), "failures"))


def rule_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows per flag by truth value."""
    wide = df.agg(*[F.struct(*[n.alias(o) for o, n in _outcomes(f).items()]).alias(f) for f in flags])
    return wide.unpivot([], list(flags), "rule", "n").select("rule", "n.invalid", "n.valid", "n.unknown")


def missing_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """The columns that a frame lacks, a row each; looks at the schema only."""
    have = set(df.columns)
    rows = [(c,) for c in dict.fromkeys(needed) if c not in have]
    return df.sparkSession.createDataFrame(rows, "column_name string")


def require_columns(df: DataFrame, needed: Sequence[str], message: str = "Missing columns") -> None:
    """Fail on absent columns; looks at the schema only."""
    missing = sorted(r.column_name for r in missing_columns(df, needed).collect())
    if missing:
        raise ValueError(f"{message}: {missing}")
