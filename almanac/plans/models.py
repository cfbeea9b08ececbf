"""The model tables: bronze view, silver table, gold tables, stored by month and read back.

Of the feature table, the frames are stored, which a changed row alters a week's rows on at most, and the seasonal
figures as cells by calendar month; reading merges the cells and derives the other columns. The monthly table is
stored without its changes against the year before, which reading adds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators.checks import not_null_counters, refuse_nulls, rule_counters
from almanac.operators.series import SeriesProfile, profile_of_sizes
from almanac.operators.validity import FLAGS, valid_only
from almanac.plans.features import CELL_MONTH, features_of, frame_rows, seasonal_cells
from almanac.plans.marts import climate_changes, extreme_events_daily, monthly_climate
from almanac.plans.silver import COLUMNS, KEYS, clean
from almanac.session import at_once
from almanac.sources.bronze import read_bronze
from almanac.sources.tables import Snapshot, Transaction, as_view, month_of, snapshot

SILVER = "silver_weather_clean"
FRAMES = "gold_weather_feature_frames"
CELLS = "gold_weather_seasonal_cells"
EVENTS = "gold_extreme_events_daily"
MONTHLY = "gold_monthly_climate"
#: Valid rows per station and month: tells a partial refresh how far frames reach.
COUNTS = "valid_rows_by_month"

DAY = "observed_date"
#: The month that a row of each table is stored under, and what its files are sorted by within it.
LAYOUT: dict[str, tuple[Column | str, list[str]]] = {
    SILVER: (DAY, ["city_id", "timestamp_utc"]),
    FRAMES: (DAY, ["city_id", "timestamp_utc"]),
    CELLS: (CELL_MONTH, ["city_id"]),
    EVENTS: (DAY, ["city_id", DAY]),
    MONTHLY: ("observed_month", ["city_id"]),
    COUNTS: ("month", ["city_id"]),
}


@dataclass
class Models:
    silver: DataFrame
    features: DataFrame
    events: DataFrame
    monthly: DataFrame


def stored_under(name: str) -> tuple[Column, list[str]]:
    """The month expression and the order of a table's rows."""
    column, cluster = LAYOUT[name]
    return (F.col(column) if column in (CELL_MONTH, "month") else month_of(column)), cluster


def valid_counts(silver: DataFrame) -> DataFrame:
    return valid_only(silver).groupBy("city_id", month_of(DAY).alias("month")).agg(F.count("*").alias("n"))


def quality_counters() -> dict[str, Column]:
    """What is counted of silver rows while they are written: missing keys, and each rule's outcomes."""
    return not_null_counters(KEYS) | rule_counters(FLAGS)


def profile_of_counts(counts: DataFrame) -> SeriesProfile:
    """The size of the series from the stored counts of their rows."""
    return profile_of_sizes(counts.groupBy("city_id").agg(F.sum("n").alias("n")))


def build_models(raw: DataFrame, root: str, tiebreak: Sequence[str] = ()) -> Models:
    """Full refresh of all model tables below ``root`` from raw observations, put in place together.

    Silver rows are tested as they are written; if a key is missing, no table changes.
    """
    spark = raw.sparkSession
    change = Transaction(spark, root)

    def write(name: str, df: DataFrame, counted=None) -> dict:
        return change.write(df, name, *stored_under(name), counted)

    counted = write(SILVER, clean(raw, tiebreak, keep=tiebreak), quality_counters())
    refuse_nulls(counted, KEYS)
    change.note(SILVER, counted=counted)
    silver = change.read(SILVER)
    at_once(
        lambda: write(COUNTS, valid_counts(silver)),
        lambda: write(CELLS, seasonal_cells(valid_only(silver))),
        lambda: write(MONTHLY, monthly_climate(silver)),
    )
    write(FRAMES, frame_rows(silver.select(*COLUMNS), profile_of_counts(change.read(COUNTS))))
    write(EVENTS, extreme_events_daily(change.read(FRAMES)))
    return models_of(change.commit())


def refresh_from_lake(spark: SparkSession, lake_root: str, model_root: str) -> Models:
    return build_models(as_view(read_bronze(spark, lake_root), "stg_raw_weather"), model_root)


def stored_features(state: Snapshot, months: Sequence[str] | None = None) -> DataFrame:
    """The feature table, or some months of it; of the seasonal cells, those of the same months of the year."""
    if months is None:
        return features_of(state.read(FRAMES), state.read(CELLS))
    same_season = {m[-2:] for m in months}
    cells = [m for m in state.months(CELLS) if m[-2:] in same_season]
    return features_of(state.read(FRAMES, months), state.read(CELLS, cells))


def models_of(state: Snapshot) -> Models:
    silver = state.read(SILVER).select(*COLUMNS)
    return Models(silver, stored_features(state), state.read(EVENTS), climate_changes(state.read(MONTHLY)))


def load_models(spark: SparkSession, root: str) -> Models:
    """The tables as they are now, all of one state, whether a full or a partial refresh has written them."""
    return models_of(snapshot(spark, root))


def quality_report(state: Snapshot) -> DataFrame:
    """Rows per rule by truth value, as counted while the silver rows were written; no row is read."""
    counted = state.facts(SILVER)["counted"]
    rows = [(f, *[counted[f"{f}_{outcome}"] for outcome in ("invalid", "valid", "unknown")]) for f in FLAGS]
    return state.spark.createDataFrame(rows, "rule string, invalid long, valid long, unknown long")
