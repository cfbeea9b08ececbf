"""Gold marts: daily extreme events and monthly change against the year before."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions.temporal import truncated
from almanac.operators.validity import valid_only

PLACE = ["city_id", "city_name", "lat", "lon"]


@dataclass(frozen=True)
class EventThresholds:
    """When a reading counts as extreme (strictly above, except rain)."""

    temp_jump_c: float = 5.0
    wind_times_week: float = 3.0
    heavy_rain_mm: float = 50.0


def event_flags(limits: EventThresholds = EventThresholds()) -> dict[str, Column]:
    return {
        "sudden_temp_jump": F.col("temperature_c") - F.col("temp_lag_2h") > F.lit(limits.temp_jump_c),
        "high_wind": F.col("wind_speed_ms") > F.col("rolling_avg_wind_7d") * F.lit(limits.wind_times_week),
        "heavy_rain": F.col("rain_mm") >= F.lit(limits.heavy_rain_mm),
    }


def extreme_events_daily(features: DataFrame, limits: EventThresholds = EventThresholds()) -> DataFrame:
    """Days with at least one extreme reading, per station."""
    flags = event_flags(limits)
    any_flag = F.col("sudden_temp_jump") | F.col("high_wind") | F.col("heavy_rain")
    daily = (
        features.withColumns(flags)
        .groupBy(*PLACE, "observed_date")
        .agg(
            *[F.count_if(F.col(name)).alias(f"{name}_count") for name in flags],
            F.count_if(any_flag).alias("extreme_event_count"),
            F.max("temperature_c").alias("max_temperature_c"),
            F.max("wind_speed_ms").alias("max_wind_speed_ms"),
            F.sum("rain_mm").alias("total_rain_mm"),
        )
    )
    return daily.filter(F.col("extreme_event_count") > 0)


@dataclass(frozen=True)
class PeriodChange:
    """Averages and totals per period, and each average's change against ``back`` rows of the series earlier.

    ``averages`` maps an output name to (column, name of the change); ``totals`` maps an output name to a column.
    The comparison counts rows, so a missing period shifts it.
    """

    group: Sequence[str]
    series: Sequence[str]
    time: str
    unit: str
    period: str
    averages: dict[str, tuple[str, str]]
    totals: dict[str, str]
    back: int = 12

    def per_period(self, df: DataFrame) -> DataFrame:
        return df.groupBy(*self.group, truncated(self.unit, F.col(self.time)).alias(self.period)).agg(
            *[F.avg(column).alias(name) for name, (column, _) in self.averages.items()],
            *[F.sum(column).alias(name) for name, column in self.totals.items()],
        )

    def changes(self, per_period: DataFrame) -> DataFrame:
        history = Window.partitionBy(*self.series).orderBy(self.period)
        columns: list = [*self.group, self.period]
        for name, (_, change) in self.averages.items():
            columns += [name, (F.col(name) - F.lag(name, self.back).over(history)).alias(change)]
        return per_period.select(*columns, *self.totals)


def period_delta(df: DataFrame, *parts, **more) -> DataFrame:
    """Averages, totals and changes of a table; the arguments are those of ``PeriodChange``."""
    change = PeriodChange(*parts, **more)
    return change.changes(change.per_period(df))


CLIMATE = PeriodChange(
    group=["city_id", "city_name"],
    series=["city_id"],
    time="timestamp_utc",
    unit="month",
    period="observed_month",
    averages={
        "avg_temp_c": ("temperature_c", "temp_delta_yoy_c"),
        "avg_humidity_pct": ("humidity_pct", "humidity_delta_yoy_pct"),
    },
    totals={"total_rain_mm": "rain_mm"},
)


def monthly_climate(silver: DataFrame) -> DataFrame:
    """Per station and month, without the changes."""
    return CLIMATE.per_period(valid_only(silver))


def climate_changes(monthly: DataFrame) -> DataFrame:
    return CLIMATE.changes(monthly)


def monthly_climate_delta(silver: DataFrame) -> DataFrame:
    return climate_changes(monthly_climate(silver))
