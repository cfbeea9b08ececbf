"""Dashboard queries over the feature store and the daily events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.display import shown
from almanac.functions.temporal import local_time
from almanac.operators.latest import latest_wins
from almanac.plans.features import with_calendar
from almanac.plans.models import FRAMES
from almanac.sources.tables import Snapshot, snapshot

LOCAL_ZONE = "Asia/Ho_Chi_Minh"
LOCAL_TIME = "timestamp_ict"
LOCAL_DATE = "observed_date_ict"
MOST_COMPARED = 8
ONE_DAY = timedelta(days=1)

# The feature columns that reports show or offer.
REPORT_COLUMNS = [
    "city_id",
    "city_name",
    "lat",
    "lon",
    "timestamp_utc",
    "observed_date",
    "temperature_c",
    "humidity_pct",
    "pressure_hpa",
    "wind_speed_ms",
    "rain_mm",
    "weather_condition",
    "source",
    "rolling_avg_temp_24h",
    "rolling_var_temp_24h",
    "temp_lag_1h",
    "temp_lag_2h",
    "rolling_avg_wind_7d",
    "hour_of_day",
    "month",
    "is_weekend",
]


@dataclass(frozen=True)
class Selection:
    """Report parameters; inverted dates are swapped, ``sources=None`` means every source."""

    start: date
    end: date
    sources: Sequence[str] | None = None

    @property
    def bounds(self) -> tuple[date, date]:
        return min(self.start, self.end), max(self.start, self.end)


def observations(features: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """The report columns, with local time and date, and no missing rain."""
    return (
        features.select(*REPORT_COLUMNS)
        .withColumns({LOCAL_TIME: local_time(F.col("timestamp_utc"), zone)})
        .withColumn(LOCAL_DATE, F.to_date(LOCAL_TIME))
        .fillna(0, ["rain_mm"])
    )


def stored_selection(spark: SparkSession, root: str, selection: Selection, zone: str = LOCAL_ZONE) -> DataFrame:
    """``selected`` on the stored feature table: only the folders of the wanted months are read."""
    low, high = selection.bounds
    state = snapshot(spark, root)
    months = state.months_between(FRAMES, low - ONE_DAY, high + ONE_DAY)
    return selected(observations(with_calendar(state.read(FRAMES, months)), zone), selection)


def date_bounds(obs: DataFrame, days: int = 30) -> DataFrame:
    """First and last local date, the default start, the last reading and the row count."""
    return obs.agg(
        F.min(LOCAL_DATE).alias("min_date"),
        F.max(LOCAL_DATE).alias("max_date"),
        F.greatest(F.min(LOCAL_DATE), F.date_sub(F.max(LOCAL_DATE), days)).alias("default_start"),
        F.max(LOCAL_TIME).alias("updated_at"),
        F.count("*").alias("row_count"),
    )


def selector_values(obs: DataFrame, column: str) -> DataFrame:
    return obs.select(column).dropna().distinct().orderBy(column)


def selected(obs: DataFrame, selection: Selection) -> DataFrame:
    """Rows within the inclusive local dates and the chosen sources (none chosen: no rows).

    Local dates are computed, so the scan cannot be asked for them; it is asked for the stored
    UTC dates around them.
    """
    low, high = selection.bounds
    stored = F.col("observed_date").between(F.lit(low - ONE_DAY), F.lit(high + ONE_DAY))
    rows = obs.filter(stored & F.col(LOCAL_DATE).between(F.lit(low), F.lit(high)))
    if selection.sources is not None:
        rows = rows.filter(F.col("source").isin(list(selection.sources)))
    return rows


def of_city(obs: DataFrame, city: str) -> DataFrame:
    return obs.filter(F.col("city_name") == city)


NEWEST_FIRST = ("timestamp_utc", "city_id")


def _newest_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in NEWEST_FIRST]


def trailing_hours(city_obs: DataFrame, hours: int = 24) -> DataFrame:
    """Readings of one city no older than ``hours`` before its latest one, both ends included.

    The latest time is one row, found by an aggregation, so the city's history is never gathered in one task. On a
    stored table use ``stored_trailing``, which reads its newest months only.
    """
    latest = city_obs.agg(F.max(LOCAL_TIME).alias("_latest"))
    since = F.col("_latest") - F.expr(f"interval {int(hours)} hours")
    return city_obs.join(F.broadcast(latest), F.col(LOCAL_TIME) >= since).drop("_latest")


class StoredCity:
    """The readings of one city and selection on the stored feature table, looked for from the newest month backwards.

    Months follow each other, so once the newest months hold the wanted number of rows, older ones cannot matter.
    """

    def __init__(self, state: Snapshot, city: str, selection: Selection, zone: str = LOCAL_ZONE):
        self.state, self.city, self.selection, self.zone = state, city, selection, zone
        low, high = selection.bounds
        self.months = state.months_between(FRAMES, low - ONE_DAY, high + ONE_DAY)

    def rows(self, months: Sequence[str]) -> DataFrame:
        obs = observations(with_calendar(self.state.read(FRAMES, months)), self.zone)
        return of_city(selected(obs, self.selection), self.city)

    def newest_months(self, wanted: int, known: str = LOCAL_TIME) -> list[str]:
        """The newest months that together hold so many rows with a known value, or all of them; twice as many months
        are looked at in each step as in the one before."""
        left, months, step, found = self.months, [], 1, 0
        while left and found < wanted:
            left, part = left[:-step], left[-step:]
            months, step = part + months, 2 * step
            found += self.rows(part).filter(_is_known(known)).limit(wanted).count()
        return months

    def trailing_hours(self, hours: int = 24) -> DataFrame:
        """``trailing_hours`` of the city's rows."""
        newest = self.newest_months(1)
        latest = self.rows(newest).agg(F.max("timestamp_utc")).first()[0]
        if latest is None:
            return self.rows([])
        since = latest - timedelta(hours=hours)
        months = [m for m in self.months if f"{since:%Y-%m}" <= m <= f"{latest:%Y-%m}"]
        return self.rows(months).filter(F.col("timestamp_utc") >= F.lit(since).cast("timestamp_ntz"))

    def latest_change(self, column: str) -> DataFrame:
        """``latest_change`` of the city's rows."""
        return latest_change(self.rows(self.newest_months(2, column)), column)


def _is_known(column: str) -> Column:
    known = F.col(column).isNotNull()
    return known if column == LOCAL_TIME else known & ~F.isnan(column)


def latest_change(city_obs: DataFrame, column: str) -> DataFrame:
    """Difference between the last two known values, and its label; NULL with fewer than two."""
    last_two = (
        city_obs.filter(_is_known(column))
        .orderBy(*_newest_first())
        .limit(2)
        .select(column, *NEWEST_FIRST)
    )
    return last_two.agg(
        F.array_sort(
            F.collect_list(F.struct(*NEWEST_FIRST, F.col(column).alias("value"))),
        ).alias("pair")
    ).select(
        F.lit(column).alias("measure"),
        F.when(F.size("pair") == 2, F.get("pair", F.lit(1)).value - F.get("pair", F.lit(0)).value).alias("delta"),
    ).withColumn("label", F.when(F.col("delta").isNotNull(), shown(F.col("delta"), " vs prev")))


def city_kpis(city_obs: DataFrame) -> DataFrame:
    """The headline tiles of one city, as numbers and as text."""
    newest = F.struct(*NEWEST_FIRST)
    totals = city_obs.agg(
        F.max_by("temperature_c", newest).alias("latest_temp_c"),
        F.max_by("rolling_avg_temp_24h", newest).alias("avg_temp_24h_c"),
        F.coalesce(F.sum("rain_mm"), F.lit(0.0)).alias("rain_in_range_mm"),
        F.max("wind_speed_ms").alias("peak_wind_ms"),
        F.max_by("humidity_pct", newest).alias("latest_humidity_pct"),
        F.count("*").alias("observations"),
    )
    return totals.withColumns(
        {
            "latest_temp": shown(F.col("latest_temp_c"), " C"),
            "avg_temp_24h": shown(F.col("avg_temp_24h_c"), " C"),
            "rain_in_range": shown(F.col("rain_in_range_mm"), " mm"),
            "peak_wind": shown(F.col("peak_wind_ms"), " m/s"),
            "latest_humidity": shown(F.col("latest_humidity_pct"), "%"),
        }
    )


def temperature_series(city_obs: DataFrame) -> DataFrame:
    """The city's temperature line, oldest first."""
    return city_obs.select(LOCAL_TIME, "temperature_c", "rolling_avg_temp_24h").orderBy(
        F.col(LOCAL_TIME).asc_nulls_last()
    )


def daily_summary(city_obs: DataFrame) -> DataFrame:
    return (
        city_obs.filter(F.col(LOCAL_DATE).isNotNull())
        .groupBy(LOCAL_DATE)
        .agg(
            F.avg("temperature_c").alias("avg_temp_c"),
            F.max("temperature_c").alias("max_temp_c"),
            F.sum("rain_mm").alias("rain_mm"),
            F.avg("wind_speed_ms").alias("avg_wind_ms"),
        )
        .orderBy(F.col(LOCAL_DATE).asc_nulls_last())
    )


def compare_cities(obs: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Daily mean temperature, one column per city."""
    names = sorted(set(cities))
    if len(names) > MOST_COMPARED:
        raise ValueError(f"At most {MOST_COMPARED} cities can be compared, got {len(names)}")
    return (
        obs.filter(F.col("city_name").isin(names) & F.col(LOCAL_DATE).isNotNull())
        .groupBy(LOCAL_DATE)
        .pivot("city_name", names)
        .agg(F.avg("temperature_c"))
        .orderBy(F.col(LOCAL_DATE).asc_nulls_last())
    )


RANKINGS = {
    "avg_temp_c": lambda: F.avg("temperature_c"),
    "total_rain_mm": lambda: F.sum("rain_mm"),
    "peak_wind_ms": lambda: F.max("wind_speed_ms"),
}


def top_cities(obs: DataFrame, by: str, n: int = 10) -> DataFrame:
    """The ``n`` highest cities; equal values in name order."""
    return (
        obs.filter(F.col("city_name").isNotNull())
        .groupBy("city_name")
        .agg(RANKINGS[by]().alias(by))
        .orderBy(F.col(by).desc_nulls_last(), "city_name")
        .limit(n)
    )


EVENT_COUNTS = ["extreme_event_count", "sudden_temp_jump_count", "high_wind_count", "heavy_rain_count"]


def selected_events(events: DataFrame, selection: Selection) -> DataFrame:
    """Daily events within the dates. Their date is the UTC date, and sources do not matter."""
    low, high = selection.bounds
    return events.filter(F.col("observed_date").between(F.lit(low), F.lit(high)))


def event_totals(events: DataFrame, n: int = 12) -> DataFrame:
    return (
        events.filter(F.col("city_name").isNotNull())
        .groupBy("city_name")
        .agg(*[F.sum(c).alias(c) for c in EVENT_COUNTS])
        .orderBy(F.col("extreme_event_count").desc_nulls_last(), "city_name")
        .limit(n)
    )


def city_events(events: DataFrame, city: str) -> DataFrame:
    return of_city(events, city).select("observed_date", *EVENT_COUNTS[1:]).orderBy("observed_date")


def latest_by_city(obs: DataFrame) -> DataFrame:
    """The newest row of every city, with map coordinates."""
    newest = latest_wins(obs.filter(F.col("city_name").isNotNull()), ["city_name"], _newest_first())
    return newest.withColumnsRenamed({"lat": "latitude", "lon": "longitude"})


def latest_readings(obs: DataFrame) -> DataFrame:
    return (
        latest_by_city(obs)
        .select("city_name", LOCAL_TIME, "temperature_c", "humidity_pct", "wind_speed_ms", "rain_mm", "source")
        .orderBy(F.col("temperature_c").desc_nulls_last(), "city_name")
    )


def map_points(obs: DataFrame) -> DataFrame:
    return latest_by_city(obs).select("latitude", "longitude", "temperature_c").dropna()


def observation_listing(city_obs: DataFrame) -> DataFrame:
    """Newest first."""
    return city_obs.select(
        LOCAL_TIME,
        "timestamp_utc",
        "temperature_c",
        "rolling_avg_temp_24h",
        "humidity_pct",
        "pressure_hpa",
        "wind_speed_ms",
        "rain_mm",
        "source",
    ).orderBy(F.col(LOCAL_TIME).desc_nulls_last())
