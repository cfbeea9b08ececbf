"""The 69-column feature store: rolling, lagged, seasonal, calendar and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators.frames import Lag, Rolling, with_frames, with_group_stats
from almanac.operators.series import SeriesProfile, profile_series
from almanac.operators.validity import valid_only

SERIES = ["city_id"]
TIME = "timestamp_utc"

# The silver columns that the feature table begins with.
BASE = [
    "city_id",
    "city_name",
    "lat",
    "lon",
    "timestamp_utc",
    "observed_hour_utc",
    "observed_date",
    "temperature_c",
    "humidity_pct",
    "pressure_hpa",
    "wind_speed_ms",
    "rain_mm",
    "weather_condition",
    "source",
]

# short name -> column
MEASURES = {
    "temp": "temperature_c",
    "humidity": "humidity_pct",
    "pressure": "pressure_hpa",
    "wind": "wind_speed_ms",
    "rain": "rain_mm",
}

DAY, WEEK = 24, 168  # rows, not hours


def _rolling(fn: str, short: str, span: str) -> Rolling:
    rows = {"24h": DAY, "7d": WEEK}[span]
    return Rolling(f"rolling_{fn}_{short}_{span}", MEASURES[short], fn, rows)


ROLLING_24H = [_rolling(fn, "temp", "24h") for fn in ("avg", "min", "max", "std", "var")]
ROLLING_24H += [_rolling("avg", "humidity", "24h"), _rolling("avg", "pressure", "24h")]
ROLLING_24H += [_rolling(fn, "rain", "24h") for fn in ("avg", "sum", "max")]
ROLLING_7D = [_rolling(fn, short, "7d") for short in ("temp", "wind") for fn in ("avg", "std")]

LAGS = [Lag("temp_lag_1h", "temperature_c", 1), Lag("temp_lag_2h", "temperature_c", 2)]
LAGS += [Lag(f"{short}_lag_1h", MEASURES[short], 1) for short in ("humidity", "pressure", "wind")]

# Calendar columns, in the order of the stored table.
CALENDAR = [
    "hour_of_day",
    "month",
    "day_of_week",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
]
SEASON = ["city_id", "month", "hour_of_day"]
SEASONS_PER_SERIES = 12 * 24
CELL_MONTH = "cell_month"
SEASONAL = [f"city_month_hour_{fn}_{short}" for short in MEASURES for fn in ("avg", "std")]

# Frames and lags, in the order of the stored table.
WINDOW_COLUMNS = [
    "rolling_avg_temp_24h",
    "rolling_min_temp_24h",
    "rolling_max_temp_24h",
    "rolling_std_temp_24h",
    "rolling_var_temp_24h",
    "rolling_avg_temp_7d",
    "rolling_std_temp_7d",
    "temp_lag_1h",
    "temp_lag_2h",
    "humidity_lag_1h",
    "pressure_lag_1h",
    "wind_lag_1h",
    "rolling_avg_humidity_24h",
    "rolling_avg_pressure_24h",
    "rolling_avg_rain_24h",
    "rolling_sum_rain_24h",
    "rolling_max_rain_24h",
    "rolling_avg_wind_7d",
    "rolling_std_wind_7d",
]


def with_calendar(df: DataFrame, time: str = TIME) -> DataFrame:
    """Hour, month, weekday (0 = Sunday), weekend mark, and hour and month on the circle."""
    dated = df.selectExpr(
        "*",
        f"bigint(hour({time})) AS hour_of_day",
        f"bigint(month({time})) AS month",
        f"bigint(dayofweek({time}) - 1) AS day_of_week",
    )
    circles = [
        f"{fn}(2D * pi() * {column} / {period}D) AS {name}_{fn}"
        for name, column, period in (("hour", "hour_of_day", 24), ("month", "month", 12))
        for fn in ("sin", "cos")
    ]
    return dated.selectExpr("*", "CASE WHEN day_of_week IN (0, 6) THEN 1 ELSE 0 END AS is_weekend", *circles)


def with_seasonal(df: DataFrame, valid: DataFrame, n_series: int | None = None) -> DataFrame:
    """Mean and deviation of every measure per series, month of year and hour of day.

    Both frames carry the calendar columns; the statistics come from ``valid``.
    """
    stats = {}
    for short, column in MEASURES.items():
        stats[f"city_month_hour_avg_{short}"] = F.avg(column)
        stats[f"city_month_hour_std_{short}"] = F.stddev_samp(column)
    most = None if n_series is None else n_series * SEASONS_PER_SERIES
    return with_group_stats(df, valid, SEASON, stats, most)


def with_changes(df: DataFrame) -> DataFrame:
    """Differences to lags and rolling averages, temperature range, dew point."""
    to_lags = [f"{g.column} - {g.name} AS {g.name.replace('lag', 'delta')}" for g in LAGS]
    to_averages = [
        f"{MEASURES[short]} - rolling_avg_{short}_{span} AS {short}_vs_{span}_avg"
        for short, span in (("temp", "24h"), ("temp", "7d"), ("humidity", "24h"), ("pressure", "24h"), ("wind", "7d"))
    ]
    return df.selectExpr(
        "*",
        *to_lags,
        *to_averages,
        "rolling_max_temp_24h - rolling_min_temp_24h AS temp_range_24h",
        "temperature_c - (100D - humidity_pct) / 5D AS dew_point_c",
    )


def with_seasonal_scores(df: DataFrame) -> DataFrame:
    """Distance to the seasonal mean, also in deviations (NULL where there is no spread)."""
    scores = [
        f"({column} - city_month_hour_avg_{short}) / nullif(city_month_hour_std_{short}, 0D)"
        f" AS {short}_city_month_hour_zscore"
        for short, column in MEASURES.items()
    ]
    return df.selectExpr(
        "*", "temperature_c - city_month_hour_avg_temp AS temp_vs_city_month_hour_avg", *scores
    )


def frame_rows(silver: DataFrame, profile: SeriesProfile | None = None) -> DataFrame:
    """The valid silver rows with their frames and lags: what a stored feature table keeps of each row.

    ``profile`` sizes the series (``profile_series``); pass one taken from a cheaper superset of
    the rows to spare a pass.
    """
    valid = valid_only(silver).select(*BASE)
    profile = profile or profile_series(valid, SERIES)
    framed = with_frames(valid, SERIES, TIME, ROLLING_24H + ROLLING_7D, LAGS, profile)
    return framed.select(*BASE, *WINDOW_COLUMNS)


def _in_order(placed: DataFrame) -> DataFrame:
    """The derived columns added, all columns in the order of the contract."""
    derived = with_seasonal_scores(with_changes(placed))
    leading = [*BASE, *WINDOW_COLUMNS, *CALENDAR, *SEASONAL]
    return derived.select(*leading, *[c for c in derived.columns if c not in leading])


def feature_store(silver: DataFrame, profile: SeriesProfile | None = None) -> DataFrame:
    """All features of the valid silver rows. Columns nobody reads are pruned, with their windows and the join."""
    valid = valid_only(silver).select(*BASE)
    profile = profile or profile_series(valid, SERIES)
    framed = frame_rows(silver, profile)
    return _in_order(with_seasonal(with_calendar(framed), with_calendar(valid), profile.n_series))


def seasonal_cells(valid: DataFrame) -> DataFrame:
    """Count, mean and squared deviations of every measure per series, month of year, hour of day and calendar month.

    Cells of different calendar months merge to those of all their rows (``merged_cells``), so a changed month asks
    for its own cells only.
    """
    count, mean = "count({c})", "avg({c})"
    squares = "coalesce(var_pop({c}), 0D) * count({c})"
    parts = {"n": count, "mean": mean, "m2": squares}
    figures = [F.expr(e.format(c=c)).alias(f"{k}_{short}") for short, c in MEASURES.items() for k, e in parts.items()]
    dated = with_calendar(valid).withColumn(CELL_MONTH, F.date_format(TIME, "yyyy-MM"))
    return dated.groupBy(CELL_MONTH, *SEASON).agg(*figures)


def merged_cells(cells: DataFrame) -> DataFrame:
    """The seasonal figures per series, month of year and hour of day, from the cells of all calendar months.

    A group has one cell a year. They are merged in order of time, so that equal cells give equal figures.
    """
    fields = [f"{k}_{short}" for short in MEASURES for k in ("n", "mean", "m2")]
    years = F.array_sort(F.collect_list(F.struct(CELL_MONTH, *fields))).alias("years")
    grouped = cells.groupBy(*SEASON).agg(years)
    merged = [F.expr(_merged(short)).alias(f"_{short}") for short in MEASURES]
    figures = []
    for short in MEASURES:
        n, mean, m2 = (f"_{short}.{k}" for k in ("n", "mean", "m2"))
        figures.append(f"CASE WHEN {n} > 0D THEN {mean} END AS city_month_hour_avg_{short}")
        figures.append(f"CASE WHEN {n} > 1D THEN sqrt({m2} / ({n} - 1D)) END AS city_month_hour_std_{short}")
    return grouped.select(*SEASON, *merged).selectExpr(*SEASON, *figures)


def _merged(short: str) -> str:
    """Count, mean and squared deviations of the rows of all cells in ``years``, joined one after the other."""
    cell = f"double(y.n_{short}) AS n, coalesce(y.mean_{short}, 0D) AS mean, y.m2_{short} AS m2"
    return f"""aggregate(
        transform(years, y -> struct({cell})),
        struct(0D AS n, 0D AS mean, 0D AS m2),
        (a, y) -> CASE WHEN y.n = 0D THEN a ELSE struct(
            a.n + y.n AS n,
            a.mean + (y.mean - a.mean) * y.n / (a.n + y.n) AS mean,
            a.m2 + y.m2 + (y.mean - a.mean) * (y.mean - a.mean) * a.n * y.n / (a.n + y.n) AS m2) END)"""


def features_of(frames: DataFrame, cells: DataFrame) -> DataFrame:
    """All features from stored frame rows and stored seasonal cells."""
    placed = with_calendar(frames).join(merged_cells(cells), SEASON, "left")
    return _in_order(placed)
