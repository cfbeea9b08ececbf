import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from rows import hourly

from almanac.operators import series
from almanac.operators.frames import Lag, Rolling, with_frames
from almanac.operators.series import profile_series
from almanac.plans import features, marts
from almanac.plans.silver import clean
from almanac.schemas import MODEL_FEATURES
from almanac.session import materialise

SPECS = [Rolling(f"{fn}_{rows}", "x", fn, rows) for fn in ("avg", "sum", "var", "std", "min", "max") for rows in (24, 168, 37)]
LAGS = [Lag("lag_1", "x", 1), Lag("lag_2", "x", 2)]


def expected(pdf):
    """The same frames by pandas."""
    parts = []
    for _, g in pdf.sort_values("t").groupby("k"):
        g = g.copy()
        for s in SPECS:
            window = g["x"].rolling(s.rows, min_periods=1)
            g[s.name] = {"avg": window.mean, "sum": window.sum, "var": window.var, "std": window.std, "min": window.min, "max": window.max}[s.fn]()
        for lag in LAGS:
            g[lag.name] = g["x"].shift(lag.back)
        parts.append(g)
    return pd.concat(parts).sort_values(["k", "t"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def readings(spark):
    """One long series, one medium, one of a single row; gaps in time and missing values."""
    rng = np.random.default_rng(7)
    sizes = {1: 3000, 2: 400, 3: 1, 4: 170}
    rows = []
    for k, n in sizes.items():
        t = np.cumsum(rng.integers(1, 400, n))
        x = rng.normal(20, 5, n).round(3)
        for at, value, gone in zip(t, x, rng.random(n) < 0.1, strict=True):
            rows.append((k, int(at), None if gone else float(value)))
    df = spark.createDataFrame(rows, "k int, t long, x double")
    df = df.withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    return materialise(df, "readings")


def compare(framed, pdf):
    got = framed.toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    want = expected(pdf)
    assert len(got) == len(want)
    for s in [*SPECS, *LAGS]:
        pd.testing.assert_series_equal(got[s.name], want[s.name], rtol=1e-8, atol=1e-7, check_names=False)


def test_frames_match_pandas(readings):
    compare(with_frames(readings, ["k"], "ts", SPECS, LAGS), readings.toPandas())


@pytest.mark.parametrize("piece_rows", [168, 250, 1000, 2999])
def test_split_series_give_the_same_frames(readings, piece_rows):
    profile = profile_series(readings, ["k"], piece_rows)
    assert profile.has_long_series
    compare(with_frames(readings, ["k"], "ts", SPECS, LAGS, profile), readings.toPandas())


def test_pieces_are_balanced_and_copies_bounded(readings):
    profile = profile_series(readings, ["k"], 300)
    split = series.split_long_series(readings, ["k"], "ts", 167, profile)
    per = split.groupBy("k", series.PIECE).agg(
        F.count_if(~F.col(series.COPY)).alias("own"), F.count_if(F.col(series.COPY)).alias("copies")
    ).collect()
    long = [r for r in per if r.k == 1]
    assert len(long) >= 8 and max(r.own for r in long) <= 600
    assert all(r.copies in (0, 167) for r in per)
    assert sum(r.own for r in per) == readings.count()


def test_cuts_survive_a_burst(spark):
    """Nearly all rows of the series fall into one second."""
    rows = [(1, i) for i in range(2000)] + [(1, 10_000_000_000 + i * 1_000_000) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, micros long").selectExpr(
        "k", "micros AS t", "double(micros % 17) AS x", "cast(timestamp_micros(micros) AS timestamp_ntz) AS ts"
    )
    df = materialise(df, "burst")
    profile = profile_series(df, ["k"], 200)
    split = series.split_long_series(df, ["k"], "ts", 167, profile)
    assert split.select(series.PIECE).distinct().count() >= 8
    compare(with_frames(df, ["k"], "ts", SPECS, LAGS, profile), df.toPandas())


def test_nan_stays_in_its_frames(spark):
    rows = [(1, i, float("nan") if i == 10 else 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, t int, x double")
    specs = [Rolling("a", "x", "avg", 168), Rolling("s", "x", "std", 168)]
    got = with_frames(df, ["k"], "t", specs, profile=profile_series(df, ["k"])).orderBy("t").collect()
    bad = [r.t for r in got if r.a is not None and math.isnan(r.a)]
    assert bad == list(range(10, 178))
    assert got[200].a == 1.0 and got[200].s == 0.0


def test_feature_store_shape(raw_rows):
    df = features.feature_store(clean(raw_rows(*hourly(3)), ["seq"]))
    assert len(df.columns) == 69
    assert df.columns[:14] == features.BASE
    assert set(MODEL_FEATURES) <= set(df.columns) and len(MODEL_FEATURES) == 50
    types = dict(df.dtypes)
    assert types["hour_of_day"] == types["month"] == types["day_of_week"] == "bigint"
    assert types["is_weekend"] == "int"


def test_single_row_series(raw_rows):
    row = features.feature_store(clean(raw_rows({}))).first()
    assert row.rolling_avg_temp_24h == 25.0 and row.rolling_sum_rain_24h == 0.0
    for name in ("rolling_std_temp_24h", "rolling_var_temp_24h", "temp_lag_1h", "temp_delta_1h"):
        assert row[name] is None
    assert row.temp_city_month_hour_zscore is None and row.city_month_hour_avg_temp == 25.0
    assert row.dew_point_c == 15.0


def test_constant_series_has_no_score(raw_rows):
    rows = features.feature_store(clean(raw_rows(*hourly(24 * 5)))).collect()
    assert all(r.temp_city_month_hour_zscore is None for r in rows)
    assert {r.rolling_std_temp_7d for r in rows} == {None, 0.0}


def test_frames_count_rows_not_hours(raw_rows):
    kept = [r for i, r in enumerate(hourly(200, temperature=lambda i: str(i % 40))) if i % 3]
    rows = features.feature_store(clean(raw_rows(*kept))).orderBy("timestamp_utc").collect()
    values = [r.temperature_c for r in rows]
    assert rows[60].rolling_avg_temp_24h == pytest.approx(sum(values[37:61]) / 24)
    assert rows[60].temp_lag_2h == values[58]


def test_calendar(raw_rows):
    df = features.with_calendar(
        clean(raw_rows({"timestamp": "2025-01-05T06:00"}, {"timestamp": "2025-01-04T18:00"}, {"timestamp": "2025-01-06T00:00"}))
    ).orderBy("timestamp_utc")
    sat, sun, mon = df.collect()
    assert [(r.day_of_week, r.is_weekend) for r in (sat, sun, mon)] == [(6, 1), (0, 1), (1, 0)]
    assert sun.hour_sin == pytest.approx(1.0) and sat.hour_sin == pytest.approx(-1.0) and mon.hour_cos == 1.0
    assert sun.month_sin == pytest.approx(0.5)


def test_unused_features_are_pruned(raw_rows):
    store = features.feature_store(clean(raw_rows({})), series.SeriesProfile(1, 1, 1, 100))
    plan = store.select("city_id", "temp_lag_1h")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "var_pop" not in plan and "lag(" in plan


def test_event_thresholds(raw_rows):
    rows = hourly(
        12,
        temperature=lambda i: {4: "30.0", 9: "30.1"}.get(i, "25.0"),
        rain=lambda i: {2: "50.0", 3: "49.9"}.get(i, "0"),
        city_id=1,
    )
    day = marts.extreme_events_daily(features.feature_store(clean(raw_rows(*rows)))).collect()
    assert len(day) == 1
    assert (day[0].sudden_temp_jump_count, day[0].heavy_rain_count, day[0].extreme_event_count) == (1, 1, 2)
    assert day[0].total_rain_mm == pytest.approx(99.9)


def test_wind_must_exceed_three_times_the_week(spark):
    columns = "city_id int, city_name string, lat double, lon double, observed_date date, temperature_c double, temp_lag_2h double, wind_speed_ms double, rolling_avg_wind_7d double, rain_mm double"
    import datetime

    base = (1, "A", 0.0, 0.0, datetime.date(2025, 1, 1), 20.0, None)
    df = spark.createDataFrame([(*base, 6.0, 2.0, 0.0), (*base, 6.1, 2.0, 0.0)], columns)
    assert marts.extreme_events_daily(df).first().high_wind_count == 1


def test_monthly_delta_counts_rows(spark):
    months = [f"2024-{m:02d}" for m in range(1, 13) if m != 5] + ["2025-01", "2025-02"]
    rows = [(1, f"{m}-03 00:00:00", float(i)) for i, m in enumerate(months)]
    df = spark.createDataFrame(rows, "k int, t string, x double").selectExpr("k", "cast(t AS timestamp_ntz) AS t", "x")
    out = marts.period_delta(df, ["k"], ["k"], "t", "month", "m", {"a": ("x", "d")}, {"s": "x"})
    got = {str(r.m)[:7]: r.d for r in out.collect()}
    assert got["2025-01"] is None  # only eleven rows before it
    assert got["2025-02"] == 12.0  # against 2024-01, thirteen months back


def test_merged_cells_equal_one_pass(spark, raw_rows):
    """Seasonal figures from cells of several years, with missing values, single rows and large offsets."""
    rows = []
    for year in (2021, 2023, 2024):
        for day in (1, 2, 3):
            for hour in range(0, 24, 5):
                at = f"{year}-0{1 + day % 2}-0{day}T{hour:02d}:00"
                pressure = None if hour == 10 else 1e8 + year + day * 0.1
                rows.append({"timestamp": at, "city_id": 1 + day % 2, "temperature": str(year % 7 + hour * 0.3), "pressure": pressure})
    silver = clean(raw_rows(*[r | {"ingested_at": "2026-01-01T00:00:00"} for r in rows]))
    want = features.feature_store(silver)
    got = features.features_of(features.frame_rows(silver), features.seasonal_cells(silver))
    assert got.columns == want.columns

    def plain(df):
        return {(r.city_id, r.timestamp_utc): r.asDict() for r in df.collect()}

    a, b = plain(got), plain(want)
    assert a.keys() == b.keys() and len(a) == len(rows)
    for key, row in a.items():
        for name, value in row.items():
            other = b[key][name]
            assert value == other or value == pytest.approx(other, rel=1e-6, abs=1e-6), (key, name)
