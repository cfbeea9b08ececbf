from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import hourly

from almanac.plans import models, reports
from almanac.plans.features import feature_store, frame_rows
from almanac.plans.silver import clean
from almanac.sources.tables import Transaction


@pytest.fixture(scope="module")
def obs(raw_rows):
    rows = hourly(72, temperature=lambda i: str(20 + i % 5), rain="0.5", city_id=1, city_name="A")
    rows += hourly(48, temperature="30", city_id=2, city_name="B", source="openweather", wind_speed=3.0)
    rows += hourly(1, city_id=3, city_name=None)
    return reports.observations(feature_store(clean(raw_rows(*rows))))


ALL = reports.Selection(date(2025, 1, 1), date(2025, 1, 31))


def test_local_date(obs):
    days = {str(r.timestamp_utc): str(r.observed_date_ict) for r in reports.of_city(obs, "A").collect()}
    assert days["2025-01-01 16:00:00"] == "2025-01-01"
    assert days["2025-01-01 17:00:00"] == "2025-01-02"


def test_swapped_dates_and_sources(obs):
    turned = reports.Selection(date(2025, 1, 31), date(2025, 1, 1))
    assert reports.selected(obs, turned).count() == obs.count() == 121
    assert reports.selected(obs, reports.Selection(ALL.start, ALL.end, [])).isEmpty()
    assert reports.selected(obs, reports.Selection(ALL.start, ALL.end, ["openweather"])).count() == 48


def test_trailing_day_has_both_ends(obs):
    assert reports.trailing_hours(reports.of_city(obs, "A")).count() == 25


def test_bounds(obs):
    row = reports.date_bounds(obs, days=1).first()
    assert (row.min_date, row.max_date, row.default_start) == (date(2025, 1, 1), date(2025, 1, 4), date(2025, 1, 3))
    assert row.row_count == 121


def test_selectors_skip_nulls(obs):
    assert [r.city_name for r in reports.selector_values(obs, "city_name").collect()] == ["A", "B"]


def test_change_of_last_two_known_values(obs):
    city = reports.of_city(obs, "A")
    row = reports.latest_change(city, "temperature_c").first()
    assert (row.delta, row.label) == (1.0, "1.0 vs prev")
    last = F.col("timestamp_utc") >= F.lit("2025-01-03 23:00:00").cast("timestamp_ntz")
    holes = city.withColumn("temperature_c", F.when(~last, F.col("temperature_c")))
    assert reports.latest_change(holes, "temperature_c").first().delta == 20.0 - 24.0  # hours 70 and 69
    assert reports.latest_change(city.limit(1), "temperature_c").first().label is None


def test_kpis_of_nothing(obs):
    row = reports.city_kpis(reports.of_city(obs, "nowhere")).first()
    assert (row.rain_in_range_mm, row.latest_temp, row.rain_in_range) == (0.0, "-", "0.0 mm")


def test_summary_and_rankings(obs):
    days = reports.daily_summary(reports.of_city(obs, "A")).collect()
    assert [r.rain_mm for r in days] == [8.5, 12.0, 12.0, 3.5]
    assert [r.city_name for r in reports.top_cities(obs, "avg_temp_c").collect()] == ["B", "A"]
    assert [r.city_name for r in reports.top_cities(obs, "total_rain_mm", 1).collect()] == ["A"]


def test_compare(obs):
    table = reports.compare_cities(obs, ["B", "A"])
    assert table.columns == ["observed_date_ict", "A", "B"]
    assert [r.B for r in table.collect()] == [30.0, 30.0, 30.0, None]
    with pytest.raises(ValueError, match="At most 8"):
        reports.compare_cities(obs, list("abcdefghi"))


def test_latest_by_city(obs):
    rows = reports.latest_readings(obs).collect()
    assert [(r.city_name, str(r.timestamp_ict)) for r in rows] == [
        ("B", "2025-01-03 06:00:00"),
        ("A", "2025-01-04 06:00:00"),
    ]
    assert reports.map_points(obs).columns == ["latitude", "longitude", "temperature_c"]


def test_top_k_takes_ordered(obs):
    plan = reports.top_cities(obs, "peak_wind_ms")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_newest_months_of_a_stored_table(spark, raw_rows, tmp_path):
    """The last day and change of a city from its newest months only; another city goes on for longer."""
    late = {"ingested_at": "2027-01-01T00:00:00+00:00"}
    rows = [r for m in range(1, 9) for r in hourly(30, start=28 * 24 * (m - 1), city_id=2, city_name="B", **late)]
    rows += [r for m in range(1, 6) for r in hourly(40, start=28 * 24 * m - 20, temperature=lambda i: str(i % 7), **late)]
    clean_rows = clean(raw_rows(*rows))
    change = Transaction(spark, str(tmp_path))
    change.write(frame_rows(clean_rows), models.FRAMES, *models.stored_under(models.FRAMES))
    state, period = change.commit(), reports.Selection(date(2025, 1, 1), date(2025, 12, 31))
    for city in ("A", "B", "nowhere"):
        stored = reports.StoredCity(state, city, period)
        obs = reports.of_city(reports.selected(reports.observations(feature_store(clean_rows)), period), city)
        got, want = stored.trailing_hours(), reports.trailing_hours(obs)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
        assert stored.latest_change("temperature_c").collect() == reports.latest_change(obs, "temperature_c").collect()
    months = lambda df: sorted({f.split("stored_month=")[1][:7] for f in df.inputFiles()})
    of_a = reports.StoredCity(state, "A", period)
    assert of_a.newest_months(1) == ["2025-06", "2025-07", "2025-08"] and months(of_a.trailing_hours()) == ["2025-05", "2025-06"]
    assert months(reports.StoredCity(state, "B", period).trailing_hours()) == ["2025-08"]
    assert "Window" not in of_a.trailing_hours()._jdf.queryExecution().executedPlan().toString()
