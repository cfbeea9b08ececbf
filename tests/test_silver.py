import pytest

from almanac.operators import checks
from almanac.operators.validity import valid_only
from almanac.plans.silver import COLUMNS, clean


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_columns_and_types(raw_rows):
    silver = clean(raw_rows({}))
    assert silver.columns == COLUMNS
    types = dict(silver.dtypes)
    assert types["timestamp_utc"] == types["observed_hour_utc"] == types["ingested_at_utc"] == "timestamp_ntz"
    assert (types["city_id"], types["observed_date"], types["is_quality_anomaly"]) == ("int", "date", "boolean")


def test_flags_are_three_valued(raw_rows):
    rows = raw_rows(
        {"city_id": 1, "temperature": None},
        {"city_id": 2, "humidity": None},
        {"city_id": 3, "wind_speed": None},
        {"city_id": 4, "pressure": None},
        {"city_id": 5, "temperature": None, "humidity": 101.0},
    )
    flags = {r.city_id: r.is_quality_anomaly for r in clean(rows).collect()}
    assert flags == {1: None, 2: None, 3: None, 4: False, 5: True}
    assert [r.city_id for r in valid_only(clean(rows)).collect()] == [4]


def test_unreadable_numbers(raw_rows):
    row = only(clean(raw_rows({"temperature": "bad", "rain": "bad"})))
    assert row.temperature_c is None and row.rain_mm == 0.0


@pytest.mark.parametrize(
    ("column", "value", "flag"),
    [
        ("temperature", "-10", False),
        ("temperature", "60", False),
        ("temperature", "60.1", True),
        ("temperature", "-10.1", True),
        ("humidity", 0.0, False),
        ("humidity", 100.0, False),
        ("humidity", float("nan"), True),
        ("rain", "1000", False),
        ("rain", "-0.1", True),
        ("wind_speed", 80.0, False),
        ("wind_speed", 80.5, True),
        ("pressure", float("nan"), False),
    ],
)
def test_bounds(raw_rows, column, value, flag):
    assert only(clean(raw_rows({column: value}))).is_quality_anomaly is flag


def test_latest_ingested_wins_and_unknown_comes_last(raw_rows):
    rows = raw_rows(
        {"ingested_at": "2025-02-01T00:00:00+00:00", "temperature": "1"},
        {"ingested_at": "2025-02-02T00:00:00+00:00", "temperature": "2"},
        {"ingested_at": None, "temperature": "3", "seq": 9},
    )
    assert only(clean(rows, ["seq"])).temperature_c == 2.0
    rows = raw_rows(
        {"ingested_at": None, "temperature": "1", "seq": 1}, {"ingested_at": None, "temperature": "2", "seq": 2}
    )
    assert only(clean(rows, ["seq"])).temperature_c == 2.0


def test_ties_do_not_depend_on_partitioning(raw_rows):
    rows = raw_rows(*[{"temperature": str(t), "humidity": float(t % 7)} for t in range(30)])
    picked = {tuple(clean(rows.repartition(n)).first()) for n in (1, 3, 8)}
    assert len(picked) == 1


def test_keys_and_future_rows(raw_rows):
    rows = raw_rows(
        {"city_id": None},
        {"timestamp": "bad"},
        {"timestamp": None},
        {"timestamp": "2025-03-01T00:00", "city_id": 2},
        {"timestamp": "2025-03-01T00:00", "city_id": 3, "ingested_at": "bad"},
        {"timestamp": "2025-03-01T00:00", "city_id": 4, "ingested_at": None},
    )
    assert sorted(r.city_id for r in clean(rows).collect()) == [3, 4]


def test_dedup_limits_before_the_shuffle(raw_rows):
    plan = clean(raw_rows({}))._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_checks(raw_rows):
    rows = raw_rows({}, {}, {"city_id": None})
    with pytest.raises(ValueError, match="city_id"):
        checks.check_not_null(rows, ["city_id", "timestamp"])
    with pytest.raises(ValueError, match="not unique"):
        checks.check_unique(rows, ["city_id", "timestamp"])
    silver = clean(rows)
    checks.check_not_null(silver, ["city_id", "timestamp_utc"])
    checks.check_unique(silver, ["city_id", "timestamp_utc"])
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        checks.require_columns(rows, ["y", "x", "city_id"])
