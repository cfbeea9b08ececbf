import json
from datetime import UTC, date, datetime, timedelta, timezone
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pyspark.sql import functions as F

from almanac.plans.silver import clean
from almanac.schemas import BRONZE, OBSERVATION
from almanac.sources import bronze, payloads
from almanac.sources.registry import read_registry

NOON = datetime(2025, 1, 2, 12, tzinfo=UTC)


@pytest.fixture
def cities(spark, tmp_path):
    file = tmp_path / "cities.csv"
    file.write_text(
        "city_id,city_name,lat,lon,is_economic_center,note\n"
        "24,Ha Noi,21.0278,105.8342,true,x\n1,An Giang,10.3864,105.4352,false,\n"
    )
    return read_registry(spark, str(file))


def test_registry(cities):
    assert dict(cities.dtypes) == {
        "city_id": "int",
        "city_name": "string",
        "lat": "double",
        "lon": "double",
        "is_economic_center": "boolean",
        "note": "string",
    }
    assert cities.filter("city_id = 24").first().lat == 21.0278


def test_registry_needs_its_columns(spark, tmp_path):
    file = tmp_path / "cities.csv"
    file.write_text("city_id,city_name,lon\n1,A,105\n")
    with pytest.raises(ValueError, match=r"\['lat'\]"):
        read_registry(spark, str(file))


def history(spark, *responses, fetched=datetime(2025, 1, 1, 2, 30)):
    rows = [(c, fetched, r if isinstance(r, str) else json.dumps(r)) for c, r in responses]
    return spark.createDataFrame(rows, "city_id int, fetched_at timestamp_ntz, payload string")


HOURS = ["2025-01-01T00:00", "2025-01-01T01:00", "2025-01-01T02:00", "2025-01-01T03:00"]


def test_history_by_position(spark, cities):
    response = {"hourly": {"time": HOURS, "temperature_2m": [1, None, 3.5, 4], "rain": [0, 0, 1, 2, 9]}}
    rows = payloads.parse_history(history(spark, (1, response)), cities).orderBy("timestamp").collect()
    assert [r.timestamp for r in rows] == HOURS[:3]  # the last hour lies after the fetch
    assert [r.temperature for r in rows] == [1.0, None, 3.5]
    assert [r.rain for r in rows] == [0.0, 0.0, 1.0]
    assert {(r.city_name, r.lat, r.pressure, r.weather_condition) for r in rows} == {("An Giang", 10.3864, None, None)}


@pytest.mark.parametrize(
    ("response", "usable"),
    [
        ({"hourly": {"time": HOURS}}, True),
        ({"hourly": {}}, True),
        ({}, True),
        ({"hourly": {"time": HOURS, "rain": []}}, False),
        ({"hourly": {"time": [*HOURS, "2999-01-01T00:00"], "rain": [1] * len(HOURS)}}, True),
        ({"hourly": {"time": ["soon"]}}, False),
        ("{broken", False),
    ],
)
def test_usable_responses(spark, cities, response, usable):
    table = history(spark, (1, response), (24, {"hourly": {"time": HOURS}}))
    parsed = payloads.read_history(table).filter("city_id = 1").first()
    assert parsed.usable is usable
    if usable:
        payloads.require_complete(cities, table)
    else:
        with pytest.raises(Exception, match="unusable history response of station 1"):
            payloads.parse_history(table, cities).collect()
        with pytest.raises(RuntimeError, match="stations: An Giang$"):
            payloads.require_complete(cities, table)
    aside = payloads.unusable_history(table)
    assert aside.columns == table.columns and aside.count() == (0 if usable else 1)
    rest = payloads.parse_history(payloads.usable_history(table), cities)
    assert {r.city_id for r in rest.collect()} >= {24} and rest.filter("city_id = 1").isEmpty() is (not usable or "time" not in str(response))


def test_missing_station_fails_the_batch(spark, cities):
    with pytest.raises(RuntimeError, match="Ha Noi"):
        payloads.require_complete(cities, history(spark, (1, {})))


def test_current(spark, cities):
    full = {
        "dt": 1735776785,
        "main": {"temp": 20, "humidity": 80.5, "pressure": 1010},
        "wind": {"speed": 2.5},
        "rain": {"1h": 0.7},
        "weather": [{"main": "Rain"}, {"main": "Fog"}],
    }
    bare = {"dt": 1735776785, "main": {}, "rain": {"3h": 4}}
    rows = [(24, json.dumps(full)), (1, json.dumps(bare))]
    for broken in ('{"main": {}}', '{"dt": 1}', "{no json", None):
        spoilt = spark.createDataFrame([*rows, (1, broken)], "city_id int, payload string")
        with pytest.raises(RuntimeError, match="stations: An Giang$"):
            payloads.require_complete(cities, spoilt, payloads.failed_current)
        with pytest.raises(Exception, match="unusable current response of station 1"):
            payloads.parse_current(spoilt, cities).collect()
    table = spark.createDataFrame(rows, "city_id int, payload string")
    by_city = {r.city_id: r for r in payloads.parse_current(table, cities).collect()}
    assert by_city[24].asDict() == {
        "timestamp": "2025-01-02T00:13:05+00:00",
        "city_id": 24,
        "city_name": "Ha Noi",
        "lat": 21.0278,
        "lon": 105.8342,
        "temperature": 20.0,
        "humidity": 80.5,
        "pressure": 1010.0,
        "wind_speed": 2.5,
        "rain": 0.7,
        "weather_condition": "Rain",
    }
    assert (by_city[1].rain, by_city[1].wind_speed, by_city[1].weather_condition) == (0.0, None, None)
    assert str(clean(payloads.parse_current(table, cities).selectExpr("*", "'s' AS source", "NULL AS ingested_at")).first().timestamp_utc) == "2025-01-02 00:13:05"


def test_within_dates(spark, cities):
    response = {"hourly": {"time": ["2025-01-01T23:00", "2025-01-02T00:00", "2025-01-03T23:00", "2025-01-04T00:00"]}}
    rows = payloads.parse_history(history(spark, (1, response), fetched=datetime(2026, 1, 1)), cities)
    assert payloads.within_dates(rows, date(2025, 1, 2), date(2025, 1, 3)).count() == 2


def observations(spark, n=3):
    rows = [(f"2025-01-01T0{i}:00", i, "A", 1.0, 2.0, 20.0, 50.0, 1000.0, 2.0, 0.0, None) for i in range(n)]
    return spark.createDataFrame(rows, OBSERVATION)


def test_lake_layout_and_lineage(spark, tmp_path):
    root = str(tmp_path)
    bronze.write_bronze(observations(spark), root, "open_meteo", NOON, files=1)
    later = NOON.astimezone(timezone(timedelta(hours=7))) + timedelta(days=1)
    bronze.write_bronze(observations(spark, 1), root, "openweather", later)
    folder = tmp_path / "bronze/weather/source=open_meteo/year=2025/month=01/day=02"
    assert len(list(folder.glob("*.parquet"))) == 1
    lake = bronze.read_bronze(spark, root)
    assert lake.columns == [f.name for f in BRONZE.fields] + ["year", "month", "day"]
    got = {(r.source, r.ingested_at, r.ingestion_day, r.month, r.day) for r in lake.collect()}
    assert got == {
        ("open_meteo", "2025-01-02T12:00:00+00:00", 2, "01", "02"),
        ("openweather", "2025-01-03T12:00:00+00:00", 3, "01", "03"),
    }
    uniform = bronze.read_bronze_uniform(spark, root)
    assert sorted(map(str, uniform.collect())) == sorted(map(str, lake.collect()))


def test_empty_batch_writes_nothing(spark, tmp_path):
    assert bronze.write_bronze(observations(spark, 0), str(tmp_path), "open_meteo", NOON) is None
    assert not list(Path(tmp_path).iterdir())


def test_lake_refuses_broken_ids(spark, tmp_path):
    folder = tmp_path / "bronze/weather/source=s/year=2025/month=01/day=02"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"timestamp": ["2025-01-01T00:00"], "city_id": ["x7"], "lat": ["1.5"]}), folder / "a.parquet")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bronze.read_bronze(spark, str(tmp_path)).collect()


def test_lake_of_disagreeing_files(spark, tmp_path):
    """Whole numbers and an all-empty column here, doubles and text there; also within one folder."""
    same = tmp_path / "bronze/weather/source=open_meteo/year=2025/month=01/day=02"
    other = tmp_path / "bronze/weather/source=openweather/year=2025/month=01/day=03"
    same.mkdir(parents=True)
    other.mkdir(parents=True)
    base = {"timestamp": ["2025-01-01T00:00"], "city_id": [1], "city_name": ["A"], "lat": [1.0], "lon": [2.0]}
    pq.write_table(
        pa.table(base | {"humidity": pa.array([50], pa.int64()), "weather_condition": pa.nulls(1)}), same / "a.parquet"
    )
    pq.write_table(pa.table(base | {"humidity": [51.5], "weather_condition": ["Rain"], "extra": [1]}), same / "b.parquet")
    pq.write_table(pa.table(base | {"humidity": [52.5], "weather_condition": ["Fog"], "ingested_at": ["x"]}), other / "c.parquet")
    rows = bronze.read_bronze(spark, str(tmp_path)).orderBy("humidity").collect()
    assert [(r.humidity, r.weather_condition, r.source, r.day, r.ingested_at) for r in rows] == [
        (50.0, None, "open_meteo", "02", None),
        (51.5, "Rain", "open_meteo", "02", None),
        (52.5, "Fog", "openweather", "03", "x"),
    ]
    assert clean(bronze.read_bronze(spark, str(tmp_path))).count() == 1


def test_lake_on_another_file_system(spark, tmp_path):
    """A mount that only the session's file system knows: footers and rows come through it, agreeing files or not."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.lakes.link./lake", f"file://{tmp_path}")
    root = "viewfs://lakes/lake"
    bronze.write_bronze(observations(spark), root, "open_meteo", NOON)
    assert bronze.read_bronze(spark, root).count() == 3
    other = observations(spark, 2).withColumns({"city_id": F.lit(7), "humidity": F.lit(5).cast("long")}).withColumn("extra", F.lit(1))
    other.write.parquet(f"{root}/{bronze.FOLDER}/source=own/year=2025/month=01/day=03")
    rows = bronze.read_bronze(spark, root)
    assert rows.columns == [f.name for f in BRONZE.fields] + ["year", "month", "day"]
    assert sorted((r.source, r.humidity, r.day) for r in rows.collect()) == [("open_meteo", 50.0, "02")] * 3 + [("own", 5.0, "03")] * 2
    files = rows.inputFiles()
    assert bronze.read_files(spark, root, list(files)).count() == 5
