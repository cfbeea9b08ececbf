import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from almanac.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW = """timestamp string, city_id int, city_name string, lat double, lon double, temperature string,
    humidity double, pressure double, wind_speed double, rain string, weather_condition string,
    source string, ingested_at string, seq long"""


@pytest.fixture(scope="session")
def raw_rows(spark):
    """Raw observations from partial dictionaries."""

    def make(*rows):
        base = {
            "timestamp": "2025-01-01T00:00",
            "city_id": 1,
            "city_name": "A",
            "lat": 10.0,
            "lon": 105.0,
            "temperature": "25.0",
            "humidity": 50.0,
            "pressure": 1000.0,
            "wind_speed": 2.0,
            "rain": "0.0",
            "weather_condition": None,
            "source": "open_meteo",
            "ingested_at": "2025-02-01T00:00:00+00:00",
            "seq": 0,
        }
        return spark.createDataFrame([tuple((base | r).values()) for r in rows], RAW)

    return make
