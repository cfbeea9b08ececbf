"""Raw observations to one typed, flagged row per station and time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.functions.temporal import truncated
from almanac.operators.latest import latest_wins
from almanac.operators.validity import WEATHER_RULES, with_flags

KEYS = ["city_id", "timestamp_utc"]

# The columns of the silver table, in order.
COLUMNS = [
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
    "ingested_at_utc",
    "invalid_temperature",
    "invalid_humidity",
    "invalid_rain",
    "invalid_wind_speed",
    "is_quality_anomaly",
]


def typed(raw: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Hard casts for the dimension columns, tolerant ones for times and measures."""
    return raw.selectExpr(
        "int(city_id) AS city_id",
        "string(city_name) AS city_name",
        "double(lat) AS lat",
        "double(lon) AS lon",
        "try_cast(timestamp AS timestamp_ntz) AS timestamp_utc",
        "try_cast(temperature AS double) AS temperature_c",
        "try_cast(humidity AS double) AS humidity_pct",
        "try_cast(pressure AS double) AS pressure_hpa",
        "try_cast(wind_speed AS double) AS wind_speed_ms",
        "coalesce(try_cast(rain AS double), 0D) AS rain_mm",
        "string(weather_condition) AS weather_condition",
        "string(source) AS source",
        "try_cast(ingested_at AS timestamp_ntz) AS ingested_at_utc",
        *extra,
    )


def plausible_times(df: DataFrame) -> DataFrame:
    """Rows with a key and a time no later than their ingestion, where that is known.

    A missing time fails the comparison with itself, too.
    """
    return df.filter("city_id IS NOT NULL AND timestamp_utc <= coalesce(ingested_at_utc, timestamp_utc)")


# Settles equal ingestion times where the input has no sequence number: any total order will do.
CONTENT = [
    "source",
    "weather_condition",
    "temperature_c",
    "humidity_pct",
    "pressure_hpa",
    "wind_speed_ms",
    "rain_mm",
    "city_name",
    "lat",
    "lon",
]


def newest(rows: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The latest ingested row per key. Choosing among winners gives the same row as choosing among all."""
    order = [F.col("ingested_at_utc").desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in (*tiebreak, *([] if tiebreak else CONTENT))]
    return latest_wins(rows, KEYS, order)


def clean(
    raw: DataFrame, tiebreak: Sequence[str] = (), rules=WEATHER_RULES, keep: Sequence[str] = ()
) -> DataFrame:
    """Silver table: latest ingested row per (city_id, timestamp_utc), 20 columns, and the raw columns in ``keep``.

    ``tiebreak`` names raw columns (an ingestion sequence, say), the largest value first.
    """
    latest = newest(plausible_times(typed(raw, tiebreak)), tiebreak)
    dated = latest.withColumns(
        {
            "observed_hour_utc": truncated("hour", F.col("timestamp_utc")),
            "observed_date": F.to_date("timestamp_utc"),
        }
    )
    return with_flags(dated, rules).select(*COLUMNS, *keep)
