"""Schemas and fixed column lists of the weather models."""

from __future__ import annotations

from pyspark.sql import types as T

REGISTRY_REQUIRED = ["city_id", "city_name", "lat", "lon"]

REGISTRY = T.StructType(
    [
        T.StructField("city_id", T.IntegerType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("is_economic_center", T.BooleanType()),
    ]
)

# Parsed observation, as both collectors deliver it.
OBSERVATION = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("city_id", T.IntegerType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("rain", T.DoubleType()),
        T.StructField("weather_condition", T.StringType()),
    ]
)

LINEAGE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("ingestion_year", T.IntegerType()),
        T.StructField("ingestion_month", T.IntegerType()),
        T.StructField("ingestion_day", T.IntegerType()),
    ]
)

BRONZE = T.StructType(OBSERVATION.fields + LINEAGE.fields)

# Path keys of the lake, kept as text so that the zero padding survives.
BRONZE_PARTITIONS = ["source", "year", "month", "day"]

HISTORY_ARRAYS = {
    "temperature": "temperature_2m",
    "humidity": "relative_humidity_2m",
    "pressure": "pressure_msl",
    "wind_speed": "wind_speed_10m",
    "rain": "rain",
}

HISTORY_PAYLOAD = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(a, T.ArrayType(T.DoubleType())) for a in HISTORY_ARRAYS.values()]
            ),
        )
    ]
)

CURRENT_PAYLOAD = T.StructType(
    [
        T.StructField("dt", T.LongType()),
        T.StructField(
            "main",
            T.StructType([T.StructField(n, T.DoubleType()) for n in ("temp", "humidity", "pressure")]),
        ),
        T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
        T.StructField("rain", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField(
            "weather", T.ArrayType(T.StructType([T.StructField("main", T.StringType())]))
        ),
    ]
)

# The model's input columns, in training order.
MODEL_FEATURES = [
    "temperature_c",
    "humidity_pct",
    "pressure_hpa",
    "wind_speed_ms",
    "rain_mm",
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
    "temp_delta_1h",
    "temp_delta_2h",
    "humidity_delta_1h",
    "pressure_delta_1h",
    "wind_delta_1h",
    "temp_vs_24h_avg",
    "temp_vs_7d_avg",
    "humidity_vs_24h_avg",
    "pressure_vs_24h_avg",
    "wind_vs_7d_avg",
    "temp_range_24h",
    "dew_point_c",
    "temp_vs_city_month_hour_avg",
    "temp_city_month_hour_zscore",
    "humidity_city_month_hour_zscore",
    "pressure_city_month_hour_zscore",
    "wind_city_month_hour_zscore",
    "rain_city_month_hour_zscore",
    "hour_of_day",
    "day_of_week",
    "month",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
    "is_weekend",
]
