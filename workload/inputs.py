"""Weather-like inputs derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.functions.temporal import truncated
from almanac.operators.latest import latest_wins
from almanac.operators.series import profile_series
from almanac.plans import features, marts, silver
from almanac.session import materialise

STATION_USERS = 15  # users per station: the number of stations grows with the data


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quarter(value: Column) -> Column:
    return F.floor(value).cast("double") * F.lit(0.25)


SPREAD_USERS, SPREAD_MONTHS = 5, 15  # for more stations, over more than a year


def raw_observations(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Bronze-like rows from ``events``: bad numbers, missing keys, copies, late and early arrivals.

    ``spread`` deals them over more stations and months.
    """
    users = SPREAD_USERS if spread else STATION_USERS
    events = table(spark, sf_dir, "events")
    if spread:
        events = events.withColumn("ts", F.expr(f"ts + make_ym_interval(0, int(event_id % {SPREAD_MONTHS}))"))
    events = events.selectExpr(
        "*",
        f"int(user_id div {users}) AS station",
        "int(get_json_object(props, '$.k')) AS k",
        "double(floor(value)) AS whole",
    )
    return events.selectExpr(
        "CASE WHEN event_id % 89 = 0 THEN 'bad' ELSE date_format(ts, \"yyyy-MM-dd'T'HH:00\") END AS timestamp",
        "CASE WHEN event_id % 97 <> 0 THEN station + 1 END AS city_id",
        "concat('CITY_', station + 1) AS city_name",
        "8D + (station % 10) * 0.5D AS lat",
        "102D + (station % 10) * 0.25D AS lon",
        "CASE WHEN event_id % 29 = 0 THEN 'bad' ELSE string(k * 0.75D - 12D) END AS temperature",
        "CASE WHEN event_id % 13 <> 0 THEN event_id % 107 - 2 END AS humidity",
        "990 + event_id % 41 AS pressure",
        "whole * 0.25D AS wind_speed",
        """CASE WHEN k % 5 = 0 THEN whole * 3D WHEN k % 5 = 1 THEN NULL
                WHEN k % 5 = 2 AND value < 5D THEN -1D ELSE 0D END AS rain""",
        "event_type AS weather_condition",
        "CASE WHEN event_type = 'error' THEN 'openweather' ELSE 'open_meteo' END AS source",
        """CASE WHEN event_id % 31 = 0 THEN NULL
                WHEN event_id % 101 = 0 THEN ts - interval 2 hours ELSE ts END AS ingested_at""",
        "event_id AS ingest_seq",
    )


def edge_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows whose times lie at the far end, with and without a known ingestion, or exactly at their ingestion."""
    far = F.expr("event_key % 40 = 0")
    rows = raw_observations(spark, sf_dir).withColumn("event_key", F.col("ingest_seq"))
    return rows.withColumns(
        {
            "timestamp": F.when(far, F.lit("9999-12-31T12:00")).otherwise(F.col("timestamp")),
            "ingested_at": F.when(F.expr("event_key % 80 = 0"), F.lit(None).cast("timestamp_ntz"))
            .when(F.expr("event_key % 80 = 40"), F.expr("timestamp_ntz'9999-12-31 11:59:59'"))
            .when(F.expr("event_key % 7 = 3"), F.col("timestamp").try_cast("timestamp_ntz"))
            .otherwise(F.col("ingested_at").cast("timestamp_ntz")),
        }
    ).drop("event_key")


def broken_current_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current responses of which some, of every third station, lack their time or their measures or are no JSON."""
    kind = F.col("event_id") % 300
    body = F.when(kind == 3, F.lit('{"main": {}}')).when(kind == 103, F.lit('{"dt": 1}')).when(kind == 203, F.lit("{broken"))
    spoilt = F.when(F.col("city_id") % 3 == 2, body)
    rows = current_payloads(spark, sf_dir, ["event_id"])
    return rows.withColumn("payload", F.coalesce(spoilt, F.col("payload"))).drop("event_id")


def with_silent_station(stations: DataFrame) -> DataFrame:
    """The registry and one more station, which never answers."""
    silent = stations.agg((F.max("city_id") + 1).cast("int").alias("city_id"))
    named = silent.select("city_id", F.lit("SILENT").alias("city_name"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    return stations.unionByName(named)


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean(raw_observations(spark, sf_dir), tiebreak=["ingest_seq"])


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature store; the series are sized on the raw rows, a superset of the clean ones."""
    raw = raw_observations(spark, sf_dir)
    profile = profile_series(raw, features.SERIES)
    clean = silver.clean(raw, tiebreak=["ingest_seq"])
    if profile.has_long_series:
        clean = materialise(clean, "silver")
    return features.feature_store(clean, profile)


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.extreme_events_daily(feature_rows(spark, sf_dir))


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature store over a stored silver table, itself stored: for readers of many columns."""
    clean = materialise(silver_rows(spark, sf_dir), "silver")
    return materialise(features.feature_store(clean), "features")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of the stations that ``raw_observations`` reports."""
    raw = raw_observations(spark, sf_dir)
    return raw.select("city_id", "city_name", "lat", "lon").dropna().distinct()


def current_payloads(spark: SparkSession, sf_dir: str, extra: Sequence[str] = ()) -> DataFrame:
    """One JSON response per event, with parts left out here and there."""
    events = table(spark, sf_dir, "events")
    event = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    amount = F.floor("value").cast("double")
    body = F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
        F.struct(
            (k * F.lit(0.75) - F.lit(12.0)).alias("temp"),
            F.when(event % 13 != 0, (event % 107).cast("double")).alias("humidity"),
            (F.lit(990) + event % 41).cast("double").alias("pressure"),
        ).alias("main"),
        F.when(event % 7 != 0, F.struct((amount * F.lit(0.25)).alias("speed"))).alias("wind"),
        F.when(k % 5 == 0, F.create_map(F.lit("1h"), amount))
        .when(k % 5 == 1, F.create_map(F.lit("3h"), amount))
        .alias("rain"),
        F.when(event % 11 != 0, F.array(F.struct(F.col("event_type").alias("main")))).alias("weather"),
    )
    station = F.floor(F.col("user_id") / F.lit(STATION_USERS)).cast("int") + 1
    return events.select(station.alias("city_id"), F.to_json(body).alias("payload"), *extra)


HOURS_PER_RESPONSE = 24
RESPONSES_PER_STATION = 40


def history_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON responses of parallel arrays, 24 consecutive events each.

    Some lack the pressure or everything; some have a short array; some were fetched before the
    last of their hours.
    """
    events = table(spark, sf_dir, "events")
    block = F.floor(F.col("event_id") / F.lit(HOURS_PER_RESPONSE)).cast("int")
    hour = F.struct(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        (F.get_json_object("props", "$.k").cast("int") * F.lit(0.75) - F.lit(12.0)).alias("temperature_2m"),
        (F.col("event_id") % 107).cast("double").alias("relative_humidity_2m"),
        (F.lit(990) + F.col("event_id") % 41).cast("double").alias("pressure_msl"),
        _quarter(F.col("value")).alias("wind_speed_10m"),
        F.floor("value").cast("double").alias("rain"),
    )
    blocks = events.groupBy(block.alias("block")).agg(
        F.array_sort(F.collect_list(hour)).alias("hours"), F.max("ts").alias("last")
    )
    station = F.floor(F.col("block") / F.lit(RESPONSES_PER_STATION)).cast("int") + 1
    wind = F.col("hours.wind_speed_10m")
    broken = (F.col("block") % 50 == 13) | (station % 4 == 0)
    hourly = F.struct(
        F.col("hours.time").alias("time"),
        F.col("hours.temperature_2m").alias("temperature_2m"),
        F.col("hours.relative_humidity_2m").alias("relative_humidity_2m"),
        F.when(F.col("block") % 4 != 0, F.col("hours.pressure_msl")).alias("pressure_msl"),
        F.when(broken, F.slice(wind, 1, F.size(wind) - 1)).otherwise(wind).alias("wind_speed_10m"),
        F.col("hours.rain").alias("rain"),
    )
    body = F.struct(F.when(F.col("block") % 50 != 7, hourly).alias("hourly"))
    fetched = F.when(F.col("block") % 5 == 0, F.col("last") - F.expr("interval 1 hour")).otherwise(F.col("last"))
    return blocks.select(station.alias("city_id"), fetched.alias("fetched_at"), F.to_json(body).alias("payload"))


def history_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of the stations of ``history_payloads``, and one that never answers."""
    per_station = HOURS_PER_RESPONSE * RESPONSES_PER_STATION
    answered = table(spark, sf_dir, "events").select(
        (F.floor(F.col("event_id") / F.lit(per_station)).cast("int") + 1).alias("city_id")
    )
    silent = answered.agg((F.max("city_id") + 1).alias("city_id"))
    ids = answered.distinct().unionByName(silent)
    return ids.select(
        "city_id",
        F.concat(F.lit("CITY_"), "city_id").alias("city_name"),
        (F.lit(8.0) + (F.col("city_id") % 10) * F.lit(0.5)).alias("lat"),
        (F.lit(102.0) + (F.col("city_id") % 10) * F.lit(0.25)).alias("lon"),
    )


def uneven_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings to the minute where one station has over a third of all rows."""
    events = table(spark, sf_dir, "events")
    station = F.floor(F.col("user_id") / F.lit(STATION_USERS)).cast("int") + 1
    rows = events.select(
        F.when(F.col("event_id") % 3 == 0, 0).otherwise(station).alias("city_id"),
        truncated("minute", F.col("ts")).alias("timestamp_utc"),
        (F.get_json_object("props", "$.k").cast("int") * F.lit(0.75)).alias("temperature_c"),
        F.when(F.col("event_id") % 13 != 0, _quarter(F.col("value"))).alias("wind_speed_ms"),
        F.col("event_id").alias("ingest_seq"),
    )
    return latest_wins(rows, ["city_id", "timestamp_utc"], [F.col("ingest_seq").desc()])
