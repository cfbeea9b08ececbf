"""API payload tables to observation rows.

A payload table has one row per response: ``city_id``, ``payload`` (JSON text) and, for history,
``fetched_at``. Station attributes come from the registry.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.schemas import CURRENT_PAYLOAD, HISTORY_ARRAYS, HISTORY_PAYLOAD, OBSERVATION

# A registry of this many rows is small enough for every task; the real one has 63.
BROADCAST_STATIONS = 100_000


def _with_station(rows: DataFrame, registry: DataFrame) -> DataFrame:
    stations = registry.select("city_id", "city_name", "lat", "lon")
    if stations.limit(BROADCAST_STATIONS + 1).count() <= BROADCAST_STATIONS:
        stations = F.broadcast(stations)
    return rows.join(stations, "city_id").select(
        *[F.col(f.name).cast(f.dataType) for f in OBSERVATION.fields]
    )


def _parsed(payloads: DataFrame, schema: T.StructType, columns: Sequence[str], **options: str) -> DataFrame:
    """The given columns and the parsed payload ``b``.

    The parse goes through a generator: filters on ``b`` then stay above it, and the text is not
    parsed again for each of them.
    """
    body = F.from_json("payload", schema, options)
    return payloads.select(*columns, F.inline(F.array(F.struct(body.alias("b")))))


def _usable_history(h: Column) -> Column:
    """All times can be read, and every given array reaches the last of them up to the fetch time."""
    times = F.coalesce(h["time"], F.array().cast("array<string>"))
    wanted = F.aggregate(
        F.transform(times, lambda t, i: F.when(t.try_cast("timestamp_ntz") <= F.col("fetched_at"), i + 1)),
        F.lit(0),
        lambda last, i: F.greatest(last, i),  # skips hours that are not wanted
    )
    reaches = [h[a].isNull() | (F.size(h[a]) >= wanted) for a in HISTORY_ARRAYS.values()]
    usable = F.forall(times, lambda t: t.try_cast("timestamp_ntz").isNotNull())
    for r in reaches:
        usable = usable & r
    return usable


def read_history(payloads: DataFrame) -> DataFrame:
    """Payload rows with the parsed response ``h`` and whether it is ``usable``.

    A response without ``hourly`` is usable and holds no rows.
    """
    schema = T.StructType([*HISTORY_PAYLOAD.fields, T.StructField("unreadable", T.StringType())])
    parsed = _parsed(payloads, schema, payloads.columns, columnNameOfCorruptRecord="unreadable")
    hours = F.col("b.hourly")
    complete = F.when(hours.isNull(), True).otherwise(_usable_history(hours))
    readable = F.col("b").isNotNull() & F.col("b.unreadable").isNull()
    usable = readable & F.coalesce(complete, F.lit(False))
    return parsed.select(*payloads.columns, hours.alias("h"), usable.alias("usable"))


def usable_history(payloads: DataFrame) -> DataFrame:
    """The payload rows that can be parsed, as they came: for callers who keep the others (``unusable_history``)."""
    return read_history(payloads).filter("usable").select(*payloads.columns)


def unusable_history(payloads: DataFrame) -> DataFrame:
    """The payload rows that cannot be parsed, as they came, to be set aside and fetched again."""
    return read_history(payloads).filter("not usable").select(*payloads.columns)


def _only_usable(read: DataFrame, what: str) -> DataFrame:
    """Fails the job at the first response that is not usable."""
    station = F.coalesce(F.col("city_id").cast("string"), F.lit("NULL"))
    refused = F.raise_error(F.concat(F.lit(f"unusable {what} response of station "), station))
    return read.filter(F.when(F.col("usable"), True).otherwise(refused.cast("boolean")))


def parse_history(payloads: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per hour up to the fetch time; parallel arrays are read by position.

    An unusable response fails the job, so that no station's hours are lost unseen; ``failed_stations`` tells
    beforehand which stations have one, and ``usable_history`` leaves them out.
    """
    good = _only_usable(read_history(payloads), "history")
    hours = F.transform(
        F.col("h.time"),
        lambda t, i: F.struct(
            t.alias("timestamp"),
            *[F.get(F.col("h")[a], i).alias(n) for n, a in HISTORY_ARRAYS.items()],
        ),
    )
    rows = good.select("city_id", "fetched_at", F.inline(hours)).filter(
        F.col("timestamp").cast("timestamp_ntz") <= F.col("fetched_at")
    )
    return _with_station(rows.withColumn("weather_condition", F.lit(None).cast("string")), registry)


def read_current(payloads: DataFrame) -> DataFrame:
    """Payload rows with the parsed response ``b`` and whether it is ``usable``: readable, with a time and measures."""
    schema = T.StructType([*CURRENT_PAYLOAD.fields, T.StructField("unreadable", T.StringType())])
    parsed = _parsed(payloads, schema, payloads.columns, columnNameOfCorruptRecord="unreadable")
    readable = F.col("b").isNotNull() & F.col("b.unreadable").isNull()
    usable = readable & F.col("b.dt").isNotNull() & F.col("b.main").isNotNull()
    return parsed.withColumn("usable", F.coalesce(usable, F.lit(False)))


def parse_current(payloads: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per response; rain is 0 unless a last-hour amount is given.

    An unusable response fails the job; ``failed_current`` tells beforehand which stations have one.
    """
    parsed = _only_usable(read_current(payloads), "current")
    at = F.expr("timestampadd(SECOND, b.dt, timestamp_ntz'1970-01-01 00:00:00')")
    rain = F.col("b.rain")
    rows = parsed.select(
        "city_id",
        F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("timestamp"),
        F.col("b.main.temp").alias("temperature"),
        F.col("b.main.humidity").alias("humidity"),
        F.col("b.main.pressure").alias("pressure"),
        F.col("b.wind.speed").alias("wind_speed"),
        F.when(F.map_contains_key(rain, "1h"), rain["1h"]).otherwise(F.lit(0.0)).alias("rain"),
        F.get("b.weather", F.lit(0))["main"].alias("weather_condition"),
    )
    return _with_station(rows, registry)


FIRST_DAY = date(2025, 1, 1)


def within_dates(rows: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """The requested observation dates, both included; by default from FIRST_DAY to today."""
    day = F.to_date(F.col("timestamp").try_cast("timestamp_ntz"))
    last = F.lit(end) if end else F.current_date()
    return rows.filter(day.between(F.lit(start or FIRST_DAY), last))


def _failed(registry: DataFrame, read: DataFrame) -> DataFrame:
    answers = read.groupBy("city_id").agg(F.bool_and("usable").alias("usable"))
    return registry.join(answers.filter("usable"), "city_id", "left_anti")


def failed_stations(registry: DataFrame, payloads: DataFrame) -> DataFrame:
    """Stations without a history response, or with one that cannot be used."""
    return _failed(registry, read_history(payloads))


def failed_current(registry: DataFrame, payloads: DataFrame) -> DataFrame:
    """Stations without a current response, or with one that cannot be used."""
    return _failed(registry, read_current(payloads))


def require_complete(registry: DataFrame, payloads: DataFrame, failed=failed_stations) -> None:
    """Call before writing: fail the whole batch, naming all its failed stations (a registry's rows at most).

    ``failed`` is ``failed_stations`` for history and ``failed_current`` for current responses.
    """
    names = [r.city_name for r in failed(registry, payloads).select("city_name").orderBy("city_name").collect()]
    if names:
        raise RuntimeError("No usable answer from stations: " + ", ".join(map(str, names)))
