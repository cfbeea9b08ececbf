"""Streaming operators with bounded lateness. Append mode holds back what may still change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators.validity import valid_only


def _event_time(df: DataFrame, time: str, lateness: str) -> DataFrame:
    return df.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", lateness)


def daily_event_counts(
    observations: DataFrame, heavy_rain_mm: float = 50.0, lateness: str = "2 hours", span: str = "1 day"
) -> DataFrame:
    """Valid readings and heavy-rain readings per station and day: the rules without look-back."""
    return _daily_counts(_event_time(valid_only(observations), "timestamp_utc", lateness), heavy_rain_mm, span)


def day_counts(valid: DataFrame, heavy_rain_mm: float = 50.0, span: str = "1 day") -> DataFrame:
    """The same of valid rows in a batch."""
    return _daily_counts(valid.withColumn("_at", F.col("timestamp_utc").cast("timestamp")), heavy_rain_mm, span)


def _daily_counts(timed: DataFrame, heavy_rain_mm: float, span: str) -> DataFrame:
    return (
        timed.groupBy(F.window("_at", span), "city_id")
        .agg(
            F.count("*").alias("observations"),
            F.count_if(F.col("rain_mm") >= F.lit(heavy_rain_mm)).alias("heavy_rain_count"),
        )
        .select(
            "city_id",
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            "observations",
            "heavy_rain_count",
        )
    )


def daily_counts_tail(
    observations: DataFrame, stored: DataFrame, heavy_rain_mm: float = 50.0, span: str = "1 day"
) -> DataFrame:
    """The days after the last one that the stream has stored, from the batch: what it still holds open when it stops.

    ``stored`` may be empty. Its last day is complete, so whole days are added and none twice.
    """
    last = stored.agg(F.max("window_start").alias("last"))  # one row
    counted = day_counts(valid_only(observations), heavy_rain_mm, span)
    open_days = counted.join(F.broadcast(last), F.col("last").isNull() | (F.col("window_start") > F.col("last")))
    return open_days.drop("last")


def latest_wins_tail(
    df: DataFrame, stored: DataFrame, keys: Sequence[str], time: str, order: Sequence[str]
) -> DataFrame:
    """Latest row per key after the last time that the stream has stored, from the batch."""
    last = stored.agg(F.max(time).alias("_last"))  # one row
    later = df.join(F.broadcast(last), F.col("_last").isNull() | (F.col(time) > F.col("_last"))).drop("_last")
    newest = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("row")
    return later.groupBy(time, *keys).agg(newest).select("row.*")


def latest_wins_stream(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], lateness: str = "2 hours"
) -> DataFrame:
    """Latest row per key, final once the watermark has passed its time.

    Rows later than ``lateness`` are lost and the newest keys stay open, which is why the tables
    are refreshed by batch; ``dropDuplicates`` would keep the first row instead.
    """
    columns = df.columns
    newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("row")
    return _event_time(df, time, lateness).groupBy("_at", *keys).agg(newest).select("row.*")


def store_stream(df: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available to a Parquet table, then stop."""
    query = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
