"""Incremental refresh of the model tables from newly arrived bronze files.

Latest-wins is associative, so arrived rows are merged into the stored silver rows of the months they belong to, and
corrections of any age count. What follows from a changed silver row is rewritten and nothing else: its month's counts,
seasonal cells and averages, and the frames and events of the months whose frames reach back to it. All tables change
together, when the last of them is written; until then, and after a failure, readers see the old state. A repeated
batch gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.operators.checks import refuse_nulls
from almanac.operators.frames import lookback_of
from almanac.operators.validity import valid_only
from almanac.plans import models
from almanac.plans.features import LAGS, ROLLING_7D, ROLLING_24H, frame_rows, seasonal_cells
from almanac.plans.marts import extreme_events_daily, monthly_climate
from almanac.plans.silver import COLUMNS, KEYS, clean, newest
from almanac.session import at_once, materialise
from almanac.sources import bronze
from almanac.sources.tables import Transaction, month_of, snapshot

REACH = lookback_of(ROLLING_24H + ROLLING_7D, LAGS)


def _months(df: DataFrame) -> list[str]:
    """Distinct months: as many as the table has folders, at most."""
    return sorted(r[0] for r in df.select("month").distinct().collect())


def _rows_between(counts: DataFrame, months: list[str], stations: DataFrame | None, back: bool) -> DataFrame:
    """For the given months (of the given stations), the later or earlier months of the same station, with the number
    of valid rows that lie between the two."""
    there = counts.select("city_id", "month") if stations is None else stations
    start = there.filter(F.col("month").isin(months)).select("city_id", F.col("month").alias("from_month"))
    side = F.col("month") < F.col("from_month") if back else F.col("month") > F.col("from_month")
    order = F.col("month").desc() if back else F.col("month")
    upto = F.sum("n").over(Window.partitionBy("city_id", "from_month").orderBy(order))
    return counts.join(start, "city_id").filter(side).select("month", (upto - F.col("n")).alias("between"))


def reached_months(counts: DataFrame, touched: DataFrame, months: list[str]) -> list[str]:
    """The touched months, and those that lie at most REACH valid rows behind one of the same station."""
    return sorted({*months, *_months(_rows_between(counts, months, touched, back=False).filter(F.col("between") <= REACH))})


def needed_months(counts: DataFrame, months: list[str]) -> list[str]:
    """The given months and those before them that hold the REACH valid rows before any station's first row there."""
    return sorted({*months, *_months(_rows_between(counts, months, None, back=True).filter(F.col("between") < REACH))})


def _merged_silver(change: Transaction, arrived: DataFrame, tiebreak: Sequence[str]) -> tuple[list[str], DataFrame]:
    """Merge arrived rows into their months; returns the months and the station-months whose rows may have changed."""
    fresh = materialise(clean(arrived, tiebreak, keep=tiebreak), "arrived")
    touched = fresh.select("city_id", month_of(models.DAY).alias("month")).distinct()
    months = _months(touched)
    if months:
        stored = change.read(models.SILVER, months)
        counters = models.quality_counters()
        before = stored.agg(*[c.alias(n) for n, c in counters.items()]).first().asDict()
        merged = newest(stored.unionByName(fresh), tiebreak)
        counted = change.replace_months(merged, models.SILVER, *_place(models.SILVER, months), counters)
        refuse_nulls(counted, KEYS)
        total = change.facts(models.SILVER)["counted"]
        change.note(models.SILVER, counted={n: total[n] - before[n] + counted[n] for n in total})
    return months, touched


def _place(name: str, months: list[str]) -> tuple:
    month, cluster = models.stored_under(name)
    return month, months, cluster


def refresh_rows(arrived: DataFrame, root: str, tiebreak: Sequence[str] = ()) -> None:
    """Bring the tables below ``root`` up to date with arrived raw rows; the first call builds them."""
    spark = arrived.sparkSession
    if not snapshot(spark, root).has(models.SILVER):
        models.build_models(arrived, root, tiebreak)
        return
    change = Transaction(spark, root)
    months, touched = _merged_silver(change, arrived, tiebreak)
    if not months:
        return

    def replace(name: str, df: DataFrame, of: list[str]) -> None:
        change.replace_months(df, name, *_place(name, of))

    silver = change.read(models.SILVER, months)
    at_once(
        lambda: replace(models.COUNTS, models.valid_counts(silver), months),
        lambda: replace(models.CELLS, seasonal_cells(valid_only(silver)), months),
        lambda: replace(models.MONTHLY, monthly_climate(silver), months),
    )

    counts = change.read(models.COUNTS)
    rewritten = reached_months(counts, touched, months)  # a month that lost all its valid rows must be emptied, too
    needed = needed_months(counts, rewritten)
    profile = models.profile_of_counts(change.read(models.COUNTS, needed))
    framed = frame_rows(change.read(models.SILVER, needed).select(*COLUMNS), profile)
    replace(models.FRAMES, framed.filter(month_of(models.DAY).isin(rewritten)), rewritten)
    replace(models.EVENTS, extreme_events_daily(change.read(models.FRAMES, rewritten)), rewritten)
    change.commit()


def refresh_arrived(
    spark: SparkSession,
    lake: str,
    root: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    files: int = 1000,
    read: Callable[[SparkSession, str, list[str]], DataFrame] = bronze.read_files,
) -> None:
    """Take in every file that has arrived below ``lake`` since the last call, then stop.

    The stream carries file names only, at most ``files`` at a time; the files may be of any writer, as each is read
    with its own types.
    """

    def take_in(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r.path for r in batch.collect())  # at most ``files``
        if paths:
            refresh_rows(read(spark, lake, paths), root, tiebreak)

    names = (
        spark.readStream.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files)
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(f"{lake.rstrip('/')}/{bronze.FOLDER}")
        .select("path")
    )
    query = (
        names.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
