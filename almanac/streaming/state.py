"""Streams with state of their own: features of arriving rows, and corrections of any age.

Both keep little per key and leave the rest to the stored tables. They need the keyed state store (``use_keyed_state``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from almanac.functions.temporal import sort_key
from almanac.operators.frames import Lag, Rolling, lookback_of
from almanac.operators.latest import latest_wins
from almanac.operators.validity import valid_only
from almanac.plans.features import BASE, LAGS, MEASURES, ROLLING_7D, ROLLING_24H, WINDOW_COLUMNS
from almanac.sources.tables import Snapshot, Transaction, month_of
from almanac.streaming.windows import day_counts

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_keyed_state(spark: SparkSession) -> None:
    """Streams that start from now on keep their state by key, on disk."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


# Frames of arriving rows

_AT = "at_micros"  # names that begin with an underscore do not reach the processors
_CHUNK = 4096  # rows whose frames are worked out at a time


def _frame(values: np.ndarray, spec: Rolling, first: int) -> np.ndarray:
    """The statistic of the frames that end at ``first`` and later values; NaN is a missing value."""
    out = np.full(len(values) - first, np.nan)
    padded = np.concatenate((np.full(spec.rows - 1, np.nan), values))
    frames = np.lib.stride_tricks.sliding_window_view(padded, spec.rows)[first:]
    for at in range(0, len(out), _CHUNK):
        frame = frames[at : at + _CHUNK]
        known = ~np.isnan(frame)
        n = known.sum(axis=1)
        if spec.fn in ("min", "max"):
            fill, pick = (np.inf, np.min) if spec.fn == "min" else (-np.inf, np.max)
            result, least = pick(np.where(known, frame, fill), axis=1), 1
        else:
            total = np.where(known, frame, 0.0).sum(axis=1)
            mean = total / np.maximum(n, 1)
            result, least = (total if spec.fn == "sum" else mean), 1
            if spec.fn in ("var", "std"):
                squares = (np.where(known, frame - mean[:, None], 0.0) ** 2).sum(axis=1)
                result, least = squares / np.maximum(n - 1, 1), 2
                result = np.sqrt(result) if spec.fn == "std" else result
        out[at : at + _CHUNK] = np.where(n >= least, result, np.nan)
    return out


def _lagged(values: np.ndarray, back: int, first: int) -> np.ndarray:
    return np.concatenate((np.full(back, np.nan), values))[first : len(values)]


class FramesOfSeries(StatefulProcessor):
    """Keeps the last rows of a series and works out the frames of the rows that come after them.

    A row that is not later than the last one of the state would change frames that have been sent; it comes back
    with ``in_order`` false and without frames. So does all but one of the rows with one time.
    """

    def __init__(self, columns: Sequence[str], rolling: Sequence[Rolling], lags: Sequence[Lag], out: Sequence[str]):
        self.columns, self.rolling, self.lags, self.out = list(columns), list(rolling), list(lags), list(out)
        self.keep = lookback_of(rolling, lags)

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField("times", T.ArrayType(T.LongType()))]
        fields += [T.StructField(c, T.ArrayType(T.DoubleType())) for c in self.columns]
        self.last = handle.getValueState("last", T.StructType(fields))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True)  # one station's rows of one batch
        if self.last.exists():
            times, *kept = (np.array(v, dtype=t) for v, t in zip(self.last.get(), [np.int64] + [float] * len(self.columns), strict=True))
        else:
            times, kept = np.empty(0, dtype=np.int64), [np.empty(0)] * len(self.columns)
        arrived = arrived.sort_values(_AT, kind="stable", ignore_index=True)
        at = arrived[_AT].to_numpy()
        newer = at > (times[-1] if len(times) else np.iinfo(np.int64).min)
        newer &= np.concatenate(([True], at[1:] != at[:-1]))
        late, fresh = arrived[~newer].copy(), arrived[newer].copy()
        if len(late):
            yield self._shaped(late, False)
        if len(fresh):
            values = {c: np.concatenate((k, fresh[c].to_numpy(dtype=float))) for c, k in zip(self.columns, kept, strict=True)}
            first = len(times)
            for r in self.rolling:
                fresh[r.name] = _frame(values[r.column], r, first)
            for g in self.lags:
                fresh[g.name] = _lagged(values[g.column], g.back, first)
            times = np.concatenate((times, fresh[_AT].to_numpy()))[-self.keep :]
            self.last.update((times.tolist(), *[values[c][-self.keep :].tolist() for c in self.columns]))
            yield self._shaped(fresh, True)

    def _shaped(self, rows: pd.DataFrame, in_order: bool) -> pd.DataFrame:
        for c in self.out:
            if c not in rows.columns:
                rows[c] = np.nan
        rows["in_order"] = in_order
        return rows[[*self.out, "in_order"]]

    def close(self) -> None:
        pass


def stream_features(silver: DataFrame) -> DataFrame:
    """The frames and lags of arriving valid silver rows, as ``frame_rows`` gives them, and ``in_order``.

    State per station: its last 167 rows. Rows may arrive in any order within a batch; one that is not later than its
    station's last row of an earlier batch has ``in_order`` false and no frames, and is for the refresh of the stored
    tables, which takes rows of any age. A station's rows of one batch meet in one task, so bound the batches. A
    pressure that is not a number counts as missing.
    """
    made = [r.name for r in ROLLING_24H + ROLLING_7D] + [g.name for g in LAGS]
    measures = list(MEASURES.values())
    carried = ["city_name", "lat", "lon", "weather_condition", "source"]
    valid = valid_only(silver).select(
        "city_id", sort_key(F.col("timestamp_utc")).alias(_AT), *carried, *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in measures]
    )
    types = dict(valid.dtypes)
    out = ["city_id", _AT, *carried, *measures]
    schema = ", ".join([f"{c} {types[c]}" for c in out] + [f"{c} double" for c in made] + ["in_order boolean"])
    processor = FramesOfSeries(measures, ROLLING_24H + ROLLING_7D, LAGS, [*out, *made])
    framed = valid.groupBy("city_id").transformWithStateInPandas(processor, schema, "Append", "None")
    at = F.timestamp_micros(_AT).cast("timestamp_ntz")
    placed = framed.withColumns(
        {"timestamp_utc": at, "observed_hour_utc": F.date_trunc("hour", at).cast("timestamp_ntz"), "observed_date": F.to_date(at)}
    )
    return placed.select(*BASE, *WINDOW_COLUMNS, "in_order")


def store_features(framed: DataFrame, path: str, late_path: str, checkpoint: str) -> None:
    """Take in everything available, then stop: rows in order go to one Parquet table, the others to another.

    A batch that is repeated after a failure replaces what it has written before.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.persist()
        for rows, where in ((batch.filter("in_order"), path), (batch.filter("not in_order"), late_path)):
            rows.drop("in_order").write.mode("overwrite").parquet(f"{where}/batch={number}")
        batch.unpersist()

    _run(framed, put, checkpoint)


_IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


def _run(df: DataFrame, put, checkpoint: str, mode: str = "append") -> None:
    """Take in everything available, then stop. Timers wait for the next rows: a stream with timers by the clock would
    otherwise go on with empty batches for ever."""
    conf = df.sparkSession.conf
    before = conf.get(_IDLE)
    writer = df.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint)
    conf.set(_IDLE, "false")
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        conf.set(_IDLE, before)
    query.awaitTermination()


# Corrections of any age

_DAY = "event_day"
_BUCKET = "bucket"
_SERIES = "series"
_PAYLOAD = "payload"
_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


#: Groups into which the series of a day are dealt. Each costs the same few milliseconds a batch however few rows it has,
#: so a group for each series would be dear; and each is one task's to hold, so very many stations want more of them.
BUCKETS = 64


class WinnersOfDay(StatefulProcessor):
    """Per bucket of series and day, the order of each time's winner so far; passes on the rows that beat it.

    The state holds the series' names and, as packed numbers, each winner's place in them, time and order.
    """

    def __init__(self, orders: Sequence[str], keep_ms: int):
        self.numbers, self.keep_ms = [_AT, *orders], keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.winners = handle.getValueState("winners", "series array<string>, places binary, numbers binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows), ignore_index=True)[::-1]  # of equal orders the last one wins here: the known, then the first
        names, places, numbers = self.winners.get() if self.winners.exists() else ([], b"", b"")
        known = {name: i for i, name in enumerate(names)}
        own = np.array([known.setdefault(n, len(known)) for n in arrived[_SERIES]], np.int32)
        place = np.concatenate((own, np.frombuffer(places, np.int32)))
        before = np.frombuffer(numbers, np.int64).reshape(len(self.numbers), -1)
        each = np.concatenate((arrived[self.numbers].to_numpy(np.int64).T, before), axis=1)
        by = np.lexsort((*each[::-1], place))  # by series, time, orders
        series, at = place[by], each[0, by]
        won = by[np.append((series[1:] != series[:-1]) | (at[1:] != at[:-1]), True)]
        self.winners.update((list(known), place[won].tobytes(), each[:, won].tobytes()))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep_ms)
        fresh = won[won < len(own)]
        if len(fresh):
            yield arrived[[_PAYLOAD]].iloc[fresh]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.winners.clear()
        return iter(())

    def close(self) -> None:
        pass


def winning_rows(
    df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], keep_days: float = 35, buckets: int = BUCKETS
) -> DataFrame:
    """The rows that are the latest of their key and time so far, from a stream; rows without a time are left out.

    ``order`` names timestamps or whole numbers, missing ones lowest. State per bucket of keys and day: one entry for
    each key and time, dropped by a timer when they have had no rows for ``keep_days``. A row that comes after that, or
    after the number of buckets was changed, is passed on untested, so whoever stores the rows compares them with the stored ones (``merge_latest``): nothing is ever lost.
    """
    known = df.filter(F.col(time).isNotNull())
    orders = {f"order_{i}": _as_long(df, c) for i, c in enumerate(order)}
    series = F.to_json(F.struct(*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)]), _FORMATS)
    slim = known.select(
        F.pmod(F.xxhash64(series), F.lit(buckets)).cast("int").alias(_BUCKET),
        F.to_date(time).alias(_DAY),
        series.alias(_SERIES),
        sort_key(F.col(time)).alias(_AT),
        *[c.alias(n) for n, c in orders.items()],
        F.to_json(F.struct(*df.columns), _FORMATS).alias(_PAYLOAD),
    )
    processor = WinnersOfDay(list(orders), int(keep_days * 86_400_000))
    won = slim.groupBy(_BUCKET, _DAY).transformWithStateInPandas(processor, f"{_PAYLOAD} string", "Update", "ProcessingTime")
    return won.select(F.from_json(_PAYLOAD, df.schema, _FORMATS).alias("row")).select("row.*")


def _as_long(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    value = F.col(column) if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)) else sort_key(F.col(column))
    return F.coalesce(value.cast("long"), F.lit(-(2**63)))


def merge_latest(
    rows: DataFrame, root: str, name: str, keys: Sequence[str], time: str, order: Sequence[str]
) -> None:
    """Merge rows into the stored table of latest rows, by month; of stored and new rows of one key and time, the
    latest stays. A repeated merge changes nothing."""
    spark = rows.sparkSession
    change = Transaction(spark, root)
    by_order = [F.col(c).desc_nulls_last() for c in order]
    place, cluster = month_of(time), [*keys, time]
    if not change.has(name):
        change.write(latest_wins(rows, [*keys, time], by_order), name, place, cluster)
    else:
        months = [r[0] for r in rows.select(month_of(time)).distinct().collect()]  # folders, at most
        if not months:
            return
        together = change.read(name, months).unionByName(rows)
        change.replace_months(latest_wins(together, [*keys, time], by_order), name, place, months, cluster)
    change.commit()


def store_latest(
    df: DataFrame, root: str, name: str, keys: Sequence[str], time: str, order: Sequence[str], checkpoint: str,
    keep_days: float = 35,
) -> None:
    """Take in everything available, then stop: the table then holds the latest row per key and time of all rows that
    ever came, whatever their age."""

    def put(batch: DataFrame, number: int) -> None:
        batch.persist()
        merge_latest(batch, root, name, keys, time, order)
        batch.unpersist()

    _run(winning_rows(df, keys, time, order, keep_days), put, checkpoint, "update")


# Counts of days, with late rows set aside

OPEN, CLOSED, LATE = "open_days", "closed_days", "late_rows"


def _ended(day: Column, seen: str | None, lateness: str) -> Column:
    """Whether the day lies before the watermark: ``lateness`` before the latest time seen."""
    if seen is None:
        return F.lit(False)
    watermark = F.lit(seen).cast("timestamp_ntz") - F.expr(f"interval {lateness}")
    return F.date_trunc("day", day).cast("timestamp_ntz") + F.expr("interval 1 day") <= watermark


def _added(counts: DataFrame) -> DataFrame:
    """Counts of one station and day in several rows, added up."""
    sums = [F.sum(c).alias(c) for c in ("observations", "heavy_rain_count")]
    return counts.groupBy("city_id", "window_start").agg(*sums)


def count_days(
    observations: DataFrame, root: str, checkpoint: str, heavy_rain_mm: float = 50.0, lateness: str = "2 hours"
) -> None:
    """Take in everything available, then stop: valid readings and heavy-rain readings per station and day.

    The watermark of a batch is ``lateness`` before the latest time of all batches before it. Rows of days that had
    ended by then are set aside as they are, in a table of their own; days that have ended by the next batch's
    watermark are closed; the others stay open. The three tables change together and with the number of the batch, so
    a batch that is repeated after a failure changes nothing. ``counted_days`` adds the rows set aside.
    """

    def put(batch: DataFrame, number: int) -> None:
        change = Transaction(batch.sparkSession, root)
        facts = change.facts(OPEN) if change.has(OPEN) else {"batch": -1, "seen": None}
        if number <= facts["batch"]:
            return
        rows = valid_only(batch).filter(F.col("timestamp_utc").isNotNull()).persist()
        newest = rows.agg(F.max("timestamp_utc").cast("string")).first()[0]
        seen = max(filter(None, [facts["seen"], newest]), default=None)
        late = _ended(F.col("timestamp_utc"), facts["seen"], lateness)
        counted = day_counts(rows.filter(~late), heavy_rain_mm)
        part = F.lit(f"{number:012d}")

        def put_part(df: DataFrame, name: str) -> None:
            if change.has(name):
                change.replace_months(df, name, part, [f"{number:012d}"], ["city_id"])
            else:
                change.write(df, name, part, ["city_id"])

        put_part(rows.filter(late), LATE)
        if change.has(OPEN):
            counted = _added(change.read(OPEN).unionByName(counted))
        ended = _ended(F.col("window_start"), seen, lateness)
        put_part(counted.filter(ended), CLOSED)
        change.write(counted.filter(~ended), OPEN)
        change.note(OPEN, batch=number, seen=seen)
        change.commit()
        rows.unpersist()

    _run(observations, put, checkpoint)


def counted_days(state: Snapshot, heavy_rain_mm: float = 50.0) -> DataFrame:
    """The closing batch: closed and open days, and the rows that were set aside, added to their days."""
    late = day_counts(state.read(LATE), heavy_rain_mm)
    return _added(state.read(CLOSED).unionByName(state.read(OPEN)).unionByName(late))
