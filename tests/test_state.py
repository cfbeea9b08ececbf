"""Streams with state: frames of arriving rows, corrections of any age, late rows set aside."""

import pytest
from pyspark.sql import functions as F
from rows import hourly

from almanac.operators.latest import latest_wins
from almanac.plans.features import ROLLING_7D, ROLLING_24H, WINDOW_COLUMNS, frame_rows
from almanac.plans.silver import clean
from almanac.sources.tables import Transaction, snapshot
from almanac.streaming import state

LATER = "2026-02-01T00:00:00+00:00"


@pytest.fixture(autouse=True)
def keyed(spark):
    state.use_keyed_state(spark)


def arrive(spark, rows, folder):
    """The rows written as one more load; the stream of all loads."""
    rows.coalesce(2).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).parquet(folder)


def rounded(df, *columns):
    digits = [F.round(c, 9).alias(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in columns]
    return sorted(map(str, df.select(*digits).collect()))


def test_frames_of_arriving_rows(spark, raw_rows, tmp_path):
    """Two stations, gaps, missing pressure, an invalid row, more rows than a frame holds; a restart between loads."""
    folder, out, late, log = (str(tmp_path / n) for n in ("in", "out", "late", "log"))
    values = {
        "temperature": lambda i: "99" if i % 50 == 7 else str(i % 13 * 0.75),
        "pressure": lambda i: None if i % 3 else float(990 + i % 7),
        "rain": lambda i: str(i % 5),
        "wind_speed": lambda i: i % 11 * 0.25,
        "ingested_at": LATER,
    }
    loads = [
        hourly(200, city_id=1, **values) + hourly(3, city_id=2, **values),
        hourly(60, start=205, city_id=1, **values),
        hourly(1, start=2000, city_id=1, **values) + hourly(30, start=3, city_id=2, **values),
    ]
    everything = []
    for load in loads:
        everything += load
        state.store_features(state.stream_features(arrive(spark, clean(raw_rows(*load)), folder)), out, late, log)
    got = spark.read.parquet(out).drop("batch")
    want = frame_rows(clean(raw_rows(*everything)))
    assert got.columns == want.columns
    assert rounded(got, *want.columns) == rounded(want, *want.columns)
    assert spark.read.parquet(late).isEmpty()

    early = clean(raw_rows(*hourly(2, start=201, city_id=1, **values), *hourly(1, start=2001, city_id=1, **values)))
    state.store_features(state.stream_features(arrive(spark, early, folder)), out, late, log)
    aside = spark.read.parquet(late).drop("batch")
    assert aside.columns == want.columns
    assert sorted(r.timestamp_utc.hour for r in aside.collect()) == [9, 10]  # hours 201 and 202, after hour 264
    assert {r[c] for r in aside.collect() for c in WINDOW_COLUMNS} == {None}
    assert spark.read.parquet(out).count() == want.count() + 1


def test_frame_statistics_against_windows(spark):
    """Every statistic over short and missing frames, in chunks of any size."""
    import numpy as np

    rng = np.random.default_rng(2)
    values = np.where(rng.random(300) < 0.3, np.nan, np.round(rng.normal(size=300), 2))
    for spec in ROLLING_24H + ROLLING_7D:
        got = state._frame(values, spec, 40)
        for i in range(40, 300):
            frame = values[max(0, i - spec.rows + 1) : i + 1]
            frame = frame[~np.isnan(frame)]
            fn = {"avg": np.mean, "sum": np.sum, "min": np.min, "max": np.max}.get(spec.fn)
            least = 2 if spec.fn in ("var", "std") else 1
            want = np.nan if len(frame) < least else fn(frame) if fn else getattr(np, spec.fn)(frame, ddof=1)
            assert np.isclose(got[i - 40], want, equal_nan=True), (spec, i)


ROWS = "city_id int, timestamp_utc timestamp_ntz, ingested_at timestamp_ntz, seq long, x double, note string"


@pytest.mark.parametrize("keep_days", [35, 0])
def test_corrections_of_any_age(spark, tmp_path, keep_days):
    """Loads with corrections of months before and with older versions, with the state kept or at once dropped."""
    folder, root, log = (str(tmp_path / n) for n in ("in", "root", "log"))
    order = ["ingested_at", "seq"]

    def rows(load):
        made = []
        for i in range(40):
            at = f"2025-{1 + i % 4:02d}-{1 + i % 9:02d} {i % 24:02d}:30:00.000{load}"[:23]
            at = at[:20] + "123" if i % 2 else at[:19]
            seen = None if (i + load) % 7 == 0 else f"2025-06-0{1 + (i * (load + 1)) % 5} 00:00:00"
            made.append((i % 3 if i % 10 else None, at, seen, 100 * load + i, float("nan") if i == 5 else i * 0.1 + load, None if i % 4 else f"ä{load}"))
        columns = "city_id int, t string, g string, seq long, x double, note string"
        return spark.createDataFrame(made, columns).selectExpr(
            "city_id", "cast(t AS timestamp_ntz) AS timestamp_utc", "cast(g AS timestamp_ntz) AS ingested_at", "seq", "x", "note"
        )

    everything = None
    for load in range(3):
        part = rows(load)
        everything = part if everything is None else everything.union(part)
        state.store_latest(arrive(spark, part, folder), root, "latest", ["city_id"], "timestamp_utc", order, log, keep_days)
    got = snapshot(spark, root).read("latest")
    want = latest_wins(everything, ["city_id", "timestamp_utc"], [F.col(c).desc_nulls_last() for c in order])
    assert got.columns == want.columns == [f.split()[0] for f in ROWS.split(", ")]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    before = snapshot(spark, root).number
    state.merge_latest(rows(0), root, "latest", ["city_id"], "timestamp_utc", order)  # a repeated batch
    assert sorted(map(str, snapshot(spark, root).read("latest").collect())) == sorted(map(str, want.collect()))
    assert snapshot(spark, root).number == before + 1


def test_series_of_a_day_share_groups(spark, tmp_path):
    """However many series there are, a day has at most so many groups; keys of several columns, null and odd ones."""
    folder, root, log = (str(tmp_path / n) for n in ("in", "root", "log"))
    rows = spark.range(600).selectExpr(
        "if(id % 50 = 7, null, int(id % 50)) AS city_id",
        "if(id % 3 = 0, null, concat('{,', id % 3)) AS name",
        "timestamp_ntz'2025-01-01' + make_dt_interval(0, int(id % 2)) AS timestamp_utc",
        "id AS seq",
    )
    state.store_latest(arrive(spark, rows, folder), root, "latest", ["city_id", "name"], "timestamp_utc", ["seq"], log)
    got = snapshot(spark, root).read("latest")
    want = latest_wins(rows, ["city_id", "name", "timestamp_utc"], [F.col("seq").desc_nulls_last()])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 100
    stored = spark.read.format("statestore").option("stateVarName", "winners").load(log)
    assert 1 < stored.count() <= state.BUCKETS


def test_winners_with_orders_of_any_size():
    """Whole numbers beyond the digits of a double, the least of all, ties, a second batch."""
    import pandas as pd

    class Kept:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Handle:
        def listTimers(self):
            return []

        def registerTimer(self, at):
            pass

    class Clock:
        def getCurrentProcessingTimeInMs(self):
            return 0

    processor = state.WinnersOfDay(["order_0", "order_1"], 0)
    processor.winners, processor.handle = Kept(), Handle()

    def take_in(*rows):
        frame = pd.DataFrame(rows, columns=["series", "at_micros", "order_0", "order_1", "payload"])
        out = list(processor.handleInputRows(None, iter([frame[:2], frame[2:]]), Clock()))
        return sorted(p for f in out for p in f["payload"])

    big, least = 2**62, -(2**63)
    assert take_in(("a", 1, big, 5, "1"), ("a", 1, big + 1, 4, "2"), ("b", 1, least, 0, "3"), ("a", 2, 0, 0, "4"), ("a", 2, 0, 0, "5")) == ["2", "3", "4"]
    assert take_in(("a", 1, big, 9, "6"), ("a", 1, big + 1, 4, "7"), ("b", 1, least, 1, "8"), ("c", 1, least, least, "9")) == ["8", "9"]
    assert take_in(("a", 1, big + 1, 5, "10"), ("b", 1, least + 1, 0, "11"), ("c", 1, least, least, "12"), ("a", 2, -1, 9, "13")) == ["10", "11"]


def test_late_rows_are_set_aside_and_added(spark, tmp_path, monkeypatch):
    folder, root, log = (str(tmp_path / n) for n in ("in", "root", "log"))
    schema = "city_id int, t string, rain_mm double, is_quality_anomaly boolean"

    def rows(*parts):
        return spark.createDataFrame(list(parts), schema).selectExpr("city_id", "cast(t AS timestamp_ntz) AS timestamp_utc", "rain_mm", "is_quality_anomaly")

    day = lambda d, *hours, rain=0.0, bad=False: [(1, f"2025-01-{d:02d} {h:02d}:00:00", rain, bad) for h in hours]
    loads = [
        rows(*day(1, 1, 2, 3), *day(2, 1), *day(5, 3)),
        rows(*day(1, 4, rain=60.0), *day(4, 9), *day(5, 2), *day(6, 1)),  # the 1st and the 4th are long over
        rows(*day(5, 23), *day(6, 2), *day(6, 3, bad=True), *day(2, 5)),
    ]
    for load in loads:
        state.count_days(arrive(spark, load, folder), root, log)
    now = snapshot(spark, root)
    assert sorted(str(r.timestamp_utc)[8:13] for r in now.read(state.LATE).collect()) == ["01 04", "02 05", "04 09"]
    assert sorted(str(r.window_start)[8:10] for r in now.read(state.CLOSED).collect()) == ["01", "02", "05"]
    counts = {str(r.window_start)[8:10]: (r.observations, r.heavy_rain_count) for r in state.counted_days(now).collect()}
    assert counts == {"01": (4, 1), "02": (2, 0), "04": (1, 0), "05": (3, 0), "06": (2, 0)}

    # a batch that failed after its commit is repeated and changes nothing; one that fails before it leaves no trace
    number = now.number
    extra = rows(*day(9, 1))
    commit = Transaction.commit
    monkeypatch.setattr(Transaction, "commit", lambda self: (commit(self), 1 / 0))
    with pytest.raises(Exception, match="division by zero"):
        state.count_days(arrive(spark, extra, folder), root, log)
    monkeypatch.setattr(Transaction, "commit", commit)
    state.count_days(spark.readStream.schema(extra.schema).parquet(folder), root, log)
    assert snapshot(spark, root).number == number + 1
    counts = {str(r.window_start)[8:10]: r.observations for r in state.counted_days(snapshot(spark, root)).collect()}
    assert counts == {"01": 4, "02": 2, "04": 1, "05": 3, "06": 2, "09": 1}
