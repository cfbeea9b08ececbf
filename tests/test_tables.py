"""Stored tables: transactions, readers and writers at the same time, what is counted on the way."""

import threading
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import hourly

from almanac.operators import checks
from almanac.plans import models
from almanac.sources import tables
from almanac.sources.tables import ConcurrentWrite, Transaction, month_of, remove_unused, snapshot
from almanac.streaming import refresh

DAY = "observed_date"
LATER = "2026-02-01T00:00:00+00:00"


def dated(spark, *rows):
    return spark.createDataFrame([(i, d) for i, d in rows], "id long, d string").select("id", F.to_date("d").alias(DAY))


def ids(df):
    return sorted(r.id for r in df.collect())


def write(change, df, name="t"):
    return change.write(df, name, month_of(DAY), ["id"])


def replace(change, df, months, name="t"):
    return change.replace_months(df, name, month_of(DAY), months, ["id"])


def test_nothing_shows_before_the_commit(spark, tmp_path):
    root = str(tmp_path)
    assert not tables.exists(spark, root, "t")
    change = Transaction(spark, root)
    write(change, dated(spark, (1, "2025-01-05"), (2, "2025-02-05")))
    assert ids(change.read("t")) == [1, 2]  # its own writes
    assert not snapshot(spark, root).has("t")
    change.commit()
    old = snapshot(spark, root)
    change = Transaction(spark, root)
    replace(change, dated(spark, (3, "2025-02-07")), ["2025-02"])
    write(change, dated(spark, (9, "2025-01-01")), "u")
    assert ids(snapshot(spark, root).read("t")) == [1, 2] and not snapshot(spark, root).has("u")
    change.commit()
    assert ids(snapshot(spark, root).read("t")) == [1, 3] and ids(snapshot(spark, root).read("u")) == [9]
    assert ids(old.read("t")) == [1, 2]  # a reader keeps the state it has opened
    assert snapshot(spark, root).read("t").columns == ["id", DAY]


def test_second_of_two_writers_fails_cleanly(spark, tmp_path):
    root = str(tmp_path)
    write(first := Transaction(spark, root), dated(spark, (1, "2025-01-05")))
    write(second := Transaction(spark, root), dated(spark, (2, "2025-01-05")))
    second.commit()
    with pytest.raises(ConcurrentWrite):
        first.commit()
    assert ids(tables.read_table(spark, root, "t")) == [2]
    write(again := Transaction(spark, root), dated(spark, (1, "2025-01-05")))
    again.commit()
    assert ids(tables.read_table(spark, root, "t")) == [1]


def test_many_writers_at_once(spark, tmp_path):
    """Each month of the table is written by a thread that tries until it wins; none loses another's month."""
    root = str(tmp_path)
    write(change := Transaction(spark, root), dated(spark, (0, "2025-01-05")))
    change.commit()

    def work(month):
        while True:
            change = Transaction(spark, root)
            replace(change, dated(spark, (month, f"2025-{month:02d}-01")), [f"2025-{month:02d}"])
            try:
                change.commit()
                return
            except ConcurrentWrite:
                pass

    threads = [threading.Thread(target=work, args=(m,)) for m in range(2, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert ids(tables.read_table(spark, root, "t")) == [0, 2, 3, 4, 5, 6]


def test_failed_write_keeps_the_table(spark, tmp_path):
    root = str(tmp_path)
    good = dated(spark, (1, "2025-01-01"), (2, "2025-01-02"))
    tables.write_table(good, root, "t", DAY, ["id"])
    bad = good.withColumn("id", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        tables.write_table(bad, root, "t", DAY, ["id"])
    assert ids(tables.read_table(spark, root, "t")) == [1, 2]
    (tmp_path / tables.MANIFESTS / ".000000000002.json-crashed").write_text("{")  # of a writer that died
    assert ids(tables.read_table(spark, root, "t")) == [1, 2]
    tables.write_table(good.limit(0), root, "t", DAY, ["id"])
    assert tables.read_table(spark, root, "t").count() == 0
    assert tables.read_table(spark, root, "t").columns == ["id", DAY]


def test_replaced_months(spark, tmp_path):
    root = str(tmp_path)
    write(change := Transaction(spark, root), dated(spark, (1, "2025-01-05"), (2, "2025-02-05"), (3, "2025-03-05")))
    replace(change, dated(spark, (4, "2025-01-09")), ["2025-01", "2025-02"])  # February has none any more
    state = change.commit()
    assert state.months("t") == ["2025-01", "2025-03"] and ids(state.read("t")) == [3, 4]
    assert ids(state.read("t", ["2025-03"])) == [3] and ids(state.read("t", ["2024-03"])) == []
    with pytest.raises(ValueError, match="other months"):
        replace(Transaction(spark, root), dated(spark, (5, "2025-05-01")), ["2025-04"])
    with pytest.raises(ValueError, match="another type"):
        replace(Transaction(spark, root), dated(spark, (5, "2025-05-01")).withColumn("id", F.lit("x")), ["2025-05"])


def test_only_wanted_folders_are_read(spark, tmp_path):
    root = str(tmp_path)
    rows = [(m, f"2025-{m:02d}-05") for m in range(1, 10)]
    write(change := Transaction(spark, root), dated(spark, *rows))
    state = change.commit()
    assert {f.split("stored_month=")[1][:7] for f in state.read("t", ["2025-02", "2025-07"]).inputFiles()} == {"2025-02", "2025-07"}


def test_unused_versions_are_removed(spark, tmp_path):
    root = str(tmp_path)
    write(change := Transaction(spark, root), dated(spark, (1, "2025-01-05"), (2, "2025-02-05")))
    change.commit()
    replace(change := Transaction(spark, root), dated(spark, (3, "2025-02-05")), ["2025-02"])
    old = snapshot(spark, root)
    change.commit()
    write(abandoned := Transaction(spark, root), dated(spark, (8, "2025-02-05")))
    versions = lambda: {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()}
    before = versions()
    remove_unused(spark, root, datetime.now(UTC) - timedelta(hours=1))
    assert versions() == before and ids(old.read("t")) == [1, 2]
    remove_unused(spark, root, datetime.now(UTC) + timedelta(hours=1))
    assert len(versions()) == 2  # January's rows still lie in the first version
    assert ids(tables.read_table(spark, root, "t")) == [1, 3]
    assert abandoned.number == 2 and snapshot(spark, root).number == 2


def test_counted_on_the_way(spark, tmp_path):
    """Also where a stage of the write runs more than once, and for no rows at all."""
    root = str(tmp_path)
    counted = {"n": F.count("*"), "odd": F.count_if(F.col("id") % 2 == 1)}
    rows = spark.range(1000).withColumn(DAY, F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 300).cast("int")))
    assert Transaction(spark, root).write(rows, "t", month_of(DAY), ["id"], counted) == {"n": 1000, "odd": 500}
    grouped = rows.groupBy("id", DAY).agg(F.count("*").alias("c"))
    assert Transaction(spark, root).write(grouped, "t", None, ["id"], counted) == {"n": 1000, "odd": 500}
    assert Transaction(spark, root).write(rows.limit(0), "t", month_of(DAY), ["id"], counted) == {"n": 0, "odd": 0}


def test_quality_report_follows_refreshes(spark, raw_rows, tmp_path):
    """Counters kept in the manifest equal a scan, after a full build and after corrections."""
    root = str(tmp_path)

    def report(df):
        return sorted(map(tuple, df.collect()))

    flags = ["invalid_temperature", "invalid_humidity", "invalid_rain", "invalid_wind_speed", "is_quality_anomaly"]
    loads = [
        hourly(50, temperature=lambda i: "99" if i % 7 == 0 else "20", humidity=lambda i: None if i % 5 == 0 else 50.0),
        [{"timestamp": "2025-01-01T07:00", "temperature": "21", "ingested_at": LATER}],
        hourly(9, start=28 * 24 * 2, wind_speed=90.0, ingested_at=LATER),
    ]
    for load in loads:
        refresh.refresh_rows(raw_rows(*load), root)
        state = snapshot(spark, root)
        assert report(models.quality_report(state)) == report(checks.rule_counts(state.read(models.SILVER), flags))
    assert ("invalid_temperature", 7, 52, 0) in report(models.quality_report(state))


def test_a_failed_check_leaves_the_old_state(spark, raw_rows, tmp_path, monkeypatch):
    """Also a crash before the last of the tables is written: readers see the old rows of all of them."""
    root = str(tmp_path)
    models.build_models(raw_rows(*hourly(30)), root)

    def crash(*_):
        raise RuntimeError("stopped between two writes")

    late = raw_rows({"timestamp": "2025-01-01T05:00", "rain": "70", "ingested_at": LATER})
    for name in ("seasonal_cells", "extreme_events_daily", "refuse_nulls"):
        with monkeypatch.context() as patch:
            patch.setattr(refresh, name, crash)
            with pytest.raises(RuntimeError, match="between"):
                refresh.refresh_rows(late, root)
        built = models.load_models(spark, root)
        assert built.silver.filter("rain_mm = 70").isEmpty() and built.events.isEmpty()
    with monkeypatch.context() as patch:
        patch.setattr(models, "quality_counters", lambda: {"city_id_missing": F.count("*"), "timestamp_utc_missing": F.count("*")})
        with pytest.raises(ValueError, match="city_id"):
            models.build_models(late, root)
    assert models.load_models(spark, root).silver.count() == 30
    refresh.refresh_rows(late, root)
    assert models.load_models(spark, root).events.count() == 1
