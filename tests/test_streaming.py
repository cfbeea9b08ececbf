from datetime import date

import pytest
from pyspark.sql import functions as F
from rows import hourly

from almanac.plans import models, reports
from almanac.plans.models import build_models
from almanac.sources import bronze, tables
from almanac.streaming import refresh, windows


def as_set(df):
    return sorted(map(str, df.collect()))


LATER = "2026-02-01T00:00:00+00:00"


def compare(spark, root, full):
    built = models.load_models(spark, root)
    for name in ("silver", "features", "events", "monthly"):
        got, want = getattr(built, name), getattr(full, name)
        assert got.columns == want.columns
        digits = [F.round(c, 9).alias(c) if dict(got.dtypes)[c] == "double" else F.col(c) for c in got.columns]
        assert as_set(got.select(*digits)) == as_set(want.select(*digits)), name


def test_refresh_equals_full_rebuild(spark, raw_rows, tmp_path):
    """Old corrections included, one of which removes a station's only event; files of other types, too."""
    lake, root, log = (str(tmp_path / n) for n in ("lake", "models", "log"))
    wet = {3: "60"}
    year = hourly(24 * 3, start=28 * 24 * 11, city_id=2, ingested_at=LATER)  # December
    loads = [
        hourly(700, rain=lambda i: wet.get(i, "0"), city_id=1) + hourly(30, rain=lambda i: wet.get(i, "0"), city_id=2),
        [{"timestamp": "2025-01-01T03:00", "rain": "1", "city_id": 2, "ingested_at": "2025-03-01T00:00:00+00:00"}],
        hourly(10, start=700, city_id=3) + year,
        [{"timestamp": "2024-12-31T23:00", "temperature": "99", "city_id": 1}],
        [{"timestamp": "2024-12-31T23:00", "temperature": "9", "city_id": 1, "ingested_at": "2025-03-01T00:00:00+00:00"}],
    ]
    everything, events = [], []
    for n, load in enumerate(loads):
        rows = raw_rows(*load)
        if n == 2:
            rows = rows.withColumn("city_id", F.col("city_id").cast("long"))
        rows.drop("source").write.parquet(f"{lake}/{bronze.FOLDER}/source=s{n}")
        everything += load
        refresh.refresh_arrived(spark, lake, root, log)
        events.append(models.load_models(spark, root).events.count())
    assert events[:3] == [2, 1, 1]
    full = build_models(bronze.read_bronze(spark, lake), str(tmp_path / "full"))
    compare(spark, root, full)


def test_a_load_rewrites_only_what_it_touches(spark, raw_rows, tmp_path):
    """A correction in March of one year: its month, the next one, which its frames reach, and no other year's March."""
    root = str(tmp_path / "models")
    rows = [r for m in range(1, 8) for r in hourly(200, start=28 * 24 * (m - 1), ingested_at=LATER)]
    rows += [r | {"timestamp": r["timestamp"].replace("2025", "2024")} for r in rows]
    models.build_models(raw_rows(*rows), root)
    before = tables.snapshot(spark, root).tables
    late = {"timestamp": "2025-03-02T05:30", "rain": "70", "ingested_at": LATER}
    refresh.refresh_rows(raw_rows(late), root)
    after = tables.snapshot(spark, root).tables
    for name in models.LAYOUT:
        changed = sorted(m for m, v in after[name].parts.items() if before[name].parts.get(m) != v)
        reached = ["2025-03", "2025-04"] if name == models.FRAMES else ["2025-03"]
        assert changed == reached, name  # no event follows in April
    full = build_models(raw_rows(*rows, late), str(tmp_path / "full"))
    compare(spark, root, full)


def test_refreshing_twice_changes_nothing(spark, raw_rows, tmp_path):
    raw = raw_rows(*hourly(30, rain="55"))
    for _ in range(2):
        refresh.refresh_rows(raw, str(tmp_path), ["seq"])
    assert models.load_models(spark, str(tmp_path)).silver.count() == 30
    refresh.refresh_rows(raw.limit(0), str(tmp_path), ["seq"])
    assert models.load_models(spark, str(tmp_path)).silver.count() == 30


def test_stored_selection_reads_wanted_months_only(spark, raw_rows, tmp_path):
    rows = [r for m in range(1, 5) for r in hourly(48, start=28 * 24 * (m - 1), ingested_at=LATER)]
    built = models.build_models(raw_rows(*rows), str(tmp_path))
    period = reports.Selection(date(2025, 2, 1), date(2025, 2, 20))
    stored = reports.stored_selection(spark, str(tmp_path), period)
    assert as_set(stored) == as_set(reports.selected(reports.observations(built.features), period))
    assert {f.split("stored_month=")[1][:7] for f in stored.inputFiles()} == {"2025-01", "2025-02"}


def test_streams_hold_back_open_windows(spark, tmp_path):
    rows = [(1, f"2025-01-0{d} {h:02d}:00:00", float(h), h) for d in (1, 2, 3) for h in range(24)]
    rows += [(1, "2025-01-01 05:00:00", 99.0, 50)]
    df = spark.createDataFrame(rows, "city_id int, t string, rain_mm double, seq int").selectExpr(
        "city_id", "cast(t AS timestamp_ntz) AS timestamp_utc", "rain_mm", "seq", "t = '2025-01-02 07:00:00' AS is_quality_anomaly"
    )
    folder = str(tmp_path / "rows")
    df.coalesce(1).write.parquet(folder)

    def arriving():
        return spark.readStream.schema(df.schema).parquet(folder)

    windows.store_stream(windows.daily_event_counts(arriving()), str(tmp_path / "a"), str(tmp_path / "al"))
    days = spark.read.parquet(str(tmp_path / "a")).orderBy("window_start").collect()
    assert [(r.observations, r.heavy_rain_count) for r in days] == [(25, 1), (23, 0)]
    tail = windows.daily_counts_tail(df, spark.read.parquet(str(tmp_path / "a"))).collect()
    assert [(str(r.window_start), r.observations) for r in tail] == [("2025-01-03 00:00:00", 24)]

    latest = windows.latest_wins_stream(arriving(), ["city_id"], "timestamp_utc", ["seq"])
    windows.store_stream(latest, str(tmp_path / "b"), str(tmp_path / "bl"))
    got = spark.read.schema(df.schema).parquet(str(tmp_path / "b"))
    assert got.count() == 70  # the last two hours stay open
    assert got.filter("rain_mm = 99").count() == 1
    tail = windows.latest_wins_tail(df, got, ["city_id"], "timestamp_utc", ["seq"])
    assert sorted(r.timestamp_utc.hour for r in tail.collect()) == [22, 23]
