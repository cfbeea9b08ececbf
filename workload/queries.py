"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Deviations, variances and sines are rounded, as engines add numbers in different orders.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators import checks, frames, quantiles, sketches
from almanac.operators.forest import NODES, ForestSize, grow_trees, tree_samples, with_path_score
from almanac.operators.series import profile_series
from almanac.plans import anomaly, features, marts, models, reports, silver
from almanac.schemas import BRONZE, MODEL_FEATURES, OBSERVATION
from almanac.session import materialise, shared_dir, use_utc
from almanac.sources import bronze, payloads, registry
from almanac.sources.tables import Transaction, snapshot
from almanac.streaming import refresh, state
from workload import inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

CITY = "CITY_1"
CITIES = ["CITY_1", "CITY_2", "CITY_3"]
PERIOD = reports.Selection(date(2024, 1, 20), date(2024, 1, 5), ["open_meteo"])  # inverted on purpose
BATCH = datetime(2024, 2, 1, 3, 4, 5, 6, tzinfo=UTC)


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def digits(name: str) -> int | None:
    if "_var_" in name or name.endswith(("_sin", "_cos")):
        return 9
    if "std" in name or name.endswith("zscore"):
        return 6
    return None


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, digits(c)).alias(c) if digits(c) else c for c in df.columns])


# Silver and its tests


@query
def silver_clean(spark, sf_dir):
    return inputs.silver_rows(spark, sf_dir)


@query
def silver_edge_times(spark, sf_dir):
    """Times later than any ingestion, unknown ingestions, and equal times."""
    clean = silver.clean(inputs.edge_times(spark, sf_dir), tiebreak=["ingest_seq"])
    return clean.select("city_id", "timestamp_utc", "ingested_at_utc", "humidity_pct")


@query
def quality_counts(spark, sf_dir):
    flags = ["invalid_temperature", "invalid_humidity", "invalid_rain", "invalid_wind_speed", "is_quality_anomaly"]
    return checks.rule_counts(inputs.silver_rows(spark, sf_dir), flags)


@query
def silver_checks(spark, sf_dir):
    key = ["city_id", "timestamp_utc"]
    return checks.tests_report(inputs.silver_rows(spark, sf_dir), key, key)


@query
def raw_duplicates(spark, sf_dir):
    return checks.duplicate_keys(inputs.raw_observations(spark, sf_dir), ["city_id", "timestamp"])


# Features


KEY = ["city_id", "timestamp_utc"]


def _features(spark, sf_dir, columns):
    return rounded(inputs.feature_rows(spark, sf_dir).select(*KEY, *columns))


@query
def rolling_24h(spark, sf_dir):
    return _features(spark, sf_dir, [r.name for r in features.ROLLING_24H])


@query
def rolling_7d(spark, sf_dir):
    return _features(spark, sf_dir, [r.name for r in features.ROLLING_7D])


@query
def lags(spark, sf_dir):
    return _features(spark, sf_dir, [g.name for g in features.LAGS])


@query
def seasonal_zscore(spark, sf_dir):
    scores = [c for c in MODEL_FEATURES if "city_month_hour" in c]
    return _features(spark, sf_dir, features.SEASONAL + scores)


@query
def calendar_features(spark, sf_dir):
    return _features(spark, sf_dir, features.CALENDAR)


@query
def feature_deltas(spark, sf_dir):
    changes = [c for c in MODEL_FEATURES if "delta" in c or "_vs_24h" in c or "_vs_7d" in c]
    return _features(spark, sf_dir, [*changes, "temp_range_24h", "dew_point_c"])


@query
def feature_store(spark, sf_dir):
    clean = materialise(inputs.silver_rows(spark, sf_dir), "silver")
    return rounded(features.feature_store(clean))


@query
def uneven_series_frames(spark, sf_dir):
    """Frames over a table where one series holds over a third of the rows, cut into pieces."""
    rows = materialise(inputs.uneven_series(spark, sf_dir), "series")
    specs = [
        frames.Rolling("rolling_avg_temp_24h", "temperature_c", "avg", 24),
        frames.Rolling("rolling_max_temp_7d", "temperature_c", "max", 168),
        frames.Rolling("rolling_avg_wind_7d", "wind_speed_ms", "avg", 168),
        frames.Rolling("rolling_sum_wind_7d", "wind_speed_ms", "sum", 168),
        frames.Rolling("rolling_std_wind_7d", "wind_speed_ms", "std", 168),
    ]
    back = [frames.Lag("temp_lag_2h", "temperature_c", 2)]
    profile = profile_series(rows, ["city_id"], piece_rows=500)
    framed = frames.with_frames(rows, ["city_id"], "timestamp_utc", specs, back, profile)
    return rounded(framed.drop("ingest_seq"))


# Marts


@query
def extreme_events_daily(spark, sf_dir):
    return inputs.event_rows(spark, sf_dir)


@query
def monthly_climate_delta(spark, sf_dir):
    return marts.monthly_climate_delta(inputs.silver_rows(spark, sf_dir))


@query
def monthly_yoy(spark, sf_dir):
    return marts.period_delta(
        inputs.table(spark, sf_dir, "lineitem"),
        group=["l_suppkey"],
        series=["l_suppkey"],
        time="l_shipdate",
        unit="month",
        period="ship_month",
        averages={"avg_quantity": ("l_quantity", "quantity_delta_yoy")},
        totals={"sum_quantity": "l_quantity"},
    )


# Reports


def _obs(spark, sf_dir):
    return reports.observations(inputs.feature_rows(spark, sf_dir))


def _period(spark, sf_dir):
    return reports.selected(_obs(spark, sf_dir), PERIOD)


def _city(spark, sf_dir):
    return reports.of_city(_period(spark, sf_dir), CITY)


@query
def report_rows(spark, sf_dir):
    return rounded(_obs(spark, sf_dir))


@query
def date_bounds(spark, sf_dir):
    return reports.date_bounds(_obs(spark, sf_dir))


@query
def default_period(spark, sf_dir):
    return reports.date_bounds(_obs(spark, sf_dir), days=10).select("default_start")


@query
def selector_cities(spark, sf_dir):
    return reports.selector_values(_obs(spark, sf_dir), "city_name")


@query
def selector_sources(spark, sf_dir):
    return reports.selector_values(_obs(spark, sf_dir), "source")


@query
def selected_rows(spark, sf_dir):
    return _period(spark, sf_dir).select(*KEY, reports.LOCAL_TIME, reports.LOCAL_DATE, "source")


@query
def city_kpis(spark, sf_dir):
    return reports.city_kpis(_city(spark, sf_dir))


def _stored_city(spark, sf_dir):
    """The city on the stored feature table."""
    clean = materialise(inputs.silver_rows(spark, sf_dir), "silver")
    change = Transaction(spark, shared_dir(spark, "models"))
    change.write(features.frame_rows(clean), models.FRAMES, *models.stored_under(models.FRAMES))
    return reports.StoredCity(change.commit(), CITY, PERIOD)


@query
def latest_temperature_change(spark, sf_dir):
    return _stored_city(spark, sf_dir).latest_change("temperature_c")


@query
def latest_humidity_change(spark, sf_dir):
    return reports.latest_change(_city(spark, sf_dir), "humidity_pct")


@query
def trailing_24h(spark, sf_dir):
    rows = _stored_city(spark, sf_dir).trailing_hours()
    return rows.select(reports.LOCAL_TIME, "rain_mm", "wind_speed_ms")


@query
def temperature_series(spark, sf_dir):
    return reports.temperature_series(_city(spark, sf_dir))


@query
def daily_city_summary(spark, sf_dir):
    return reports.daily_summary(_city(spark, sf_dir))


@query
def city_compare_pivot(spark, sf_dir):
    return reports.compare_cities(_period(spark, sf_dir), CITIES)


@query
def rank_avg_temp(spark, sf_dir):
    return reports.top_cities(_period(spark, sf_dir), "avg_temp_c")


@query
def rank_total_rain(spark, sf_dir):
    return reports.top_cities(_period(spark, sf_dir), "total_rain_mm")


@query
def rank_peak_wind(spark, sf_dir):
    return reports.top_cities(_period(spark, sf_dir), "peak_wind_ms")


def _period_events(spark, sf_dir):
    return reports.selected_events(inputs.event_rows(spark, sf_dir), PERIOD)


@query
def event_totals_top12(spark, sf_dir):
    return reports.event_totals(_period_events(spark, sf_dir))


@query
def city_events(spark, sf_dir):
    return reports.city_events(_period_events(spark, sf_dir), CITY)


@query
def latest_by_city(spark, sf_dir):
    return reports.latest_readings(_period(spark, sf_dir))


@query
def map_points(spark, sf_dir):
    return reports.map_points(_period(spark, sf_dir))


@query
def observation_listing(spark, sf_dir):
    return reports.observation_listing(_city(spark, sf_dir))


# Sources and sinks


@query
def registry_scan(spark, sf_dir):
    path = shared_dir(spark, "registry")
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    inputs.table(spark, sf_dir, "nation").select(
        (key + 1).alias("city_id"),
        F.col("n_name").alias("city_name"),
        (F.lit(8.0) + region * F.lit(0.5)).alias("lat"),
        (F.lit(102.0) + region * F.lit(0.25)).alias("lon"),
        (key % 6 == 0).alias("is_economic_center"),
    ).write.option("header", True).csv(path)
    return registry.read_registry(spark, path)


@query
def parse_current_payload(spark, sf_dir):
    return payloads.parse_current(inputs.current_payloads(spark, sf_dir), inputs.stations(spark, sf_dir))


@query
def parse_history_payload(spark, sf_dir):
    usable = payloads.usable_history(inputs.history_payloads(spark, sf_dir))
    return payloads.parse_history(usable, inputs.history_stations(spark, sf_dir))


@query
def unusable_history(spark, sf_dir):
    """The history responses that are set aside."""
    return payloads.unusable_history(inputs.history_payloads(spark, sf_dir)).select("city_id", "fetched_at")


@query
def history_date_range(spark, sf_dir):
    usable = payloads.usable_history(inputs.history_payloads(spark, sf_dir))
    rows = payloads.parse_history(usable, inputs.history_stations(spark, sf_dir))
    return payloads.within_dates(rows, date(2024, 1, 3), date(2024, 1, 12)).groupBy("city_id").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )


@query
def batch_completeness(spark, sf_dir):
    failed = payloads.failed_stations(
        inputs.history_stations(spark, sf_dir), inputs.history_payloads(spark, sf_dir)
    )
    return failed.select("city_id", "city_name")


@query
def current_failures(spark, sf_dir):
    """Stations without a usable current response."""
    registry = inputs.with_silent_station(inputs.stations(spark, sf_dir))
    failed = payloads.failed_current(registry, inputs.broken_current_payloads(spark, sf_dir))
    return failed.select("city_id", "city_name")


def _observations_of(raw: DataFrame, source: str) -> DataFrame:
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in OBSERVATION.fields]
    return raw.filter(F.col("source") == source).select(*typed)


@query
def bronze_roundtrip(spark, sf_dir):
    """Two batches appended to a lake and read back, path keys included."""
    root = shared_dir(spark, "lake")
    raw = inputs.raw_observations(spark, sf_dir)
    for source in ("open_meteo", "openweather"):
        bronze.write_bronze(_observations_of(raw, source), root, source, BATCH)
    bronze.write_bronze(_observations_of(raw, "nobody"), root, "nobody", BATCH)  # empty: no file
    return bronze.read_bronze(spark, root)


@query
def bronze_mixed_types(spark, sf_dir):
    """A lake of other writers: whole-number humidity and no condition here, doubles and text there."""
    root = shared_dir(spark, "lake")
    raw = inputs.raw_observations(spark, sf_dir)
    whole = raw.filter("source = 'open_meteo'").drop("weather_condition", "ingest_seq", "ingested_at", "source")
    exact = raw.filter("source = 'openweather'").drop("ingest_seq", "source")
    exact = exact.withColumns({c: F.col(c).try_cast("double") for c in ("temperature", "humidity", "pressure")})
    for source, day, rows in (("open_meteo", "02", whole), ("openweather", "03", exact)):
        rows.write.parquet(f"{root}/{bronze.FOLDER}/source={source}/year=2024/month=02/day={day}")
    columns = [f.name for f in BRONZE.fields if not f.name.startswith("ing")]
    return bronze.read_bronze(spark, root).select(*columns, "year", "month", "day")


def _model_rows(built: models.Models) -> DataFrame:
    """The rows of all four tables under each other: key, time, and four of their numbers."""
    chosen = {
        "silver": (built.silver, "timestamp_utc", ["temperature_c", "humidity_pct", "rain_mm", "wind_speed_ms"]),
        "features": (
            built.features,
            "timestamp_utc",
            ["temp_lag_2h", "rolling_avg_temp_7d", "rolling_std_wind_7d", "rain_city_month_hour_zscore"],
        ),
        "events": (
            built.events,
            "observed_date",
            ["extreme_event_count", "high_wind_count", "max_temperature_c", "total_rain_mm"],
        ),
        "monthly": (
            built.monthly,
            "observed_month",
            ["avg_temp_c", "temp_delta_yoy_c", "humidity_delta_yoy_pct", "total_rain_mm"],
        ),
    }
    parts = [
        df.select(
            F.lit(name).alias("model"),
            "city_id",
            F.col(time).cast("timestamp_ntz").alias("at"),
            *[F.round(F.col(c).cast("double"), 6).alias(n) for c, n in zip(columns, "abcd", strict=True)],
        )
        for name, (df, time, columns) in chosen.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def refreshed_models(spark, sf_dir):
    """Lake to model tables, stored and read back."""
    lake, root = shared_dir(spark, "lake"), shared_dir(spark, "models")
    raw = inputs.raw_observations(spark, sf_dir)
    for source in ("open_meteo", "openweather"):
        bronze.write_bronze(_observations_of(raw, source), lake, source, BATCH)
    models.refresh_from_lake(spark, lake, root)
    return _model_rows(models.load_models(spark, root))


# Anomaly model


@query
def exact_quantiles(spark, sf_dir):
    wanted = {"l_extendedprice": 0.5, "l_quantity": 0.03, "l_discount": 0.97, "l_tax": 0.5}
    lineitem = inputs.table(spark, sf_dir, "lineitem").select(*wanted)
    return quantiles.quantile_table(lineitem, wanted, direct_rows=1000)


@query
def quantiles_from_sketches(spark, sf_dir):
    """Exact quantiles from a counting pass between values that stored sketches of the months give."""
    wanted = {"l_extendedprice": 0.5, "l_quantity": 0.03, "l_discount": 0.97, "l_tax": 0.5}
    lineitem = inputs.table(spark, sf_dir, "lineitem").select("l_shipdate", *wanted)
    stored = anomaly.store_sketches(lineitem, shared_dir(spark, "sketches"), "l_shipdate", list(wanted))
    return quantiles.quantile_table(lineitem, wanted, direct_rows=1000, hints=sketches.brackets(stored, wanted))


def _stats(df):
    return anomaly.impute_scale_stats(df, MODEL_FEATURES)


@query
def impute_scale_stats(spark, sf_dir):
    stats = _stats(inputs.stored_features(spark, sf_dir))
    table = spark.createDataFrame(stats, anomaly.STATS_SCHEMA)
    return table.select("feature", *[F.round(c, 6).alias(c) for c in ("median", "mean", "std")])


@query
def impute_scale_apply(spark, sf_dir):
    df = inputs.stored_features(spark, sf_dir)
    scaled = anomaly.impute_scale(df, _stats(df))
    used = ["temperature_c", "temp_lag_2h", "rolling_std_temp_24h", "rain_city_month_hour_zscore", "is_weekend"]
    return scaled.select(*KEY, *[F.round(c, 6).alias(c) for c in used])


@query
def missing_features(spark, sf_dir):
    """Model inputs that the silver table lacks."""
    return checks.missing_columns(inputs.silver_rows(spark, sf_dir), MODEL_FEATURES)


def _forest(spark, sf_dir):
    """The fitted model, the same stored and read back, and the folder."""
    fitted = anomaly.fit_anomaly(inputs.stored_features(spark, sf_dir), keep_scores=True)
    root = shared_dir(spark, "model")
    anomaly.save_model(fitted, root)
    return fitted, anomaly.load_model(spark, root), root


@query
def iforest_scores(spark, sf_dir):
    """The stored table of scored rows: every row's score and flag."""
    fitted, _, root = _forest(spark, sf_dir)
    scored = anomaly.store_scores_of_fit(fitted, root)
    return scored.select(*KEY, F.round("anomaly_score", 9).alias("anomaly_score"), "is_anomaly")


@query
def iforest_shape(spark, sf_dir):
    """Per tree: rows at the root, rows in its leaves, and its depth."""
    _, model, _ = _forest(spark, sf_dir)
    return model.nodes.groupBy("tree").agg(
        F.max(F.when(F.col("node") == 0, F.col("size"))).cast("long").alias("root_rows"),
        F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("leaf_rows"),
        F.max("depth").cast("long").alias("depth"),
    )


@query
def iforest_draw(spark, sf_dir):
    """The rows that 20 small trees draw."""
    df = inputs.stored_features(spark, sf_dir)
    size = ForestSize(trees=20, sample=32)
    return tree_samples(df.select(*KEY), KEY, df.count(), size, []).select("tree", *KEY, "_rank").withColumnRenamed("_rank", "place")


GROWN = ["temperature_c", "humidity_pct", "rain_mm", "is_weekend", "temp_lag_2h"]


@query
def iforest_grow(spark, sf_dir):
    """The nodes of 20 small trees over five inputs, one of which mostly does not vary within a node."""
    df = inputs.stored_features(spark, sf_dir)
    size = ForestSize(trees=20, sample=32)
    values = F.array(*[F.coalesce(quantiles.known(c), F.lit(0.0)) for c in GROWN])
    samples = tree_samples(df.select(*KEY, values.alias("x")), KEY, df.count(), size, ["x"])
    return grow_trees(samples, "x", [1.0] * len(GROWN), size, size.sample).withColumn("threshold", F.round("threshold", 9))


# Two trees over (temperature_c, humidity_pct, rain_mm), as (tree, node, feature, threshold, size, depth).
SMALL_TREES = [
    (0, 0, 0, 10.5, 8, 0), (0, 1, 2, 2.0, 5, 1), (0, 2, -1, 0.0, 3, 1), (0, 3, -1, 0.0, 4, 2), (0, 4, -1, 0.0, 1, 2),
    (1, 0, 1, 50.0, 8, 0), (1, 1, -1, 0.0, 2, 1), (1, 2, 0, 20.25, 6, 1), (1, 5, -1, 0.0, 5, 2), (1, 6, -1, 0.0, 1, 2),
]


def _small_scores(spark, sf_dir):
    nodes = spark.createDataFrame(SMALL_TREES, NODES)
    size = ForestSize(trees=2, sample=4)
    inputs_ = [F.coalesce(quantiles.known(c), F.lit(0.0)) for c in ("temperature_c", "humidity_pct", "rain_mm")]
    scored = with_path_score(inputs.stored_features(spark, sf_dir), nodes, inputs_, size, 4, "score")
    return scored.select(*KEY, F.round("score", 9).alias("score"))


@query
def iforest_apply(spark, sf_dir):
    """Scores from a small, given node table."""
    return _small_scores(spark, sf_dir)


@query
def iforest_offset_flags(spark, sf_dir):
    """The offset that flags the wanted share, and the flags, on given scores."""
    scores = materialise(_small_scores(spark, sf_dir), "scores")
    offset = quantiles.exact_quantiles(scores, {"score": anomaly.CONTAMINATION})["score"]
    return scores.select(*KEY, F.round(F.lit(offset), 9).alias("offset"), (F.col("score") < F.lit(offset)).alias("is_anomaly"))


# Refresh and streams


def _arriving(spark, folder, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def _refreshed(spark, raw: DataFrame, loads: list) -> models.Models:
    """Raw rows arrive in a lake in several loads, with whole numbers as long integers in the last one."""
    lake, root, log = (shared_dir(spark, n) for n in ("lake", "models", "checkpoint"))
    read = partial(bronze.read_files, extra=["ingest_seq"])
    for i, part in enumerate(loads):
        rows = raw.filter(part)
        if i == len(loads) - 1:
            rows = rows.withColumns({c: F.col(c).cast("long") for c in ("city_id", "humidity", "pressure")})
        rows.write.mode("append").partitionBy("source").parquet(f"{lake}/{bronze.FOLDER}")
        refresh.refresh_arrived(spark, lake, root, log, ["ingest_seq"], read=read)
    return models.load_models(spark, root)


@query
def incremental_refresh(spark, sf_dir):
    """Events after two loads."""
    raw = inputs.raw_observations(spark, sf_dir)
    return _refreshed(spark, raw, [F.expr("ingest_seq % 2 = 0"), F.expr("ingest_seq % 2 = 1")]).events


@query
def incremental_tables(spark, sf_dir):
    """All tables after three loads over more than a year; the last has corrections and new rows of two months only."""
    raw = inputs.raw_observations(spark, sf_dir, spread=True)
    late = F.expr("ingest_seq % 15 in (4, 9) and ingest_seq % 4 = 1")
    first = F.expr("ingest_seq % 15 < 8")
    return _model_rows(_refreshed(spark, raw, [first & ~late, ~first & ~late, late]))


@query
def monthly_climate_years(spark, sf_dir):
    """Monthly change over more than twelve months."""
    raw = inputs.raw_observations(spark, sf_dir, spread=True)
    return marts.monthly_climate_delta(silver.clean(raw, tiebreak=["ingest_seq"]))


def _many_cities(spark, sf_dir):
    clean = materialise(silver.clean(inputs.raw_observations(spark, sf_dir, spread=True), ["ingest_seq"]), "silver")
    return features.feature_store(clean)


@query
def rank_many_cities(spark, sf_dir):
    """The ten wettest of more than ten cities."""
    return reports.top_cities(reports.observations(_many_cities(spark, sf_dir)), "total_rain_mm")


@query
def event_totals_many_cities(spark, sf_dir):
    """The twelve cities with the most events, of more than twelve."""
    return reports.event_totals(marts.extreme_events_daily(_many_cities(spark, sf_dir)))


PARTS = 3


def _part_of(rows: DataFrame, time: str, seq: str) -> DataFrame:
    """``rows`` with the load they arrive in: by thirds of the days, but for a seventh, which comes a load later."""
    days = rows.agg(F.min(time).alias("first"), F.max(time).alias("last")).first()
    cuts = [days.first + (days.last - days.first) * p / PARTS for p in range(1, PARTS)]
    third = sum((F.col(time) >= F.lit(cut)).cast("int") for cut in cuts)
    return rows.withColumn("part", F.least(third + (F.col(seq) % 7 == 3).cast("int"), F.lit(PARTS - 1)))


def _loads(spark, rows: DataFrame, name: str):
    """Each load written and streamed, one after the other, into one folder: yields the stream of all its files."""
    folder, stored = shared_dir(spark, name), materialise(rows, name)
    for part in range(PARTS):
        stored.filter(F.col("part") == part).drop("part").write.mode("append").parquet(folder)
        yield _arriving(spark, folder, stored.drop("part").schema, files=1000)


def _silver_loads(spark, sf_dir):
    raw = inputs.raw_observations(spark, sf_dir)
    clean = silver.clean(raw, tiebreak=["ingest_seq"], keep=["ingest_seq"])
    return _part_of(materialise(clean, "silver"), "timestamp_utc", "ingest_seq").drop("ingest_seq")


@query
def stream_daily_counts(spark, sf_dir):
    """Valid readings per station and day from three loads, some rows days behind the watermark of theirs."""
    root, log = shared_dir(spark, "daily"), shared_dir(spark, "checkpoint")
    for arriving in _loads(spark, _silver_loads(spark, sf_dir), "silver"):
        state.count_days(arriving, root, log)
    return state.counted_days(snapshot(spark, root))


@query
def stream_latest_wins(spark, sf_dir):
    """The latest row per station and time from three loads, later ones with corrections of any age."""
    root, log = shared_dir(spark, "latest"), shared_dir(spark, "checkpoint")
    raw = inputs.raw_observations(spark, sf_dir)
    rows = raw.select(
        "city_id",
        F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp_utc"),
        "ingested_at",
        "ingest_seq",
        "weather_condition",
    ).dropna(subset=["city_id", "timestamp_utc"])
    rows = _part_of(materialise(rows, "rows"), "timestamp_utc", "ingest_seq")
    order = ["ingested_at", "ingest_seq"]
    state.use_keyed_state(spark)
    for arriving in _loads(spark, rows, "rows"):
        state.store_latest(arriving, root, "latest", ["city_id"], "timestamp_utc", order, log)
    return snapshot(spark, root).read("latest")


@query
def stream_features(spark, sf_dir):
    """Frames and lags of arriving rows in order, from three loads with a restart before each."""
    out, late, log = (shared_dir(spark, n) for n in ("frames", "late", "checkpoint"))
    rows = materialise(inputs.silver_rows(spark, sf_dir), "silver").withColumn("seq", F.lit(0))
    state.use_keyed_state(spark)
    for arriving in _loads(spark, _part_of(rows, "timestamp_utc", "seq").drop("seq"), "silver"):
        framed = state.stream_features(arriving)
        state.store_features(framed, out, late, log)
    stored = spark.read.schema(framed.drop("in_order").schema).option("recursiveFileLookup", True).parquet(out)
    return rounded(stored.select(*KEY, *features.WINDOW_COLUMNS))


@query
def quality_while_writing(spark, sf_dir):
    """Outcomes of the quality rules, counted while silver was written, by a full build and by a load of corrections."""
    root = shared_dir(spark, "models")
    raw = inputs.raw_observations(spark, sf_dir)
    late = F.expr("ingest_seq % 9 = 4")
    models.build_models(raw.filter(~late), root, ["ingest_seq"])
    refresh.refresh_rows(raw.filter(late), root, ["ingest_seq"])
    return models.quality_report(snapshot(spark, root))
