"""DuckDB SQL for the registered queries, over the driver's tables."""

from __future__ import annotations

import math

from almanac.schemas import MODEL_FEATURES
from workload.queries import GROWN, digits

RAW = """
numbered AS (
    SELECT *, CAST(user_id // 15 AS INTEGER) AS station,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CAST(floor(value) AS DOUBLE) AS whole
    FROM events
),
raw AS (
    SELECT
        CASE WHEN event_id % 89 = 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%dT%H:00') END AS "timestamp",
        CASE WHEN event_id % 97 <> 0 THEN station + 1 END AS city_id,
        'CITY_' || CAST(station + 1 AS VARCHAR) AS city_name,
        CAST(8 + (station % 10) * 0.5 AS DOUBLE) AS lat,
        CAST(102 + (station % 10) * 0.25 AS DOUBLE) AS lon,
        CASE WHEN event_id % 29 = 0 THEN 'bad' ELSE CAST(CAST(k * 0.75 - 12 AS DOUBLE) AS VARCHAR) END AS temperature,
        CASE WHEN event_id % 13 <> 0 THEN event_id % 107 - 2 END AS humidity,
        990 + event_id % 41 AS pressure,
        whole * CAST(0.25 AS DOUBLE) AS wind_speed,
        CASE WHEN k % 5 = 0 THEN whole * 3 WHEN k % 5 = 1 THEN NULL
             WHEN k % 5 = 2 AND value < 5 THEN -1 ELSE 0 END AS rain,
        event_type AS weather_condition,
        CASE WHEN event_type = 'error' THEN 'openweather' ELSE 'open_meteo' END AS source,
        CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 101 = 0 THEN ts - INTERVAL 2 HOUR ELSE ts END AS ingested_at,
        event_id AS ingest_seq
    FROM numbered
)"""

SILVER = (
    RAW
    + """,
typed AS (
    SELECT CAST(city_id AS INTEGER) AS city_id, city_name, lat, lon,
           TRY_CAST("timestamp" AS TIMESTAMP) AS timestamp_utc,
           TRY_CAST(temperature AS DOUBLE) AS temperature_c,
           TRY_CAST(humidity AS DOUBLE) AS humidity_pct,
           TRY_CAST(pressure AS DOUBLE) AS pressure_hpa,
           TRY_CAST(wind_speed AS DOUBLE) AS wind_speed_ms,
           COALESCE(TRY_CAST(rain AS DOUBLE), CAST(0 AS DOUBLE)) AS rain_mm,
           weather_condition, source, ingested_at AS ingested_at_utc, ingest_seq
    FROM raw
),
silver AS (
    SELECT city_id, city_name, lat, lon, timestamp_utc,
           CAST(date_trunc('hour', timestamp_utc) AS TIMESTAMP) AS observed_hour_utc,
           CAST(timestamp_utc AS DATE) AS observed_date,
           temperature_c, humidity_pct, pressure_hpa, wind_speed_ms, rain_mm, weather_condition, source, ingested_at_utc,
           (temperature_c < -10 OR temperature_c > 60) AS invalid_temperature,
           (humidity_pct < 0 OR humidity_pct > 100) AS invalid_humidity,
           (rain_mm < 0 OR rain_mm > 1000) AS invalid_rain,
           (wind_speed_ms < 0 OR wind_speed_ms > 80) AS invalid_wind_speed,
           (temperature_c < -10 OR temperature_c > 60 OR humidity_pct < 0 OR humidity_pct > 100
            OR rain_mm < 0 OR rain_mm > 1000 OR wind_speed_ms < 0 OR wind_speed_ms > 80) AS is_quality_anomaly
    FROM typed
    WHERE city_id IS NOT NULL AND timestamp_utc IS NOT NULL
      AND (ingested_at_utc IS NULL OR timestamp_utc <= ingested_at_utc)
    QUALIFY row_number() OVER (PARTITION BY city_id, timestamp_utc
                               ORDER BY ingested_at_utc DESC NULLS LAST, ingest_seq DESC) = 1
)"""
)

MEASURES = {
    "temp": "temperature_c",
    "humidity": "humidity_pct",
    "pressure": "pressure_hpa",
    "wind": "wind_speed_ms",
    "rain": "rain_mm",
}


def _seasonal() -> str:
    return ",\n           ".join(
        f"avg({c}) OVER cell AS city_month_hour_avg_{s}, stddev_samp({c}) OVER cell AS city_month_hour_std_{s}"
        for s, c in MEASURES.items()
    )


def _zscores() -> str:
    return ",\n           ".join(
        f"({c} - city_month_hour_avg_{s}) / nullif(city_month_hour_std_{s}, 0) AS {s}_city_month_hour_zscore"
        for s, c in MEASURES.items()
    )


FEATURES = (
    SILVER
    + f""",
framed AS (
    SELECT city_id, city_name, lat, lon, timestamp_utc, observed_hour_utc, observed_date,
           temperature_c, humidity_pct, pressure_hpa, wind_speed_ms, rain_mm, weather_condition, source,
           avg(temperature_c) OVER d AS rolling_avg_temp_24h,
           min(temperature_c) OVER d AS rolling_min_temp_24h,
           max(temperature_c) OVER d AS rolling_max_temp_24h,
           stddev_samp(temperature_c) OVER d AS rolling_std_temp_24h,
           var_samp(temperature_c) OVER d AS rolling_var_temp_24h,
           avg(temperature_c) OVER w AS rolling_avg_temp_7d,
           stddev_samp(temperature_c) OVER w AS rolling_std_temp_7d,
           lag(temperature_c, 1) OVER s AS temp_lag_1h,
           lag(temperature_c, 2) OVER s AS temp_lag_2h,
           lag(humidity_pct, 1) OVER s AS humidity_lag_1h,
           lag(pressure_hpa, 1) OVER s AS pressure_lag_1h,
           lag(wind_speed_ms, 1) OVER s AS wind_lag_1h,
           avg(humidity_pct) OVER d AS rolling_avg_humidity_24h,
           avg(pressure_hpa) OVER d AS rolling_avg_pressure_24h,
           avg(rain_mm) OVER d AS rolling_avg_rain_24h,
           sum(rain_mm) OVER d AS rolling_sum_rain_24h,
           max(rain_mm) OVER d AS rolling_max_rain_24h,
           avg(wind_speed_ms) OVER w AS rolling_avg_wind_7d,
           stddev_samp(wind_speed_ms) OVER w AS rolling_std_wind_7d,
           CAST(hour(timestamp_utc) AS BIGINT) AS hour_of_day,
           CAST(month(timestamp_utc) AS BIGINT) AS month,
           CAST(dayofweek(timestamp_utc) AS BIGINT) AS day_of_week,
           CAST(CASE WHEN dayofweek(timestamp_utc) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
           sin(2 * pi() * hour(timestamp_utc) / CAST(24 AS DOUBLE)) AS hour_sin,
           cos(2 * pi() * hour(timestamp_utc) / CAST(24 AS DOUBLE)) AS hour_cos,
           sin(2 * pi() * month(timestamp_utc) / CAST(12 AS DOUBLE)) AS month_sin,
           cos(2 * pi() * month(timestamp_utc) / CAST(12 AS DOUBLE)) AS month_cos,
           {_seasonal()}
    FROM silver
    WHERE NOT is_quality_anomaly
    WINDOW s AS (PARTITION BY city_id ORDER BY timestamp_utc),
           d AS (PARTITION BY city_id ORDER BY timestamp_utc ROWS BETWEEN 23 PRECEDING AND CURRENT ROW),
           w AS (PARTITION BY city_id ORDER BY timestamp_utc ROWS BETWEEN 167 PRECEDING AND CURRENT ROW),
           cell AS (PARTITION BY city_id, month(timestamp_utc), hour(timestamp_utc))
),
features AS (
    SELECT *,
           temperature_c - temp_lag_1h AS temp_delta_1h,
           temperature_c - temp_lag_2h AS temp_delta_2h,
           humidity_pct - humidity_lag_1h AS humidity_delta_1h,
           pressure_hpa - pressure_lag_1h AS pressure_delta_1h,
           wind_speed_ms - wind_lag_1h AS wind_delta_1h,
           temperature_c - rolling_avg_temp_24h AS temp_vs_24h_avg,
           temperature_c - rolling_avg_temp_7d AS temp_vs_7d_avg,
           humidity_pct - rolling_avg_humidity_24h AS humidity_vs_24h_avg,
           pressure_hpa - rolling_avg_pressure_24h AS pressure_vs_24h_avg,
           wind_speed_ms - rolling_avg_wind_7d AS wind_vs_7d_avg,
           rolling_max_temp_24h - rolling_min_temp_24h AS temp_range_24h,
           temperature_c - (CAST(100 AS DOUBLE) - humidity_pct) / CAST(5 AS DOUBLE) AS dew_point_c,
           temperature_c - city_month_hour_avg_temp AS temp_vs_city_month_hour_avg,
           {_zscores()}
    FROM framed
)"""
)

DAYS = (
    FEATURES
    + """,
flagged AS (
    SELECT *, temperature_c - temp_lag_2h > 5 AS jump, wind_speed_ms > 3 * rolling_avg_wind_7d AS gale, rain_mm >= 50 AS pour
    FROM features
),
days AS (
    SELECT city_id, city_name, lat, lon, observed_date,
           CAST(count(*) FILTER (jump) AS BIGINT) AS sudden_temp_jump_count,
           CAST(count(*) FILTER (gale) AS BIGINT) AS high_wind_count,
           CAST(count(*) FILTER (pour) AS BIGINT) AS heavy_rain_count,
           CAST(count(*) FILTER (jump OR gale OR pour) AS BIGINT) AS extreme_event_count,
           max(temperature_c) AS max_temperature_c, max(wind_speed_ms) AS max_wind_speed_ms, sum(rain_mm) AS total_rain_mm
    FROM flagged
    GROUP BY city_id, city_name, lat, lon, observed_date
    HAVING count(*) FILTER (jump OR gale OR pour) > 0
)"""
)

OBS = (
    FEATURES
    + """,
obs AS (
    SELECT city_id, city_name, lat, lon, timestamp_utc, observed_date, temperature_c, humidity_pct, pressure_hpa,
           wind_speed_ms, COALESCE(rain_mm, 0) AS rain_mm, weather_condition, source, rolling_avg_temp_24h,
           rolling_var_temp_24h, temp_lag_1h, temp_lag_2h, rolling_avg_wind_7d, hour_of_day, month, is_weekend,
           timestamp_utc + INTERVAL 7 HOUR AS timestamp_ict,
           CAST(timestamp_utc + INTERVAL 7 HOUR AS DATE) AS observed_date_ict
    FROM features
),
period AS (
    SELECT * FROM obs
    WHERE observed_date_ict BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND source IN ('open_meteo')
),
city AS (SELECT * FROM period WHERE city_name = 'CITY_1')"""
)

PERIOD_DAYS = (
    DAYS
    + """,
period_days AS (SELECT * FROM days WHERE observed_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20')"""
)

RESPONSES = """
hours AS (
    SELECT *, CAST(event_id // 24 AS INTEGER) AS block, CAST(event_id // 960 AS INTEGER) + 1 AS city_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
),
answered AS (
    SELECT block, city_id, arg_max(ts, event_id) AS final_ts,
           max(ts) - CASE WHEN block % 5 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS fetched_at
    FROM hours GROUP BY block, city_id
),
fetched AS (
    -- the short array lacks the final hour, which matters only if that hour was wanted
    SELECT *, (block % 50 = 13 OR city_id % 4 = 0) AND date_trunc('minute', final_ts) <= fetched_at AS short
    FROM answered
),
history AS (
    SELECT strftime(ts, '%Y-%m-%dT%H:%M') AS "timestamp", city_id,
           'CITY_' || CAST(city_id AS VARCHAR) AS city_name,
           CAST(8 + (city_id % 10) * 0.5 AS DOUBLE) AS lat, CAST(102 + (city_id % 10) * 0.25 AS DOUBLE) AS lon,
           CAST(k * 0.75 - 12 AS DOUBLE) AS temperature,
           CAST(event_id % 107 AS DOUBLE) AS humidity,
           CASE WHEN block % 4 <> 0 THEN CAST(990 + event_id % 41 AS DOUBLE) END AS pressure,
           CAST(floor(value) AS DOUBLE) * CAST(0.25 AS DOUBLE) AS wind_speed,
           CAST(floor(value) AS DOUBLE) AS rain,
           CAST(NULL AS VARCHAR) AS weather_condition
    FROM hours JOIN fetched USING (block, city_id)
    WHERE block % 50 <> 7 AND NOT short AND date_trunc('minute', ts) <= fetched_at
)"""


def rounded(names: list[str]) -> str:
    return ", ".join(f"round({n}, {digits(n)}) AS {n}" if digits(n) else n for n in names)


def star(table: str, names: list[str]) -> str:
    """All columns, some of them rounded."""
    replaced = ", ".join(f"round({n}, {digits(n)}) AS {n}" for n in names if digits(n))
    return f"SELECT * REPLACE ({replaced}) FROM {table}"


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def features_of(names: list[str]) -> str:
    return with_(FEATURES, f"SELECT city_id, timestamp_utc, {rounded(names)} FROM features")


ROLLING_24H = [
    *[f"rolling_{fn}_temp_24h" for fn in ("avg", "min", "max", "std", "var")],
    "rolling_avg_humidity_24h",
    "rolling_avg_pressure_24h",
    *[f"rolling_{fn}_rain_24h" for fn in ("avg", "sum", "max")],
]
ROLLING_7D = [f"rolling_{fn}_{m}_7d" for m in ("temp", "wind") for fn in ("avg", "std")]
LAGS = ["temp_lag_1h", "temp_lag_2h", "humidity_lag_1h", "pressure_lag_1h", "wind_lag_1h"]
CALENDAR = [
    *["hour_of_day", "month", "day_of_week", "is_weekend"],
    *["hour_sin", "hour_cos", "month_sin", "month_cos"],
]
SEASONAL = [f"city_month_hour_{fn}_{m}" for m in MEASURES for fn in ("avg", "std")]
SCORES = ["temp_vs_city_month_hour_avg", *[f"{m}_city_month_hour_zscore" for m in MEASURES]]
DELTAS = [n.replace("lag", "delta") for n in LAGS] + [
    *["temp_vs_24h_avg", "temp_vs_7d_avg", "humidity_vs_24h_avg", "pressure_vs_24h_avg", "wind_vs_7d_avg"],
    *["temp_range_24h", "dew_point_c"],
]
FLAGS = ["invalid_temperature", "invalid_humidity", "invalid_rain", "invalid_wind_speed", "is_quality_anomaly"]


def _rule_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS rule, CAST(count(*) FILTER ({f}) AS BIGINT) AS invalid, "
        f"CAST(count(*) FILTER (NOT {f}) AS BIGINT) AS valid, "
        f"CAST(count(*) FILTER ({f} IS NULL) AS BIGINT) AS unknown FROM silver"
        for f in FLAGS
    )


def _stats_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, m AS median, avg(coalesce(x, m)) AS mean, stddev_pop(coalesce(x, m)) AS std "
        f"FROM (SELECT CAST({f} AS DOUBLE) AS x, median(CAST({f} AS DOUBLE)) OVER () AS m FROM stored) GROUP BY m"
        for f in MODEL_FEATURES
    )


STATS = (
    FEATURES.replace("features AS (", "stored AS MATERIALIZED (")
    + f""",
stats AS MATERIALIZED (
    SELECT feature, median, mean, CASE WHEN std = 0 THEN CAST(1 AS DOUBLE) ELSE std END AS std FROM ({_stats_rows()})
)"""
)

SCALED = ["temperature_c", "temp_lag_2h", "rolling_std_temp_24h", "rain_city_month_hour_zscore", "is_weekend"]


def _scaled() -> str:
    parts = []
    for f in SCALED:
        pick = {w: f"(SELECT {w} FROM stats WHERE feature = '{f}')" for w in ("median", "mean", "std")}
        parts.append(
            f"round((coalesce(CAST({f} AS DOUBLE), {pick['median']}) - {pick['mean']}) / {pick['std']}, 6) AS {f}"
        )
    return ", ".join(parts)


def _share(*parts: str) -> str:
    """The hash in [0, 1) of the parts and the row's key."""
    text = " || '|' || ".join([*parts, "city_id", "CAST(timestamp_utc AS VARCHAR)"])
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE))"


def _mean_path(n: int) -> str:
    """Mean depth of an unsuccessful search among n values."""
    if n <= 2:
        return f"{max(n - 1, 0)}::DOUBLE"
    return f"(2 * (ln({n - 1}::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * {n - 1}::DOUBLE / {n})"


def recursive(ctes: str, select: str) -> str:
    return with_(ctes, select).replace("WITH", "WITH RECURSIVE", 1)


def draw(trees: int, sample: int) -> str:
    """The rows of ``keys`` that each tree draws, by jumps from one tree of a row to its next."""
    jump = "CAST(floor(ln(1 - {u}) / ln(1 - p)) AS BIGINT)"
    return f""",
shares AS (SELECT city_id, timestamp_utc, least(1, 1.6::DOUBLE * {sample} / count(*) OVER ()) AS p FROM keys),
jumps AS (
    SELECT city_id, timestamp_utc, p, least({jump.format(u=_share("'42'"))}, {trees - 1}) AS tree
    FROM shares WHERE p < 1 AND {_share("'42'")} < 1 - exp({trees} * ln(1 - p))
    UNION ALL
    SELECT city_id, timestamp_utc, p, next FROM (
        SELECT city_id, timestamp_utc, p, tree + 1 + {jump.format(u=_share("'42'", "tree"))} AS next FROM jumps)
    WHERE next < {trees}),
tried AS (
    SELECT city_id, timestamp_utc, tree FROM jumps
    UNION ALL SELECT city_id, timestamp_utc, tree FROM shares, range({trees}) AS t(tree) WHERE p >= 1),
drawn AS MATERIALIZED (
    SELECT CAST(tree AS INTEGER) AS tree, city_id, timestamp_utc,
           row_number() OVER (PARTITION BY tree ORDER BY {_share("'43'", "tree")}, city_id, timestamp_utc) AS place
    FROM tried QUALIFY place <= {sample})"""


def _node_share(what: int) -> str:
    text = f"'42|' || tree || '|' || node || '|{what}'"
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE))"


def grow(depth: int) -> str:
    """Nodes, level by level, of the drawn rows; ``x`` has the inputs as (key, f, v), ``scales`` their deviations."""
    parts = [""",
values AS MATERIALIZED (SELECT tree, place, f, v FROM drawn JOIN x USING (city_id, timestamp_utc)),
at0 AS MATERIALIZED (SELECT tree, place, CAST(0 AS BIGINT) AS node FROM drawn)"""]
    for d in range(depth):
        parts.append(f"""
spans{d} AS (
    SELECT tree, node, f, min(v) AS low, max(v) AS high FROM at{d} JOIN values USING (tree, place) GROUP BY tree, node, f),
choices{d} AS (
    SELECT tree, node, f, low + {_node_share(1)} * (high - low) AS cut,
           row_number() OVER (PARTITION BY tree, node ORDER BY f) - 1 AS i, count(*) OVER (PARTITION BY tree, node) AS n
    FROM spans{d} JOIN scales USING (f) WHERE high - low > 0.0000001::DOUBLE * scale),
splits{d} AS MATERIALIZED (
    SELECT tree, node, f, cut, {d} AS depth FROM choices{d} WHERE i = CAST(floor({_node_share(0)} * n) AS BIGINT)),
at{d + 1} AS MATERIALIZED (
    SELECT tree, place, CASE WHEN f IS NULL THEN node WHEN v <= cut THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
    FROM at{d} LEFT JOIN splits{d} USING (tree, node) LEFT JOIN values USING (tree, place, f))""")
    levels = [f"SELECT tree, node, {d} AS depth, count(*) AS size FROM at{d} GROUP BY tree, node" for d in range(depth + 1)]
    # a row stays in its node for good once that was not split
    splits = " UNION ALL ".join(f"SELECT * FROM splits{d}" for d in range(depth))
    parts.append(f"""
splits AS MATERIALIZED ({splits}),
places AS (SELECT tree, node, min(depth) AS depth, max(size) AS size FROM ({" UNION ALL ".join(levels)}) GROUP BY tree, node),
nodes AS MATERIALIZED (
    SELECT p.tree, p.node, coalesce(f, -1) AS feature, coalesce(cut, 0) AS threshold, size, p.depth
    FROM places p LEFT JOIN splits s ON s.tree = p.tree AND s.node = p.node)""")
    return ",".join(parts)


def _unpivoted(names: list[str], value) -> str:
    return " UNION ALL ".join(f"SELECT city_id, timestamp_utc, {i} AS f, {value(c)} AS v FROM stored" for i, c in enumerate(names))


STORED = FEATURES.replace("features AS (", "stored AS MATERIALIZED (")


def grown_forest(trees: int, sample: int) -> str:
    known = _unpivoted(GROWN, lambda c: f"coalesce(CAST({c} AS DOUBLE), 0)")
    return recursive(
        STORED
        + ",\nkeys AS (SELECT city_id, timestamp_utc FROM stored)"
        + draw(trees, sample)
        + f",\nx AS ({known}),\nscales AS (SELECT f, CAST(1 AS DOUBLE) AS scale FROM range({len(GROWN)}) AS t(f))"
        + grow(math.ceil(math.log2(sample))),
        """
SELECT tree, CAST(node AS INTEGER) AS node, CAST(feature AS INTEGER) AS feature, round(threshold, 9) AS threshold,
       CAST(size AS INTEGER) AS size, CAST(depth AS INTEGER) AS depth
FROM nodes""",
    )


def scored_forest(trees: int, sample: int) -> str:
    """The whole model: draw, impute, grow, walk every row down every tree, offset and flags."""
    depth = math.ceil(math.log2(sample))
    imputed = _unpivoted(MODEL_FEATURES, lambda c: f"coalesce(CAST({c} AS DOUBLE), (SELECT median FROM stats WHERE feature = '{c}'))")
    walks = [",\nwalk0 AS (SELECT city_id, timestamp_utc, tree, CAST(0 AS BIGINT) AS node FROM keys, (SELECT DISTINCT tree FROM nodes))"]
    for d in range(depth):
        walks.append(f"""
walk{d + 1} AS (
    SELECT city_id, timestamp_utc, tree, CASE WHEN f IS NULL THEN node WHEN v <= cut THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
    FROM walk{d} LEFT JOIN splits USING (tree, node) LEFT JOIN x USING (city_id, timestamp_utc, f))""")
    mean_path = "CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1 ELSE 2 * (ln(n - 1) + 0.5772156649015329::DOUBLE) - 2 * (n - 1) / n END"
    return recursive(
        STATS
        + ",\nkeys AS (SELECT city_id, timestamp_utc FROM stored)"
        + draw(trees, sample)
        + f",\nx AS MATERIALIZED ({imputed}),\nscales AS ({_scales()})"
        + grow(depth)
        + ",".join(walks)
        + f""",
lengths AS (SELECT tree, node, depth + {mean_path} AS path FROM (SELECT *, CAST(size AS DOUBLE) AS n FROM nodes)),
raw_scores AS MATERIALIZED (
    SELECT city_id, timestamp_utc, -pow(2::DOUBLE, -(sum(path) / {trees}) / {_mean_path(sample)}) AS score
    FROM walk{depth} JOIN lengths USING (tree, node) GROUP BY city_id, timestamp_utc),
bound AS (SELECT quantile_cont(score, 0.03) AS b FROM raw_scores)""",
        "SELECT city_id, timestamp_utc, round(score - b, 9) AS anomaly_score, score - b < 0 AS is_anomaly FROM raw_scores, bound",
    )


def _scales() -> str:
    return " UNION ALL ".join(f"SELECT {i} AS f, std AS scale FROM stats WHERE feature = '{c}'" for i, c in enumerate(MODEL_FEATURES))


SMALL_SCORES = (
    FEATURES
    + f""",
inputs AS (
    SELECT city_id, timestamp_utc, coalesce(temperature_c, 0) AS t, coalesce(humidity_pct, 0) AS h, coalesce(rain_mm, 0) AS r
    FROM features
),
paths AS (
    SELECT *,
           CASE WHEN t > 10.5 THEN 1 + {_mean_path(3)} WHEN r > 2 THEN 2 + {_mean_path(1)} ELSE 2 + {_mean_path(4)} END AS a,
           CASE WHEN h <= 50 THEN 1 + {_mean_path(2)} WHEN t > 20.25 THEN 2 + {_mean_path(1)} ELSE 2 + {_mean_path(5)} END AS b
    FROM inputs
),
scores AS (
    SELECT city_id, timestamp_utc, round(-pow(2::DOUBLE, -((a + b) / 2) / {_mean_path(4)}), 9) AS score FROM paths
)"""
)


def _kpi_text(value: str, suffix: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE format('{{:,.1f}}{suffix}', {value}) END"


def _change(column: str) -> str:
    return with_(
        OBS,
        f"""
SELECT '{column}' AS measure, delta,
       CASE WHEN delta IS NOT NULL THEN format('{{:,.1f}} vs prev', delta) END AS label
FROM (
    SELECT max(v) FILTER (r = 1) - max(v) FILTER (r = 2) AS delta
    FROM (SELECT {column} AS v, row_number() OVER (ORDER BY timestamp_utc DESC, city_id DESC) AS r
          FROM city WHERE {column} IS NOT NULL)
)""",
    )


def _ranking(name: str, value: str) -> str:
    return with_(
        OBS, f"SELECT city_name, {value} AS {name} FROM period GROUP BY city_name ORDER BY {name} DESC, city_name LIMIT 10"
    )


ROUNDED_FEATURES = ROLLING_24H + ROLLING_7D + CALENDAR + SEASONAL + SCORES
LATEST = (
    OBS
    + """,
latest AS (
    SELECT * FROM period
    QUALIFY row_number() OVER (PARTITION BY city_name ORDER BY timestamp_utc DESC, city_id DESC) = 1
)"""
)

UNEVEN = """
readings AS (
    SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE CAST(user_id // 15 AS INTEGER) + 1 END AS city_id,
           CAST(date_trunc('minute', ts) AS TIMESTAMP) AS timestamp_utc,
           CAST(json_extract_string(props, '$.k') AS INTEGER) * CAST(0.75 AS DOUBLE) AS temperature_c,
           CASE WHEN event_id % 13 <> 0 THEN CAST(floor(value) AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS wind_speed_ms,
           event_id
    FROM events
),
series AS (
    SELECT * FROM readings
    QUALIFY row_number() OVER (PARTITION BY city_id, timestamp_utc ORDER BY event_id DESC) = 1
)"""

BRONZE_COLUMNS = """"timestamp", CAST(city_id AS INTEGER) AS city_id, city_name, lat, lon,
       TRY_CAST(temperature AS DOUBLE) AS temperature, CAST(humidity AS DOUBLE) AS humidity,
       CAST(pressure AS DOUBLE) AS pressure, wind_speed, CAST(rain AS DOUBLE) AS rain"""

# In the lake all rows of a batch carry one ingestion instant, so their content decides.
LAKE_SILVER = SILVER.replace(
    "ingested_at AS ingested_at_utc", "TIMESTAMP '2024-02-01 03:04:05.000006' AS ingested_at_utc"
).replace(
    "ingested_at_utc DESC NULLS LAST, ingest_seq DESC",
    ", ".join(
        f"{c} DESC NULLS LAST"
        for c in ("source", "weather_condition", *MEASURES.values(), "city_name", "lat", "lon")
    ),
)

MONTHS = """,
months AS (
    SELECT city_id, city_name, CAST(date_trunc('month', timestamp_utc) AS TIMESTAMP) AS observed_month,
           avg(temperature_c) AS t, avg(humidity_pct) AS h, sum(rain_mm) AS total_rain_mm
    FROM silver WHERE NOT is_quality_anomaly GROUP BY ALL
)"""


def spread(ctes: str) -> str:
    """The same over more stations and months."""
    shifted = "(SELECT * REPLACE (ts + to_months(CAST(event_id % 15 AS INTEGER)) AS ts) FROM events)"
    return ctes.replace("user_id // 15", "user_id // 5").replace("FROM events", f"FROM {shifted}")


def model_rows(silver: str) -> str:
    """All four model tables, from the given silver rows."""
    return with_(
        DAYS.replace(SILVER, silver) + MONTHS,
        """
SELECT 'silver' AS model, city_id, timestamp_utc AS "at", round(temperature_c, 6) AS a, round(humidity_pct, 6) AS b,
       round(rain_mm, 6) AS c, round(wind_speed_ms, 6) AS d FROM silver
UNION ALL
SELECT 'features', city_id, timestamp_utc, round(temp_lag_2h, 6), round(rolling_avg_temp_7d, 6),
       round(rolling_std_wind_7d, 6), round(rain_city_month_hour_zscore, 6) FROM features
UNION ALL
SELECT 'events', city_id, CAST(observed_date AS TIMESTAMP), extreme_event_count, high_wind_count,
       round(max_temperature_c, 6), round(total_rain_mm, 6) FROM days
UNION ALL
SELECT 'monthly', city_id, observed_month, round(t, 6), round(t - lag(t, 12) OVER s, 6),
       round(h - lag(h, 12) OVER s, 6), round(total_rain_mm, 6)
FROM months WINDOW s AS (PARTITION BY city_id ORDER BY observed_month)""",
    )


QUANTILES = """
SELECT 'l_extendedprice' AS column_name, CAST(0.5 AS DOUBLE) AS quantile, quantile_cont(l_extendedprice, 0.5) AS value FROM lineitem
UNION ALL SELECT 'l_quantity', 0.03, quantile_cont(l_quantity, 0.03) FROM lineitem
UNION ALL SELECT 'l_discount', 0.97, quantile_cont(l_discount, 0.97) FROM lineitem
UNION ALL SELECT 'l_tax', 0.5, quantile_cont(l_tax, 0.5) FROM lineitem"""

ORACLES: dict[str, str] = {
    "silver_clean": with_(SILVER, "SELECT * FROM silver"),
    "quality_counts": with_(SILVER, _rule_counts()),
    "quality_while_writing": with_(SILVER, _rule_counts()),
    "stream_features": features_of(ROLLING_24H + ROLLING_7D + LAGS),
    "silver_checks": with_(
        SILVER,
        """
SELECT 'not_null_city_id' AS test, CAST(count(*) FILTER (city_id IS NULL) AS BIGINT) AS failures FROM silver
UNION ALL SELECT 'not_null_timestamp_utc', count(*) FILTER (timestamp_utc IS NULL) FROM silver
UNION ALL SELECT 'unique_key', count(*) FROM (
    SELECT city_id FROM silver GROUP BY city_id, timestamp_utc HAVING count(*) > 1)""",
    ),
    "raw_duplicates": with_(
        RAW, 'SELECT city_id, "timestamp", count(*) AS copies FROM raw GROUP BY city_id, "timestamp" HAVING count(*) > 1'
    ),
    "rolling_24h": features_of(ROLLING_24H),
    "rolling_7d": features_of(ROLLING_7D),
    "lags": features_of(LAGS),
    "seasonal_zscore": features_of(SEASONAL + SCORES),
    "calendar_features": features_of(CALENDAR),
    "feature_deltas": features_of(DELTAS),
    "feature_store": with_(FEATURES, star("features", ROUNDED_FEATURES)),
    "uneven_series_frames": with_(
        UNEVEN,
        """
SELECT city_id, timestamp_utc, temperature_c, wind_speed_ms,
       avg(temperature_c) OVER d AS rolling_avg_temp_24h,
       max(temperature_c) OVER w AS rolling_max_temp_7d,
       avg(wind_speed_ms) OVER w AS rolling_avg_wind_7d,
       sum(wind_speed_ms) OVER w AS rolling_sum_wind_7d,
       round(stddev_samp(wind_speed_ms) OVER w, 6) AS rolling_std_wind_7d,
       lag(temperature_c, 2) OVER s AS temp_lag_2h
FROM series
WINDOW s AS (PARTITION BY city_id ORDER BY timestamp_utc),
       d AS (PARTITION BY city_id ORDER BY timestamp_utc ROWS BETWEEN 23 PRECEDING AND CURRENT ROW),
       w AS (PARTITION BY city_id ORDER BY timestamp_utc ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)""",
    ),
    "extreme_events_daily": with_(DAYS, "SELECT * FROM days"),
    "monthly_climate_delta": with_(
        SILVER
        + """,
months AS (
    SELECT city_id, city_name, CAST(date_trunc('month', timestamp_utc) AS TIMESTAMP) AS observed_month,
           avg(temperature_c) AS t, avg(humidity_pct) AS h, sum(rain_mm) AS total_rain_mm
    FROM silver WHERE NOT is_quality_anomaly GROUP BY ALL
)""",
        """
SELECT city_id, city_name, observed_month, t AS avg_temp_c, t - lag(t, 12) OVER s AS temp_delta_yoy_c,
       h AS avg_humidity_pct, h - lag(h, 12) OVER s AS humidity_delta_yoy_pct, total_rain_mm
FROM months WINDOW s AS (PARTITION BY city_id ORDER BY observed_month)""",
    ),
    "monthly_yoy": """
WITH months AS (
    SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS ship_month,
           avg(l_quantity) AS q, sum(l_quantity) AS sum_quantity
    FROM lineitem GROUP BY ALL
)
SELECT l_suppkey, ship_month, q AS avg_quantity,
       q - lag(q, 12) OVER (PARTITION BY l_suppkey ORDER BY ship_month) AS quantity_delta_yoy, sum_quantity
FROM months""",
    "report_rows": with_(OBS, star("obs", ["rolling_var_temp_24h"])),
    "date_bounds": with_(
        OBS,
        """
SELECT min(observed_date_ict) AS min_date, max(observed_date_ict) AS max_date,
       greatest(min(observed_date_ict), CAST(max(observed_date_ict) - INTERVAL 30 DAY AS DATE)) AS default_start,
       max(timestamp_ict) AS updated_at, count(*) AS row_count
FROM obs""",
    ),
    "default_period": with_(
        OBS,
        "SELECT greatest(min(observed_date_ict), CAST(max(observed_date_ict) - INTERVAL 10 DAY AS DATE)) AS default_start FROM obs",
    ),
    "selector_cities": with_(OBS, "SELECT DISTINCT city_name FROM obs WHERE city_name IS NOT NULL ORDER BY 1"),
    "selector_sources": with_(OBS, "SELECT DISTINCT source FROM obs WHERE source IS NOT NULL ORDER BY 1"),
    "selected_rows": with_(
        OBS, "SELECT city_id, timestamp_utc, timestamp_ict, observed_date_ict, source FROM period"
    ),
    "city_kpis": with_(
        OBS
        + """,
tiles AS (
    SELECT max_by(temperature_c, timestamp_utc) AS latest_temp_c,
           max_by(rolling_avg_temp_24h, timestamp_utc) AS avg_temp_24h_c,
           coalesce(sum(rain_mm), 0) AS rain_in_range_mm, max(wind_speed_ms) AS peak_wind_ms,
           max_by(humidity_pct, timestamp_utc) AS latest_humidity_pct, count(*) AS observations
    FROM city
)""",
        f"""
SELECT *, {_kpi_text("latest_temp_c", " C")} AS latest_temp, {_kpi_text("avg_temp_24h_c", " C")} AS avg_temp_24h,
       {_kpi_text("rain_in_range_mm", " mm")} AS rain_in_range, {_kpi_text("peak_wind_ms", " m/s")} AS peak_wind,
       {_kpi_text("latest_humidity_pct", "%")} AS latest_humidity
FROM tiles""",
    ),
    "latest_temperature_change": _change("temperature_c"),
    "latest_humidity_change": _change("humidity_pct"),
    "trailing_24h": with_(
        OBS,
        """
SELECT timestamp_ict, rain_mm, wind_speed_ms FROM city
WHERE timestamp_ict >= (SELECT max(timestamp_ict) FROM city) - INTERVAL 24 HOUR""",
    ),
    "temperature_series": with_(
        OBS, "SELECT timestamp_ict, temperature_c, rolling_avg_temp_24h FROM city ORDER BY timestamp_ict"
    ),
    "daily_city_summary": with_(
        OBS,
        """
SELECT observed_date_ict, avg(temperature_c) AS avg_temp_c, max(temperature_c) AS max_temp_c,
       sum(rain_mm) AS rain_mm, avg(wind_speed_ms) AS avg_wind_ms
FROM city GROUP BY observed_date_ict ORDER BY observed_date_ict""",
    ),
    "city_compare_pivot": with_(
        OBS,
        """
SELECT observed_date_ict,
       avg(CASE WHEN city_name = 'CITY_1' THEN temperature_c END) AS "CITY_1",
       avg(CASE WHEN city_name = 'CITY_2' THEN temperature_c END) AS "CITY_2",
       avg(CASE WHEN city_name = 'CITY_3' THEN temperature_c END) AS "CITY_3"
FROM period WHERE city_name IN ('CITY_1', 'CITY_2', 'CITY_3') GROUP BY 1 ORDER BY 1""",
    ),
    "rank_avg_temp": _ranking("avg_temp_c", "avg(temperature_c)"),
    "rank_total_rain": _ranking("total_rain_mm", "sum(rain_mm)"),
    "rank_peak_wind": _ranking("peak_wind_ms", "max(wind_speed_ms)"),
    "event_totals_top12": with_(
        PERIOD_DAYS,
        """
SELECT city_name, CAST(sum(extreme_event_count) AS BIGINT) AS extreme_event_count,
       CAST(sum(sudden_temp_jump_count) AS BIGINT) AS sudden_temp_jump_count,
       CAST(sum(high_wind_count) AS BIGINT) AS high_wind_count,
       CAST(sum(heavy_rain_count) AS BIGINT) AS heavy_rain_count
FROM period_days GROUP BY city_name ORDER BY extreme_event_count DESC, city_name LIMIT 12""",
    ),
    "city_events": with_(
        PERIOD_DAYS,
        """
SELECT observed_date, sudden_temp_jump_count, high_wind_count, heavy_rain_count
FROM period_days WHERE city_name = 'CITY_1' ORDER BY observed_date""",
    ),
    "latest_by_city": with_(
        LATEST,
        """
SELECT city_name, timestamp_ict, temperature_c, humidity_pct, wind_speed_ms, rain_mm, source
FROM latest ORDER BY temperature_c DESC, city_name""",
    ),
    "map_points": with_(
        LATEST,
        """
SELECT lat AS latitude, lon AS longitude, temperature_c FROM latest
WHERE lat IS NOT NULL AND lon IS NOT NULL AND temperature_c IS NOT NULL""",
    ),
    "observation_listing": with_(
        OBS,
        """
SELECT timestamp_ict, timestamp_utc, temperature_c, rolling_avg_temp_24h, humidity_pct, pressure_hpa,
       wind_speed_ms, rain_mm, source
FROM city ORDER BY timestamp_ict DESC""",
    ),
    "registry_scan": """
SELECT CAST(n_nationkey + 1 AS INTEGER) AS city_id, n_name AS city_name,
       CAST(8 + n_regionkey * 0.5 AS DOUBLE) AS lat, CAST(102 + n_regionkey * 0.25 AS DOUBLE) AS lon,
       n_nationkey % 6 = 0 AS is_economic_center
FROM nation""",
    "parse_current_payload": with_(
        RAW,
        """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp", station + 1 AS city_id,
       'CITY_' || CAST(station + 1 AS VARCHAR) AS city_name,
       CAST(8 + (station % 10) * 0.5 AS DOUBLE) AS lat, CAST(102 + (station % 10) * 0.25 AS DOUBLE) AS lon,
       CAST(k * 0.75 - 12 AS DOUBLE) AS temperature,
       CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 107 AS DOUBLE) END AS humidity,
       CAST(990 + event_id % 41 AS DOUBLE) AS pressure,
       CASE WHEN event_id % 7 <> 0 THEN whole * CAST(0.25 AS DOUBLE) END AS wind_speed,
       CASE WHEN k % 5 = 0 THEN whole ELSE CAST(0 AS DOUBLE) END AS rain,
       CASE WHEN event_id % 11 <> 0 THEN event_type END AS weather_condition
FROM numbered""",
    ),
    "parse_history_payload": with_(RESPONSES, "SELECT * FROM history"),
    "unusable_history": with_(RESPONSES, "SELECT city_id, fetched_at FROM fetched WHERE block % 50 <> 7 AND short"),
    "history_date_range": with_(
        RESPONSES,
        """
SELECT city_id, count(*) AS n, min("timestamp") AS "first", max("timestamp") AS "last" FROM history
WHERE CAST(CAST("timestamp" AS TIMESTAMP) AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-12'
GROUP BY city_id""",
    ),
    "batch_completeness": with_(
        RESPONSES,
        """,
answers AS (
    SELECT city_id, bool_or(block % 50 <> 7 AND short) AS failed FROM fetched GROUP BY city_id
    UNION ALL SELECT max(city_id) + 1, true FROM fetched
)
SELECT city_id, 'CITY_' || CAST(city_id AS VARCHAR) AS city_name FROM answers WHERE failed""",
    ).replace("\n,\nanswers", ",\nanswers"),
    "bronze_roundtrip": with_(
        RAW,
        f"""
SELECT {BRONZE_COLUMNS}, weather_condition, source, '2024-02-01T03:04:05.000006+00:00' AS ingested_at,
       CAST(2024 AS INTEGER) AS ingestion_year, CAST(2 AS INTEGER) AS ingestion_month, CAST(1 AS INTEGER) AS ingestion_day,
       '2024' AS "year", '02' AS "month", '01' AS "day"
FROM raw""",
    ),
    "bronze_mixed_types": with_(
        RAW,
        f"""
SELECT {BRONZE_COLUMNS}, CASE WHEN source = 'openweather' THEN weather_condition END AS weather_condition, source,
       '2024' AS "year", '02' AS "month", CASE WHEN source = 'openweather' THEN '03' ELSE '02' END AS "day"
FROM raw""",
    ),
    "refreshed_models": model_rows(LAKE_SILVER),
    "incremental_tables": model_rows(spread(SILVER)),
    "monthly_climate_years": with_(
        spread(SILVER) + MONTHS,
        """
SELECT city_id, city_name, observed_month, t AS avg_temp_c, t - lag(t, 12) OVER s AS temp_delta_yoy_c,
       h AS avg_humidity_pct, h - lag(h, 12) OVER s AS humidity_delta_yoy_pct, total_rain_mm
FROM months WINDOW s AS (PARTITION BY city_id ORDER BY observed_month)""",
    ),
    "rank_many_cities": with_(
        spread(FEATURES),
        """
SELECT city_name, sum(rain_mm) AS total_rain_mm FROM features GROUP BY city_name
ORDER BY total_rain_mm DESC, city_name LIMIT 10""",
    ),
    "event_totals_many_cities": with_(
        spread(DAYS),
        """
SELECT city_name, CAST(sum(extreme_event_count) AS BIGINT) AS extreme_event_count,
       CAST(sum(sudden_temp_jump_count) AS BIGINT) AS sudden_temp_jump_count,
       CAST(sum(high_wind_count) AS BIGINT) AS high_wind_count,
       CAST(sum(heavy_rain_count) AS BIGINT) AS heavy_rain_count
FROM days GROUP BY city_name ORDER BY extreme_event_count DESC, city_name LIMIT 12""",
    ),
    "exact_quantiles": QUANTILES,
    "quantiles_from_sketches": QUANTILES,
    "impute_scale_stats": with_(
        STATS, "SELECT feature, round(median, 6) AS median, round(mean, 6) AS mean, round(std, 6) AS std FROM stats"
    ),
    "impute_scale_apply": with_(STATS, f"SELECT city_id, timestamp_utc, {_scaled()} FROM stored"),
    "incremental_refresh": with_(DAYS, "SELECT * FROM days"),
    "stream_daily_counts": with_(
        SILVER,
        """
SELECT city_id, CAST(date_trunc('day', timestamp_utc) AS TIMESTAMP) AS window_start, count(*) AS observations,
       CAST(count(*) FILTER (rain_mm >= 50) AS BIGINT) AS heavy_rain_count
FROM silver WHERE NOT is_quality_anomaly GROUP BY 1, 2""",
    ),
    "stream_latest_wins": with_(
        SILVER,
        """
SELECT city_id, timestamp_utc, ingested_at_utc AS ingested_at, ingest_seq, weather_condition
FROM typed
WHERE city_id IS NOT NULL AND timestamp_utc IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY city_id, timestamp_utc
                           ORDER BY ingested_at_utc DESC NULLS LAST, ingest_seq DESC) = 1""",
    ),
    "silver_edge_times": with_(
        SILVER.replace(
            "typed AS (",
            """edge AS (
    SELECT * REPLACE (
        CASE WHEN ingest_seq % 40 = 0 THEN '9999-12-31T12:00' ELSE "timestamp" END AS "timestamp",
        CASE WHEN ingest_seq % 80 = 0 THEN NULL
             WHEN ingest_seq % 80 = 40 THEN TIMESTAMP '9999-12-31 11:59:59'
             WHEN ingest_seq % 7 = 3 THEN TRY_CAST("timestamp" AS TIMESTAMP)
             ELSE ingested_at END AS ingested_at)
    FROM raw
),
typed AS (""",
            1,
        ).replace("FROM raw\n),\nsilver", "FROM edge\n),\nsilver"),
        "SELECT city_id, timestamp_utc, ingested_at_utc, humidity_pct FROM silver",
    ),
    "current_failures": with_(
        RAW,
        """,
stations AS (SELECT DISTINCT city_id, city_name FROM raw WHERE city_id IS NOT NULL)
SELECT city_id, city_name FROM stations
WHERE city_id % 3 = 2 AND city_id IN (SELECT station + 1 FROM numbered WHERE event_id % 300 IN (3, 103, 203))
UNION ALL SELECT max(city_id) + 1, 'SILENT' FROM stations""",
    ).replace("\n,\nstations", ",\nstations"),
    "missing_features": " UNION ALL ".join(
        f"SELECT '{f}' AS column_name" for f in MODEL_FEATURES if f not in MEASURES.values()
    ),
    "iforest_scores": scored_forest(300, 256),
    "iforest_grow": grown_forest(20, 32),
    "iforest_shape": with_(
        SILVER,
        """,
size AS (SELECT least(count(*), 256) AS n FROM silver WHERE NOT is_quality_anomaly)
SELECT CAST(tree AS INTEGER) AS tree, n AS root_rows, n AS leaf_rows,
       CAST(ceil(log2(n)) AS BIGINT) AS depth
FROM size, range(300) AS t(tree)""",
    ).replace("\n,\nsize", ",\nsize"),
    "iforest_draw": recursive(
        SILVER + ",\nkeys AS (SELECT city_id, timestamp_utc FROM silver WHERE NOT is_quality_anomaly)" + draw(20, 32),
        "SELECT tree, city_id, timestamp_utc, CAST(place AS INTEGER) AS place FROM drawn",
    ),
    "iforest_apply": with_(SMALL_SCORES, "SELECT city_id, timestamp_utc, score FROM scores"),
    "iforest_offset_flags": with_(
        SMALL_SCORES,
        """,
bound AS (SELECT quantile_cont(score, 0.03) AS b FROM scores)
SELECT city_id, timestamp_utc, round(b, 9) AS "offset", score < b AS is_anomaly FROM scores, bound""",
    ).replace("\n,\nbound", ",\nbound"),
}
