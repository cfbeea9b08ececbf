"""Anomaly model over the feature store: impute, standardise, isolation forest, score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.operators.checks import require_columns
from almanac.operators.forest import ForestSize, grow_trees, tree_samples, with_path_score
from almanac.operators.quantiles import exact_quantiles, known
from almanac.operators.sketches import brackets, part_sketches
from almanac.schemas import MODEL_FEATURES
from almanac.session import materialise
from almanac.sources.tables import Transaction, month_of, read_table, write_table

ROW_KEY = ("city_id", "timestamp_utc")
CONTAMINATION = 0.03
SCORE = "anomaly_score"

STATS_SCHEMA = "position int, feature string, median double, mean double, std double"
META_SCHEMA = "trees int, sample int, seed int, per_tree int, rows long, contamination double, offset double"


@dataclass
class AnomalyModel:
    """Three small tables: per-feature statistics, forest nodes, and one row of settings."""

    stats: DataFrame
    nodes: DataFrame
    meta: DataFrame
    raw: DataFrame | None = None  # the rows of the fit with their scores before the offset, if they were kept


def impute_scale_stats(df: DataFrame, features: Sequence[str], sketches: DataFrame | None = None) -> list[tuple]:
    """(position, feature, median, mean, std) with mean and population deviation after imputing.

    A feature without any known value is left out; a constant one has deviation 1. ``sketches`` of the features
    (``stored_sketches``) spare passes over the table.
    """
    wanted = dict.fromkeys(features, 0.5)
    hints = brackets(sketches, wanted) if sketches is not None else None
    medians = exact_quantiles(df, wanted, hints=hints)
    used = [f for f in features if medians[f] is not None]
    imputed = {f: F.coalesce(known(f), F.lit(medians[f])) for f in used}
    row = df.agg(
        *[F.avg(imputed[f]).alias(f"m{i}") for i, f in enumerate(used)],
        *[F.stddev_pop(imputed[f]).alias(f"s{i}") for i, f in enumerate(used)],
    ).first()
    return [(i, f, medians[f], row[f"m{i}"], row[f"s{i}"] or 1.0) for i, f in enumerate(used)]


def imputed_inputs(stats: Sequence) -> list[Column]:
    """The imputed value expressions, in training order.

    The forest takes these rather than the standardised values: its splits are the same for any
    unit, and medians are exact, while sums behind means vary in the last digit with partitioning.
    """
    return [F.coalesce(known(feature), F.lit(median)) for _, feature, median, _, _ in sorted(stats)]


def impute_scale(df: DataFrame, stats: Sequence) -> DataFrame:
    """Replace every feature by its imputed, standardised value."""
    scaled = {
        feature: (value - F.lit(mean)) / F.lit(std)
        for (_, feature, _, mean, std), value in zip(sorted(stats), imputed_inputs(stats), strict=True)
    }
    return df.withColumns(scaled)


def fit_anomaly(
    df: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    key: Sequence[str] = ROW_KEY,
    contamination: float = CONTAMINATION,
    size: ForestSize = ForestSize(),
    keep_scores: bool = False,
    sketches: DataFrame | None = None,
) -> AnomalyModel:
    """Fit on all rows of ``df``, a stored table: it is read once per fitting step.

    The rows' key must be unique. The model tables are stored before they are used. The offset needs every row's
    score; with ``keep_scores`` the rows are stored with it, and ``scored_in_fit`` need not score them again.
    """
    require_columns(df, features, "Model inputs absent; refresh the feature table, then fit")
    spark = df.sparkSession
    n_rows = df.count()
    per_tree = min(size.sample, n_rows)
    stats = impute_scale_stats(df, features, sketches)
    inputs = imputed_inputs(stats)

    prepared = df.select(*key, F.array(*inputs).alias("_x"))
    samples = tree_samples(prepared, key, n_rows, size, ["_x"])
    nodes = materialise(grow_trees(samples, "_x", [s[4] for s in stats], size, per_tree), "nodes")

    rows = df if keep_scores else df.select(*features)
    scores = with_path_score(rows, nodes, inputs, size, per_tree, SCORE)
    scores = materialise(scores if keep_scores else scores.select(SCORE), "scores")
    offset = exact_quantiles(scores, {SCORE: contamination})[SCORE]
    meta = [(size.trees, size.sample, size.seed, per_tree, n_rows, contamination, offset)]
    return AnomalyModel(
        spark.createDataFrame(stats, STATS_SCHEMA),
        nodes,
        spark.createDataFrame(meta, META_SCHEMA),
        scores if keep_scores else None,
    )


SKETCHES = "feature_sketches"


def store_sketches(
    df: DataFrame,
    root: str,
    day: str = "observed_date",
    features: Sequence[str] = MODEL_FEATURES,
    months: Sequence[str] | None = None,
) -> DataFrame:
    """Sketch the features by month and return the stored sketches of all months.

    With ``months``, ``df`` holds the rows of these months, and the sketches of the others stay as they are.
    """
    change = Transaction(df.sparkSession, root)
    made = part_sketches(df, features, month_of(day))
    if months is None or not change.has(SKETCHES):
        change.write(made, SKETCHES, F.col("part"), ["column_name"])
    else:
        change.replace_months(made, SKETCHES, F.col("part"), months, ["column_name"])
    return change.commit().read(SKETCHES)


def save_model(model: AnomalyModel, root: str) -> None:
    write_table(model.stats.coalesce(1), root, "impute_scale_stats")
    write_table(model.nodes.coalesce(1), root, "forest_nodes")
    write_table(model.meta.coalesce(1), root, "model_meta")


def load_model(spark: SparkSession, root: str) -> AnomalyModel:
    return AnomalyModel(*[read_table(spark, root, t) for t in ("impute_scale_stats", "forest_nodes", "model_meta")])


def score_anomaly(df: DataFrame, model: AnomalyModel) -> DataFrame:
    """All columns, the anomaly score (negative: anomalous) and the flag."""
    stats = [tuple(r) for r in model.stats.collect()]
    meta = model.meta.first()
    require_columns(df, [s[1] for s in stats], "Model inputs absent; refresh the feature table and fit again, then score")
    size = ForestSize(meta.trees, meta.sample, meta.seed)
    return _flagged(with_path_score(df, model.nodes, imputed_inputs(stats), size, meta.per_tree, SCORE), meta.offset)


def _flagged(raw: DataFrame, offset: float) -> DataFrame:
    scored = raw.withColumn(SCORE, F.col(SCORE) - F.lit(offset))
    return scored.withColumn("is_anomaly", F.col(SCORE) < 0)


def scored_in_fit(model: AnomalyModel) -> DataFrame:
    """The rows that the model was fitted on, scored and flagged, from the scores of the fit."""
    if model.raw is None:
        raise ValueError("fit with keep_scores to read the scores of the fit")
    return _flagged(model.raw, model.meta.first().offset)


SCORED = "weather_anomalies"


def store_scores(df: DataFrame, model: AnomalyModel, root: str) -> DataFrame:
    """Replace the table of scored rows and return it as stored."""
    return write_table(score_anomaly(df, model), root, SCORED)


def store_scores_of_fit(model: AnomalyModel, root: str) -> DataFrame:
    """The same for the rows of the fit, without scoring them again."""
    return write_table(scored_in_fit(model), root, SCORED)
