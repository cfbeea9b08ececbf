import numpy as np
import pytest
from pyspark.sql import functions as F

from almanac.operators import sketches
from almanac.operators.forest import ForestSize, average_path, node_share, share_of, tree_samples
from almanac.operators.quantiles import exact_quantiles
from almanac.plans import anomaly
from almanac.session import materialise
from almanac.sources.tables import snapshot


@pytest.mark.parametrize("direct_rows", [1, 50, 10**6])
def test_quantiles_match_numpy(spark, direct_rows):
    rng = np.random.default_rng(3)
    n = 5001
    columns = {
        "spread": rng.normal(size=n),
        "steps": np.floor(rng.normal(size=n) * 2),
        "two": rng.integers(0, 2, n).astype(float),
        "one": np.full(n, 7.0),
        "tail": rng.pareto(0.5, n),
    }
    rows = [tuple(float(v) for v in r) for r in zip(*columns.values(), strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    for q in (0.03, 0.5, 0.999):
        got = exact_quantiles(df, dict.fromkeys(columns, q), direct_rows)
        for c, values in columns.items():
            assert got[c] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-12), (c, q)


def test_quantiles_skip_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (4.0, None)], "a double, b double")
    assert exact_quantiles(df, {"a": 0.5, "b": 0.5}) == {"a": 2.5, "b": None}


@pytest.fixture(scope="module")
def points(spark):
    """A Gaussian cloud, five far points, a missing value, an empty and a constant feature."""
    rng = np.random.default_rng(1)
    rows = [(i, *map(float, rng.normal(size=3)), None, 5.0) for i in range(1000)]
    rows += [(1000 + i, 12.0 + i, -15.0, 14.0, None, 5.0) for i in range(5)]
    rows[7] = (7, None, 0.0, float("nan"), None, 5.0)
    return materialise(
        spark.createDataFrame(rows, "id int, a double, b double, c double, empty double, same double"), "points"
    )


FEATURES = ["a", "b", "c", "empty", "same"]
SIZE = ForestSize(trees=100)


@pytest.fixture(scope="module")
def model(points):
    return anomaly.fit_anomaly(points, FEATURES, ["id"], size=SIZE)


def test_statistics(points):
    stats = {s[1]: s for s in anomaly.impute_scale_stats(points, FEATURES)}
    assert set(stats) == {"a", "b", "c", "same"}
    values = np.array([r.a if r.a is not None else np.nan for r in points.collect()])
    median = np.nanmedian(values)
    filled = np.where(np.isnan(values), median, values)
    assert stats["a"][2:] == pytest.approx((median, filled.mean(), filled.std()))
    assert stats["same"][2:] == (5.0, 5.0, 1.0)


def test_outliers_and_share(points, model):
    scored = anomaly.score_anomaly(points, model)
    assert scored.columns == [*points.columns, "anomaly_score", "is_anomaly"]
    rows = scored.orderBy("anomaly_score").collect()
    assert {r.id for r in rows[:5]} == {1000, 1001, 1002, 1003, 1004}
    assert sum(r.is_anomaly for r in rows) == 31  # 3 % of 1005
    assert all((r.anomaly_score < 0) == r.is_anomaly for r in rows)
    offset = model.meta.first().offset
    assert all(-1 < r.anomaly_score + offset < 0 for r in rows)


def test_scores_of_the_fit(points, model):
    kept = anomaly.fit_anomaly(points, FEATURES, ["id"], size=SIZE, keep_scores=True)
    columns = ["id", "anomaly_score", "is_anomaly"]
    want = anomaly.score_anomaly(points, model).select(columns).orderBy("id").collect()
    assert anomaly.scored_in_fit(kept).select(columns).orderBy("id").collect() == want
    with pytest.raises(ValueError, match="keep_scores"):
        anomaly.scored_in_fit(model)


def test_depth_follows_the_rows(spark):
    df = materialise(spark.range(100).selectExpr("id", "double(id * 7 % 31) AS a", "double(id % 11) AS b"), "few")
    few = anomaly.fit_anomaly(df, ["a", "b"], ["id"], size=ForestSize(trees=10))
    assert few.nodes.agg(F.max("depth")).first()[0] == 7
    assert anomaly.score_anomaly(df, few).filter("anomaly_score is null").isEmpty()


def test_trees_draw_independently(spark):
    """On a large table, as many distinct rows as independent draws would leave."""
    size = ForestSize(trees=50)
    drawn = tree_samples(spark.range(200_000), ["id"], 200_000, size, [])
    n = drawn.select("id").distinct().count()
    assert 50 * 256 * 0.95 < n <= 50 * 256


def test_partitioning_does_not_matter(points, model):
    other = anomaly.fit_anomaly(points.repartition(17), FEATURES, ["id"], size=SIZE)
    assert sorted(map(tuple, other.nodes.collect())) == sorted(map(tuple, model.nodes.collect()))


def test_trees(model):
    root = model.nodes.filter("node = 0").agg(F.min("size"), F.max("size"), F.count("*")).first()
    assert tuple(root) == (256, 256, 100)
    leaves = model.nodes.filter("feature < 0").groupBy("tree").agg(F.sum("size").alias("n"))
    assert leaves.filter("n <> 256").isEmpty()
    assert model.nodes.agg(F.max("depth")).first()[0] == 8


@pytest.mark.parametrize("n", [100, 3000, 60000])
def test_samples_are_full(spark, n):
    """Small tables go in whole; larger ones give every tree its rows, spread evenly."""
    size = ForestSize(trees=20)
    df = spark.range(n)
    drawn = tree_samples(df, ["id"], n, size, [])
    per = drawn.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d")).collect()
    assert len(per) == 20 and {(r.n, r.d) for r in per} == {(min(n, 256), min(n, 256))}
    mean = drawn.agg(F.avg("id")).first()[0] / n
    assert mean == pytest.approx(0.5, abs=0.03)


def test_scores_follow_the_paper(spark, points, model):
    """One row's score recomputed by walking the node table."""
    stats = sorted(tuple(r) for r in model.stats.collect())
    nodes = {(r.tree, r.node): r for r in model.nodes.collect()}
    row = points.filter("id = 3").first()
    x = [row[f] if row[f] is not None else median for _, f, median, _, _ in stats]
    depths = []
    for tree in range(SIZE.trees):
        node = nodes[tree, 0]
        while node.feature >= 0:
            node = nodes[tree, 2 * node.node + (1 if x[node.feature] <= node.threshold else 2)]
        depths.append(node.depth + average_path(node.size))
    want = -(2 ** (-np.mean(depths) / average_path(256))) - model.meta.first().offset
    got = anomaly.score_anomaly(points, model).filter("id = 3").first().anomaly_score
    assert got == pytest.approx(want)


def test_model_tables(spark, points, model, tmp_path):
    anomaly.save_model(model, str(tmp_path))
    loaded = anomaly.load_model(spark, str(tmp_path))
    columns = ["id", "anomaly_score", "is_anomaly"]  # the points hold a NaN, which equals nothing
    first = anomaly.score_anomaly(points, model).select(columns).orderBy("id").collect()
    assert anomaly.score_anomaly(points, loaded).select(columns).orderBy("id").collect() == first


def test_missing_features(points, model):
    with pytest.raises(ValueError, match=r"\['z'\]"):
        anomaly.fit_anomaly(points, ["a", "z"], ["id"])
    with pytest.raises(ValueError, match=r"\['b'\]"):
        anomaly.score_anomaly(points.drop("b"), model)


def test_average_path():
    assert [average_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert average_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_one_hash_inside_and_outside_of_queries(spark):
    rows = spark.range(50).select("id", share_of(F.lit(42), "id", F.lit(1)).alias("u")).collect()
    assert [node_share(42, r.id, 1) for r in rows] == [r.u for r in rows]


def test_jumps_draw_as_often_as_independent_trials(spark):
    """Rows per tree and trees per row, on a table where a row is in several trees."""
    size, n = ForestSize(trees=60, sample=200), 2000  # p = 0.16
    drawn = tree_samples(spark.range(n), ["id"], n, size, [])
    assert drawn.groupBy("tree").count().agg(F.min("count"), F.max("count"), F.count("*")).first()[:] == (200, 200, 60)
    assert drawn.select("tree", "id").distinct().count() == 60 * 200
    per_row = drawn.groupBy("id").count().agg(F.avg("count"), F.stddev_samp("count")).first()
    assert per_row[0] == pytest.approx(60 * 200 / n, rel=0.03) and per_row[1] == pytest.approx((6 * 0.9) ** 0.5, rel=0.15)


def test_quantiles_with_sketches_of_parts(spark):
    """Exact with current sketches, with those of other rows, and with hints that miss altogether."""
    rng = np.random.default_rng(9)
    n = 20_000
    columns = {
        "spread": rng.normal(size=n),
        "steps": np.floor(rng.normal(size=n) * 2),
        "tail": rng.pareto(0.5, n),
        "gaps": np.where(rng.random(n) < 0.6, np.nan, rng.random(n)),
        "none": np.full(n, np.nan),
        "one": np.full(n, 3.0),
    }
    rows = [(i % 9, *map(float, r)) for i, r in enumerate(zip(*columns.values(), strict=True))]
    df = materialise(spark.createDataFrame(rows, "part int, " + ", ".join(f"{c} double" for c in columns)), "numbers")
    parts = materialise(sketches.part_sketches(df, list(columns), F.col("part").cast("string")), "sketches")
    assert parts.count() == 9 * len(columns)
    for q in (0.0, 0.03, 0.5, 0.97, 1.0):
        wanted = dict.fromkeys(columns, q)
        near = sketches.brackets(parts, wanted)
        assert set(near) == set(columns) - {"none"}
        stale = sketches.brackets(parts.filter("part < '2'"), wanted)
        wrong = {c: (1e9, 2e9) for c in columns} | {"steps": (-1e9, -1e8)}
        for hints in (near, stale, wrong):
            got = exact_quantiles(df, wanted, 500, hints)
            for c, values in columns.items():
                want = np.nanquantile(values, q) if c != "none" else None
                assert got[c] == (pytest.approx(want, rel=1e-12, abs=1e-12) if want is not None else None), (c, q)
    low, high = sketches.brackets(parts, {"spread": 0.5})["spread"]
    share = ((columns["spread"] >= low) & (columns["spread"] <= high)).mean()
    assert 0.005 < share < 0.04  # what is left to look at after the counting pass


def test_refit_after_a_changed_month(spark, tmp_path):
    """Only the changed month is sketched anew; the statistics are those of all rows."""
    root = str(tmp_path)
    made = lambda low, n, x: spark.range(low, low + n).selectExpr(
        "id", "date_add(date'2025-01-01', cast(id % 90 as int)) AS observed_date", f"id * {x} AS a", "id % 7 * 1.0D AS b"
    )
    rows = materialise(made(0, 900, "1.5D"), "rows")
    anomaly.store_sketches(rows, root, features=["a", "b"])
    before = snapshot(spark, root).tables[anomaly.SKETCHES].parts
    fresh = materialise(rows.filter("month(observed_date) != 2").union(made(5000, 300, "2D").filter("month(observed_date) = 2")), "fresh")
    stored = anomaly.store_sketches(fresh.filter("month(observed_date) = 2"), root, features=["a", "b"], months=["2025-02"])
    after = snapshot(spark, root).tables[anomaly.SKETCHES].parts
    assert [m for m in after if after[m] != before[m]] == ["2025-02"]
    assert stored.agg(F.sum("n")).first()[0] == 2 * fresh.count()
    assert anomaly.impute_scale_stats(fresh, ["a", "b"], stored) == anomaly.impute_scale_stats(fresh, ["a", "b"])
