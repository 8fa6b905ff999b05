import re
import time

import numpy as np
import pytest
from helpers import make_panel, month
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from zonalis.operators import anomaly, evaluation, explain, forecasting, models, search
from zonalis.plans import jobs
from zonalis.session import fresh_path
from zonalis.sources import panel as io


@pytest.fixture(scope="module")
def table(spark):
    return jobs.model_table(make_panel(spark))


def test_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ [1.5, -2.0, 0.5] + 4 + rng.normal(0, 0.3, 200)
    pdf = list(zip(x.tolist(), y.tolist()))
    df = spark.createDataFrame(pdf, "x array<double>, y double").select(
        array_to_vector("x").alias("features"), "y"
    )
    for alpha in (0.1, 100.0):
        model = models.ridge(df, alpha).fit(df)
        xc, yc = x - x.mean(0), y - y.mean()
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert model.coefficients.toArray() == pytest.approx(want, abs=1e-8)


def test_scaling_has_train_mean_zero_and_std_one(spark):
    panel = make_panel(spark, zones=3, months=24)
    scaled = models.standard_scale(panel, panel, ["rainfall_mm", "temperature_c"])
    row = scaled.agg(F.avg("rainfall_mm_z"), F.stddev_pop("rainfall_mm_z")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1)
    constant = models.standard_scale(panel.withColumn("c", F.lit(3.0)), panel.withColumn("c", F.lit(3.0)), ["c"])
    assert constant.agg(F.max(F.abs("c_z"))).first()[0] == 0.0


def test_regressors_learn(table):
    _, train, test = table
    for name, params in [
        ("Ridge_Regression", {"alpha": 1.0}),
        ("Random_Forest", {"numTrees": 20, "maxDepth": 6}),
        ("Gradient_Boosting", {"maxIter": 10, "maxDepth": 3}),
    ]:
        model = search.regressor(name, train, params).fit(train)
        row = evaluation.regression_metrics(models.predict(model, test, name)).first()
        assert row.R2 > 0.7, (name, row)


def test_classifiers_learn_and_give_probabilities(table):
    _, train, test = table
    for name, params in [("Logistic_Regression", {"C": 1.0}), ("One_vs_Rest_Boosting", {"maxIter": 3, "maxDepth": 2})]:
        scored = models.predict_class(search.classifier(name, train, params).fit(train), test, name)
        accuracy = scored.agg(F.avg((F.col("y") == F.col("p")).cast("double"))).first()[0]
        assert accuracy > 0.7, name
        sums = scored.select(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x).alias("s"))
        assert sums.agg(F.max(F.abs(F.col("s") - 1))).first()[0] < 1e-9
    maps = models.risk_scores(scored).first()
    assert set(maps.probabilities) == {"Low", "Medium", "High"}


def test_untrained_class_has_no_chance(table):
    _, train, test = table
    known, held = train.filter("risk < 2"), test.filter("risk < 2")
    rows = models.predict_class(models.logit(known).fit(known), held, "two").collect()
    assert rows and all(len(r.probability) == 3 and r.probability[2] == 0.0 for r in rows)


def test_search_draws_are_capped_and_scored(table):
    _, train, _ = table
    assert len(search.draw({"alpha": [0.1, 1.0, 10.0, 100.0]}, 20)) == 4
    scores = search.search_regressor("Ridge_Regression", train, folds=2)
    assert len(scores) == 4 and all(s["folds"] == 2 and s["score"] > 0 for s in scores)


def test_importances_name_a_level_lag(table):
    _, train, test = table
    top = explain.top_features(train, models.forest_regressor(numTrees=20, maxDepth=6).fit(train), 5).collect()
    assert len(top) == 5 and any(r.feature.startswith("gw_lag_") for r in top)
    moved = explain.permutation_importance(models.forest_classifier(numTrees=10, maxDepth=5).fit(train), test)
    rows = moved.collect()
    assert len(rows) == 20 and rows[0].importance >= rows[-1].importance >= 0


def test_classification_job_leaves_counts_importances_and_explanations(spark, table):
    effort = {"draws": 1, "folds": 2, "grids": {
        "Logistic_Regression": {"C": [1.0]}, "RF_Classifier": {"numTrees": [5], "maxDepth": [4]},
        "One_vs_Rest_Boosting": {"maxIter": [2], "maxDepth": [2]}}}
    path = fresh_path(spark, "artefacts")
    board = jobs.train_classifiers(table, effort, path)
    assert board.select("model").distinct().count() == 3
    tests = table[2].count()
    for name in search.CLASSIFIERS:
        cells = spark.read.parquet(f"{path}/CLS_{name}_confusion")
        assert cells.count() == 9 and cells.agg(F.sum("n")).first()[0] == tests
        parts = spark.read.parquet(f"{path}/CLS_{name}_explanation").collect()
        assert 0 < len(parts) <= 20 and max(r.mean_abs for r in parts) > 0
        assert all(np.isfinite(r.mean_abs) for r in parts)
    top = spark.read.parquet(f"{path}/CLS_RF_Classifier_importances")
    assert top.count() == 15 and top.agg(F.sum("importance")).first()[0] <= 1 + 1e-9
    model = models.logit(table[1]).fit(table[1])
    [first, *_] = explain.class_contributions(model, table[1], table[2], 2).collect()
    slot = explain.feature_names(table[1]).index(first.feature)
    x = [np.array([r.features.toArray()[slot] for r in t.select("features").collect()]) for t in table[1:]]
    assert first.mean_abs == pytest.approx(np.abs(model.coefficientMatrix.toArray()[2, slot] * (x[1] - x[0].mean())).mean())


def test_linear_contributions_by_hand(spark):
    train = spark.createDataFrame([(1.0, 0.0), (3.0, 0.0)], "a double, b double")
    test = spark.createDataFrame([(4.0, 1.0), (0.0, 1.0)], "a double, b double")
    rows = explain.linear_contributions(test, train, {"a": 2.0, "b": -1.0}).collect()
    assert [(r.feature, r.mean_abs) for r in rows] == [("a", 4.0), ("b", 1.0)]


def test_saved_pipeline_predicts_the_same(spark):
    train, test = jobs.split_features(make_panel(spark, zones=3, months=72))
    prep = models.prepare(train)
    known = models.prepared(train, prep)
    model = models.with_model(prep, models.ridge(known).fit(known))
    path = fresh_path(spark, "model")
    io.save_model(model, path)
    pick = lambda mo: [r.prediction for r in mo.transform(test).orderBy("zone", "date").collect()]
    assert pick(model) == pick(io.load_model(path))


def test_the_zone_encoding_is_the_one_asked_for(spark):
    train, test = jobs.split_features(make_panel(spark, zones=6, months=72))
    assert models.prepare(train, zone="hash", slots=4).transform(test).first()["zone_vector"].size == 4
    assert models.prepare(train).transform(test).first()["zone_vector"].size == 7
    with pytest.raises(ValueError):
        models.prepare(train, zone="other")


def test_a_stored_detector_scores_new_rows(spark):
    panel = make_panel(spark, zones=3, months=72)
    path = fresh_path(spark, "detector")
    anomaly.fit_detector(panel, path, trees=20)
    new = panel.filter("zone = 'Zone 1'").withColumn("zone", F.lit("Zone 9"))
    loaded = anomaly.apply_detector(new, anomaly.load_detector(spark, path))
    direct = anomaly.isolation_forest(panel, trees=20).filter("zone = 'Zone 1'")
    pick = lambda df: [(r.iso_score, r.iso_anomaly) for r in df.orderBy("date").collect()]
    assert pick(loaded) == pick(direct)


def test_hybrid_learns(spark):
    row = jobs.hybrid_metrics(make_panel(spark, months=72), test_years=1, trees=20, depth=6).first()
    assert row.n == 6 * 12 and row.R2 > 0.3


def walked(nodes, data):
    """Path lengths by following the node table, all rows that are not yet at a leaf at a time."""
    total = np.zeros(len(data))
    for _, tree in nodes.groupby("tree"):
        feature, cut, left, right, size = (tree[c].to_numpy() for c in ["feature", "cut", "left", "right", "size"])
        at, depth = np.zeros(len(data), int), np.zeros(len(data))
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            here = at[rows]
            below = data[rows, feature[here]] <= cut[here]
            at[rows] = np.where(below, left[here], right[here])
            depth[rows] += 1
        total += depth + anomaly.mean_path(size[at])
    return total


def test_path_lengths_are_those_of_the_node_table_at_half_the_time(spark):
    rng = np.random.default_rng(5)
    sample = [(t, *map(float, rng.normal(size=3))) for t in range(20) for _ in range(256)]
    sample += [(20, 1.0, 1.0, 1.0)] * 5  # a tree that is one leaf
    columns = ["a", "b", "c"]
    nodes = anomaly.grow_trees(spark.createDataFrame(sample, "tree int, a double, b double, c double"), columns).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    data = rng.normal(size=(10_000, 3))
    data[0], data[1] = np.inf, -np.inf
    trees = anomaly.padded_trees(nodes.sample(frac=1.0, random_state=1))
    turned = np.ascontiguousarray(data.T)

    def least(work):
        times = []
        for _ in range(5):
            begun = time.process_time()
            work()
            times.append(time.process_time() - begun)
        return min(times)

    assert anomaly.path_lengths(turned, trees) == pytest.approx(walked(nodes, data), abs=1e-9)
    assert least(lambda: anomaly.path_lengths(turned, trees)) < 0.5 * least(lambda: walked(nodes, data))


def test_scores_take_nulls_as_zero_and_keep_other_columns(spark):
    rows = [("A", 1, 1.0, "x"), (None, None, float("nan"), None), ("B", 0, 0.0, "y")]
    df = spark.createDataFrame(rows, "zone string, a int, b double, other string")
    nodes = spark.createDataFrame(
        [(0, 0, 0, 0.5, 1, 2, 3), (0, 1, -1, 0.0, -1, -1, 2), (0, 2, -1, 0.0, -1, -1, 1)], anomaly.NODE_SCHEMA
    )
    got = anomaly.score_rows(df, nodes, ["a", "b"], 3)
    assert got.columns == ["zone", "a", "b", "other", "iso_score"]
    one, none, zero = (got.filter(f"zone <=> {z}").first() for z in ("'A'", "null", "'B'"))
    assert none.iso_score == zero.iso_score < one.iso_score
    assert none.a is None and none.other is None and np.isnan(none.b) and one.other == "x"


def test_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(7)
    rows = [("A", month(i), *map(float, rng.normal(0, 1, 3))) for i in range(400)]
    for k in range(8):
        rows[k * 50] = ("A", month(k * 50), 9.0 + k, -9.0, 9.0)
    df = spark.createDataFrame(
        rows, "zone string, date date, groundwater_level double, rainfall_mm double, temperature_c double"
    )
    got = anomaly.isolation_forest(df.repartition(3))
    flagged = got.filter("iso_anomaly = 1")
    assert flagged.filter("rainfall_mm = -9").count() == 8
    assert flagged.count() == 20
    again = {(r.date, r.iso_score) for r in anomaly.isolation_forest(df.repartition(1)).collect()}
    assert again == {(r.date, r.iso_score) for r in got.collect()}


def ar_series(phi, n, seed, zone, mean=0.0):
    rng = np.random.default_rng(seed)
    w = np.zeros(n)
    for t in range(2, n):
        w[t] = phi[0] * w[t - 1] + phi[1] * w[t - 2] + rng.normal()
    return [(zone, month(t), float(w[t] + mean)) for t in range(n)]


def test_order_fits_shuffle_rows_by_zone_only(spark):
    rows = [row for z in "AB" for row in ar_series((0.6, 0.2), 60, ord(z), z)]
    df = spark.createDataFrame(rows, "zone string, date date, groundwater_level double")
    regular = forecasting.regular_series(df).withColumn("fit_rows", F.col("series_rows"))
    fits = forecasting.candidate_fits(regular)
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", fits._jdf.queryExecution().executedPlan().toString())
    assert dealt and all(re.fullmatch(r"zone#\d+", keys) for keys in dealt)
    assert len(dealt) <= 2  # the rows, once for the long fits and once for the residuals
    assert fits.count() == 2 * 17


def test_series_without_long_lags_or_zone_walk(spark):
    """Sums of a fit take only rows with all lags; short series and those without a zone have no fit."""
    long = ar_series((0.5, 0.1), 40, 1, "long")
    short = [("short", month(t), float(t * t)) for t in range(6)]
    none = [(None, day, x) for _, day, x in ar_series((0.5, 0.1), 40, 2, "")]
    regular = spark.createDataFrame(
        [(z, day, x, i % 40 + 1, 40) for i, (z, day, x) in enumerate(long + none)]
        + [(z, day, x, i + 1, 6) for i, (z, day, x) in enumerate(short)],
        "zone string, date date, groundwater_level double, row_in_series int, fit_rows int",
    )
    best = {row.zone: row for row in forecasting.best_orders(forecasting.candidate_fits(regular)).collect()}
    assert best["long"].aic is not None
    for zone, last in (("short", 25.0), (None, none[-1][2])):
        assert (best[zone].p, best[zone].d, best[zone].q, best[zone].aic) == (0, 1, 0, None)
        assert best[zone].state.x == last
    values = np.array([x for *_, x in long])
    steps = {0: values, 1: np.diff(values)}
    fits = {(row.p, row.d, row.q): row for row in forecasting.candidate_fits(regular).filter("zone = 'long'").collect()}
    for d, w in steps.items():
        lagged = np.array([w[i - 6 : i][::-1] for i in range(6, len(w))])
        weights = np.linalg.lstsq(lagged, w[6:], rcond=None)[0]
        e = w[6:] - lagged @ weights
        state = fits[1, d, 1].state
        assert (state.w1, state.w2) == pytest.approx((w[-1], w[-2]))
        assert (state.e1, state.e2) == pytest.approx((e[-1], e[-2]), abs=1e-9)
        at = np.arange(9, 40) - d  # rows 10 to 40 of the series
        x = np.column_stack([w[at - 1], e[at - 7]])
        want = np.linalg.lstsq(x, w[at], rcond=None)[0]
        assert fits[1, d, 1].n == 31
        assert [fits[1, d, 1].weights[1], fits[1, d, 1].weights[3]] == pytest.approx(want, abs=1e-8)


def test_order_weights_recover_an_autoregression(spark):
    df = spark.createDataFrame(
        ar_series((0.6, 0.25), 1200, 1, "ar2"), "zone string, date date, groundwater_level double"
    )
    regular = forecasting.regular_series(df).withColumn("fit_rows", F.col("series_rows"))
    fits = forecasting.candidate_fits(regular)
    assert fits.count() == 17
    row = fits.filter("p = 2 and d = 0 and q = 0").first()
    assert row.weights[1] == pytest.approx(0.6, abs=0.08) and row.weights[2] == pytest.approx(0.25, abs=0.08)
    best = forecasting.best_orders(fits).first()
    assert best.p == 2 or best.q > 0


def test_forecasts_beat_the_mean_and_short_series_walk(spark):
    rows = ar_series((0.95, 0.0), 400, 4, "long") + [("short", month(i), 5.0 + i) for i in range(4)]
    df = spark.createDataFrame(rows, "zone string, date date, groundwater_level double")
    future = forecasting.future(df, 6).orderBy("zone", "date").collect()
    assert len(future) == 12
    short = [r for r in future if r.zone == "short"]
    assert [r.predicted_gw for r in short] == [8.0] * 6 and short[0].date == month(4)
    scored = forecasting.backtest(df)
    assert scored.filter("zone = 'long'").count() == 80


def test_direct_steps_predict(spark):
    scored = models.direct_multistep(make_panel(spark)).withColumn("model", F.col("step").cast("string"))
    rows = {r.model: r for r in evaluation.regression_metrics(scored).collect()}
    assert set(rows) == {"1", "2", "3"} and rows["1"].R2 > 0.5


def test_run_all_switches(spark):
    out = jobs.run_all(make_panel(spark, zones=3), steps=["arima", "spatial"], zones=["Zone 1"], effort=jobs.QUICK)
    rows = out.collect()
    assert {r.step for r in rows} == {"arima", "spatial"}
    assert {r.item for r in rows if r.step == "arima"} == {"ARIMA_Zone 1"}
