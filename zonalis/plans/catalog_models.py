"""Registered queries: fitted models, forests, forecasts and whole jobs.

Most fits have no SQL counterpart, so these are checked by tests on learnable data. They run on
the whole nation panel, with small search grids (``jobs.QUICK``) where a search is needed.
"""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.operators import (
    anomaly,
    boosting,
    evaluation,
    explain,
    forecasting,
    likelihood,
    models,
    search,
    trees,
    whatif,
)
from zonalis.plans import jobs
from zonalis.plans.base import over_customers, over_panel, r, shown
from zonalis.plans.catalog_scalar import W
from zonalis.plans.catalog_windows import FILLED
from zonalis.session import fresh_path, stage
from zonalis.sources import panel as io
from zonalis.sources.tables import customer_panel, event_series, zone_panel

FOREST = {"numTrees": 50, "maxDepth": 8}
BOOSTED = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1}


def _tables(spark, sf_dir):
    return jobs.model_table(zone_panel(spark, sf_dir))


def _metrics(scored):
    return shown(stage(evaluation.regression_metrics(scored), "metrics"), 6, "RMSE", "MAE", "R2")


def _report(scored):
    report = evaluation.classification_report(scored, by=("model",))
    return shown(stage(report, "report"), 6, "precision", "recall", "f1")


def _regressor(spark, sf_dir, name, make):
    _, train, test = _tables(spark, sf_dir)
    result = _metrics(models.predict(make(train).fit(train), test, name))
    train.unpersist()
    test.unpersist()
    return result


def _classifier(spark, sf_dir, name, make):
    _, train, test = _tables(spark, sf_dir)
    result = _report(models.predict_class(make(train).fit(train), test, name))
    train.unpersist()
    test.unpersist()
    return result


def ridge_eval(spark, sf_dir):
    return _regressor(spark, sf_dir, "Ridge_Regression", lambda train: models.ridge(train, 1.0))


def ridge_coefficients(spark, sf_dir):
    """Weights of level on rain and temperature over the whole panel for every penalty."""
    columns = ["rainfall_mm", "temperature_c"]
    rows = customer_panel(spark, sf_dir).select(F.col("groundwater_level").alias("y"), *columns)
    table = stage(VectorAssembler(inputCols=columns, outputCol="features").transform(rows).select("y", "features"))
    fits = []
    for alpha in fixed.RIDGE_ALPHAS:
        model = models.ridge(table, alpha).fit(table)
        fits.append((alpha, *(float(w) for w in model.coefficients), float(model.intercept)))
    out = spark.createDataFrame(fits, "alpha double, rain_weight double, temp_weight double, intercept double")
    return shown(out, 6, "rain_weight", "temp_weight", "intercept")


def rf_eval(spark, sf_dir):
    return _regressor(spark, sf_dir, "Random_Forest", lambda _: models.forest_regressor(**FOREST))


def gbt_eval(spark, sf_dir):
    return _regressor(spark, sf_dir, "Gradient_Boosting", lambda _: models.boosted_regressor(**BOOSTED))


def gbt_colsample_eval(spark, sf_dir):
    params = {**BOOSTED, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
    return _regressor(spark, sf_dir, "Column_Sampled_Boosting", lambda _: models.boosted_regressor(**params))


def logit_eval(spark, sf_dir):
    return _classifier(spark, sf_dir, "Logistic_Regression", lambda train: models.logit(train, 1.0))


def rf_cls_eval(spark, sf_dir):
    return _classifier(spark, sf_dir, "RF_Classifier", lambda _: models.forest_classifier(**FOREST))


def gbt_cls_eval(spark, sf_dir):
    params = {"maxIter": 8, "maxDepth": 3, "stepSize": 0.1}
    return _classifier(spark, sf_dir, "One_vs_Rest_Boosting", lambda _: models.boosted_classifier(**params))


def random_search(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    scores = search.search_regressor("Ridge_Regression", train)
    train.unpersist()
    test.unpersist()
    return shown(search.as_rows(spark, scores), 6, "score")


def ridge_search(spark, sf_dir):
    """Errors of every penalty on five expanding folds over all customer months, from one pass."""
    columns = ["rainfall_mm", "temperature_c"]
    rows = customer_panel(spark, sf_dir).select("date", F.col("groundwater_level").alias("y"), *columns)
    table = stage(VectorAssembler(inputCols=columns, outputCol="features").transform(rows).select("date", "y", "features"))
    return shown(search.ridge_search(table), 5, "rmse")


def top_features(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    rows = explain.top_features(train, models.forest_regressor(**FOREST).fit(train))
    train.unpersist()
    test.unpersist()
    return rows


def perm_importance(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    model = models.forest_classifier(numTrees=20, maxDepth=6).fit(train)
    rows = stage(explain.permutation_importance(model, test), "importance")
    train.unpersist()
    test.unpersist()
    return rows


def _explained(spark, sf_dir, make):
    """A tree model of the panel, its node arrays, and the test rows."""
    _, train, test = _tables(spark, sf_dir)
    model = make().fit(train)
    names = explain.feature_names(train)
    kept = stage(test, "test")
    train.unpersist()
    test.unpersist()
    return model, trees.from_model(model, spark), kept, names


def tree_contributions(spark, sf_dir):
    """The 20 features with the largest mean contribution to the probability of high risk, on all test rows."""
    _, ensemble, test, names = _explained(spark, sf_dir, lambda: models.forest_classifier(**FOREST))
    high = fixed.RISK_LABELS.index("High")
    return shown(trees.mean_contributions(trees.explain(ensemble, test, high), names), 9, "mean_abs")


def tree_contribution_facts(spark, sf_dir):
    """Per test row: contributions add up to the model's own output less the expectation, for a forest's
    probability of high risk and for a boosted level."""
    high, found = fixed.RISK_LABELS.index("High"), []
    for name, make, output in [("forest", lambda: models.forest_classifier(**FOREST), high),
                               ("boosted", lambda: models.boosted_regressor(**BOOSTED), 0)]:
        model, ensemble, test, _ = _explained(spark, sf_dir, make)
        scored = model.transform(test)
        own = models.probabilities(scored)[high] if name == "forest" else F.col("prediction")
        rows = trees.explain(ensemble, scored.withColumn("own", own), output, keep=("zone", "date", "own"))
        total = F.aggregate("contributions", F.col("base"), lambda a, x: a + x)
        found.append(rows.select(F.lit(name).alias("model"), "zone", "date", (F.abs(total - F.col("own")) < 1e-9).cast("int").alias("adds_up")))
    return found[0].unionByName(found[1])


STUMP_COLUMNS = ["month", "year", "is_coastal", "soil_permeability"]


def boosted_stump(spark, sf_dir):
    """The one split of a single second-order tree over all customer months, and the levels on its sides."""
    rows = customer_panel(spark, sf_dir).select(
        "zone", "date", F.month("date").alias("month"), F.year("date").alias("year"), "is_coastal", "soil_permeability",
        F.col("groundwater_level").alias("y"))
    table = VectorAssembler(inputCols=STUMP_COLUMNS, outputCol="features").transform(rows)
    [model] = boosting.fit(table, boosting.Settings(rounds=1, depth=1, rate=1.0))
    t = model.trees
    levels = [float(t.offset[0] + t.value[side[0], 0]) for side in (t.left, t.right)]
    found = [(STUMP_COLUMNS[int(t.feature[0])], float(t.threshold[0]), *levels)]
    return shown(spark.createDataFrame(found, "feature string, threshold double, low_level double, high_level double"),
                 5, "low_level", "high_level")


def second_order_eval(spark, sf_dir):
    """Second-order boosting of the level with subsets of rows and features."""
    _, train, test = _tables(spark, sf_dir)
    [model] = boosting.fit(train, boosting.Settings(rounds=40, depth=4, subsample=0.8, columns=0.8))
    train.unpersist()
    test.unpersist()
    return _metrics(boosting.predict(model, test, "Second_Order_Boosting"))


def softmax_eval(spark, sf_dir):
    """One ensemble over the three classes."""
    _, train, test = _tables(spark, sf_dir)
    [model] = boosting.fit(train, boosting.Settings(rounds=20, depth=3), label="risk", classes=len(fixed.RISK_LABELS))
    train.unpersist()
    test.unpersist()
    return _report(boosting.predict(model, test, "Softmax_Boosting"))


def boosting_search(spark, sf_dir):
    """Draws from the column-sampled grid, each on every expanding fold, grown in the same passes."""
    _, train, test = _tables(spark, sf_dir)
    found = search.search_boosting(train, draws=4, folds=3, most_rounds=12)
    train.unpersist()
    test.unpersist()
    return shown(search.as_rows(spark, found), 6, "score")


def model_roundtrip(spark, sf_dir):
    """Predictions of a pipeline before and after saving and loading it."""
    train, test = jobs.split_features(zone_panel(spark, sf_dir))
    prep = models.prepare(train)
    known = models.prepared(train, prep)
    model = models.with_model(prep, models.ridge(known).fit(known))
    path = fresh_path(spark, "model")
    io.save_model(model, path)
    before = model.transform(test).select("zone", "date", F.col("prediction").alias("before"))
    after = io.load_model(path).transform(test).select("zone", "date", F.col("prediction").alias("after"))
    both = before.join(after, ["zone", "date"])
    return both.select("zone", "date", (F.col("before") == F.col("after")).cast("int").alias("same"))


def risk_scoring(spark, sf_dir):
    _, train, test = _tables(spark, sf_dir)
    model = models.logit(train).fit(train)
    scores = stage(models.risk_scores(models.predict_class(model, test, "Logistic_Regression")), "scores")
    train.unpersist()
    test.unpersist()
    return scores


def whatif_score(spark, sf_dir):
    """Every row of the panel as a request, scored for level and risk."""
    panel = stage(zone_panel(spark, sf_dir), "panel")
    train, _ = jobs.split_features(panel)
    prep = models.prepare(train)
    known = models.prepared(train, prep)
    level, risk = models.ridge(known).fit(known), models.logit(known).fit(known)
    vector = whatif.request_vector(whatif.requests_from(panel), whatif.zone_attributes(panel), panel)
    scored = level.transform(prep.transform(vector)).withColumnRenamed("prediction", "predicted_gw")
    classified = risk.transform(scored)
    chances = models.probabilities(classified)
    return classified.select(
        "zone",
        "year",
        "month",
        "predicted_gw",
        F.col("prediction").cast("int").alias("risk_code"),
        *[chances[i].alias(f"p_{name.lower()}") for i, name in enumerate(fixed.RISK_LABELS)],
    )


def hybrid_eval(spark, sf_dir):
    return shown(jobs.hybrid_metrics(zone_panel(spark, sf_dir), trees=50, depth=10), 6, "RMSE", "MAE", "R2")


def isolation_forest(spark, sf_dir):
    rows = stage(customer_panel(spark, sf_dir).select("zone", "date", *fixed.ANOMALY_FEATURES), "panel")
    return shown(anomaly.isolation_forest(rows), 9, "iso_score")


def detector_roundtrip(spark, sf_dir):
    """Every customer month: the saved and loaded detector flags what the fit on all rows flags."""
    rows = stage(customer_panel(spark, sf_dir).select("zone", "date", *fixed.ANOMALY_FEATURES), "panel")
    path = fresh_path(spark, "detector")
    anomaly.fit_detector(rows, path)
    loaded = anomaly.apply_detector(rows, anomaly.load_detector(spark, path))
    direct = anomaly.isolation_forest(rows).select("zone", "date", F.col("iso_anomaly").alias("direct"))
    both = loaded.join(direct, ["zone", "date"])
    return both.select("zone", "date", (F.col("iso_anomaly") == F.col("direct")).cast("int").alias("same"))


def isolation_facts(spark, sf_dir):
    """What must hold of the forest's output on all customer months."""
    rows = stage(customer_panel(spark, sf_dir).select("zone", "date", *fixed.ANOMALY_FEATURES), "panel")
    scored = anomaly.isolation_forest(rows)
    share = F.sum("iso_anomaly") <= fixed.CONTAMINATION * F.count(F.lit(1))
    inside = F.min("iso_score").between(0, 1) & F.max("iso_score").between(0, 1)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), share.cast("int").alias("share_kept"), inside.cast("int").alias("in_bounds")
    )


def risk_scoring_facts(spark, sf_dir):
    """What must hold of every scored row: chances that add up to one, and a known label."""
    scored = risk_scoring(spark, sf_dir)
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, x: a + x)
    sound = (F.abs(total - 1) < 0.002) & F.col("risk_label").isin(*fixed.RISK_LABELS)
    return scored.select("zone", "date", sound.cast("int").alias("sound"))


def forecast_facts(spark, sf_dir):
    """Months and distinct dates that each customer's forecast covers, and whether all are numbers."""
    rows = forecasting.future(customer_panel(spark, sf_dir), months=24)
    return rows.groupBy("zone").agg(
        F.count(F.lit(1)).alias("months"),
        F.countDistinct("date").alias("dates"),
        F.min((~F.isnan(rows[rows.columns[-1]])).cast("int")).alias("numbers"),
    )


def event_anomalies(spark, sf_dir):
    """The forest over daily event series, on their one measure."""
    return shown(
        anomaly.isolation_forest(stage(event_series(spark, sf_dir)), ["groundwater_level"]), 9, "iso_score"
    )


def anomaly_combined(spark, sf_dir):
    rows = stage(customer_panel(spark, sf_dir).select("zone", "date", *fixed.ANOMALY_FEATURES), "panel")
    flagged = anomaly.detect(rows, 1.5)
    return flagged.select("zone", "date", "iso_anomaly", "z_anomaly", "anomaly")


def anomaly_report(spark, sf_dir):
    return jobs.anomaly_report(zone_panel(spark, sf_dir), 1.5)


def arima_order(spark, sf_dir):
    return shown(forecasting.select_orders(customer_panel(spark, sf_dir)), 6, "aic")


def arima_ar_fits(spark, sf_dir):
    """The grid's candidates without residual terms and with at most one lag."""
    regular = forecasting.regular_series(zone_panel(spark, sf_dir)).withColumn("fit_rows", F.col("series_rows"))
    fits = forecasting.candidate_fits(regular).filter("q = 0 and p <= 1")
    weight = F.when(F.col("p") == 1, F.col("weights")[1])
    return shown(fits.select("zone", "p", "d", "q", "n", "aic", weight.alias("weight")), 6, "aic", "weight")


def likelihood_ar_fits(spark, sf_dir):
    """The same candidates by exact likelihood, whose optimum is the least-squares one there."""
    regular = forecasting.regular_series(zone_panel(spark, sf_dir)).withColumn("fit_rows", F.col("series_rows"))
    fits = likelihood.candidate_fits(regular).filter("q = 0 and p <= 1")
    weight = F.when(F.col("p") == 1, F.col("weights")[0])
    return shown(shown(fits.select("zone", "p", "d", "q", "n", "aic", weight.alias("weight")), 5, "aic"), 4, "weight")


def likelihood_facts(spark, sf_dir):
    """Every order of every zone: its criterion is no worse than that of the least-squares weights."""
    regular = forecasting.regular_series(zone_panel(spark, sf_dir)).withColumn("fit_rows", F.col("series_rows"))
    fits = likelihood.candidate_fits(regular)
    sound = (F.col("aic") <= F.coalesce("start_aic", F.lit(float("inf"))) + 1e-9) & F.col("aic").isNotNull()
    return fits.select("zone", "p", "d", "q", sound.cast("int").alias("not_worse"))


def likelihood_eval(spark, sf_dir):
    return shown(likelihood.backtest_metrics(zone_panel(spark, sf_dir)), 6, "RMSE", "MAE", "R2")


def likelihood_future(spark, sf_dir):
    return shown(likelihood.future(zone_panel(spark, sf_dir)), 6, "predicted_gw")


def arima_eval(spark, sf_dir):
    return shown(forecasting.backtest_metrics(zone_panel(spark, sf_dir)), 6, "RMSE", "MAE", "R2")


def arima_future(spark, sf_dir):
    return shown(forecasting.future(customer_panel(spark, sf_dir)), 6, "predicted_gw")


def forecast_files(spark, sf_dir):
    """Forecasts of the chosen orders, written as a folder per zone and read back, against those made."""
    made = stage(forecasting.future(zone_panel(spark, sf_dir), 24), "future")
    path = fresh_path(spark, "forecasts")
    io.write_forecasts(made, path)
    read = io.read_forecasts(spark, path).select("zone", "date", F.col("predicted_gw").alias("read"))
    both = made.join(read, ["zone", "date"], "left")
    return both.select("zone", "date", F.coalesce((F.col("read") == F.col("predicted_gw")).cast("int"), F.lit(0)).alias("same"))


def direct_multistep(spark, sf_dir):
    scored = models.direct_multistep(zone_panel(spark, sf_dir))
    return _metrics(scored.withColumn("model", F.concat(F.lit("step "), "step")))


def sequence_zone_metrics(spark, sf_dir):
    """Errors of the first step by zone, of a forecaster over whole windows and zones."""
    panel = stage(zone_panel(spark, sf_dir), "panel")
    scored = models.sequence_backtest(models.fit_sequences(panel), panel)
    return _metrics(scored.withColumn("model", F.col("zone")))


def sequence_future(spark, sf_dir):
    panel = stage(zone_panel(spark, sf_dir), "panel")
    return shown(models.sequence_recursion(models.fit_sequences(panel), panel), 6, "predicted_gw")


#: The oldest and the newest level of a window.
ENDS = [0, (fixed.HISTORY_ROWS - 1) * len(fixed.SEQUENCE_COVARIATES)]


def sequence_recursion(spark, sf_dir):
    """Forecasts that feed on themselves, of a pooled forecaster over the two ends of the window."""
    panel = stage(zone_panel(spark, sf_dir), "panel")
    model = models.fit_sequences(panel, entries=ENDS, zones=False)
    return shown(models.sequence_recursion(model, panel, 24), 5, "predicted_gw")


def regression_job(spark, sf_dir):
    table = _tables(spark, sf_dir)
    board = jobs.train_regressors(table, jobs.QUICK, fresh_path(spark, "models"))
    jobs.release(table)
    return shown(board, 6, "RMSE", "MAE", "R2")


def classification_job(spark, sf_dir):
    table = _tables(spark, sf_dir)
    board = jobs.train_classifiers(table, jobs.QUICK, fresh_path(spark, "models"))
    jobs.release(table)
    return shown(board, 6, "precision", "recall", "f1")


def run_all(spark, sf_dir):
    return shown(jobs.run_all(zone_panel(spark, sf_dir), effort=jobs.QUICK), 6, "value")


QUERIES = {
    f.__name__: f
    for f in [
        ridge_eval,
        ridge_coefficients,
        rf_eval,
        gbt_eval,
        gbt_colsample_eval,
        logit_eval,
        rf_cls_eval,
        gbt_cls_eval,
        random_search,
        ridge_search,
        top_features,
        perm_importance,
        tree_contributions,
        tree_contribution_facts,
        boosted_stump,
        second_order_eval,
        softmax_eval,
        boosting_search,
        model_roundtrip,
        risk_scoring,
        whatif_score,
        hybrid_eval,
        isolation_forest,
        event_anomalies,
        detector_roundtrip,
        isolation_facts,
        risk_scoring_facts,
        forecast_facts,
        anomaly_combined,
        anomaly_report,
        arima_order,
        arima_ar_fits,
        likelihood_ar_fits,
        likelihood_facts,
        likelihood_eval,
        likelihood_future,
        arima_eval,
        arima_future,
        forecast_files,
        direct_multistep,
        sequence_zone_metrics,
        sequence_future,
        sequence_recursion,
        regression_job,
        classification_job,
        run_all,
    ]
}

ORACLE = {
    "detector_roundtrip": over_customers("SELECT zone, date, 1 AS same FROM customers"),
    "isolation_facts": over_customers("SELECT count(*) AS n, 1 AS share_kept, 1 AS in_bounds FROM customers"),
    "risk_scoring_facts": over_panel(
        "SELECT zone, date, 1 AS sound FROM kept, (SELECT max(date) - INTERVAL 3 YEAR AS edge FROM kept) WHERE date > edge",
        f"""ranked AS (SELECT zone, date, risk_level, row_number() OVER {W} AS rn FROM panel),
        kept AS (SELECT zone, date FROM ranked WHERE rn > 12 AND risk_level IS NOT NULL)""",
    ),
    "boosted_stump": over_customers(
        f"""SELECT feature, threshold, {r('mu + s / (n + 1)', 5)} AS low_level,
        {r('mu + (all_s - s) / (all_n - n + 1)', 5)} AS high_level FROM (
          SELECT *, s * s / (n + 1) + (all_s - s) * (all_s - s) / (all_n - n + 1) - all_s * all_s / (all_n + 1) AS gain
          FROM (SELECT feature, j, v AS threshold, sum(s) OVER w AS s, sum(n) OVER w AS n, sum(s) OVER (PARTITION BY j) AS all_s,
              sum(n) OVER (PARTITION BY j) AS all_n, row_number() OVER (PARTITION BY j ORDER BY v DESC) AS back
            FROM cells WINDOW w AS (PARTITION BY j ORDER BY v)) WHERE back > 1), mean
        ORDER BY gain DESC, j, threshold LIMIT 1""",
        "mean AS (SELECT avg(groundwater_level) AS mu FROM customers)",
        """cells AS (SELECT feature, j, v, sum(groundwater_level - mu) AS s, count(*) AS n FROM (
          SELECT groundwater_level, unnest(['month', 'year', 'is_coastal', 'soil_permeability']) AS feature,
            unnest([0, 1, 2, 3]) AS j, unnest([month(date)::double, year(date)::double, is_coastal::double,
            soil_permeability]) AS v FROM customers), mean GROUP BY 1, 2, 3)""",
    ),
    "sequence_recursion": over_panel(
        f"""SELECT zone, step, cast(last_date + to_months(cast(step AS integer)) AS date) AS date,
          {r('x * (hi - lo) + lo', 5)} AS predicted_gw
        FROM (SELECT zone, last_date, lo, hi, unnest(out) AS x, unnest(range(1, 25)) AS step FROM path WHERE i = 8)""",
        "bounds AS (SELECT zone, min(groundwater_level) AS lo, max(groundwater_level) AS hi, max(date) AS last_date FROM panel GROUP BY zone)",
        f"""scaled AS (SELECT zone, date, lo, hi, last_date, (groundwater_level - lo) / (hi - lo) AS x,
          row_number() OVER {W} AS i, count(*) OVER (PARTITION BY zone) AS n FROM panel JOIN bounds USING (zone))""",
        f"""windows AS (SELECT zone, i, n, lag(x, 11) OVER {W} AS a, x AS b, lead(x, 1) OVER {W} AS t1, lead(x, 2) OVER {W} AS t2,
          lead(x, 3) OVER {W} AS t3 FROM scaled)""",
        """pooled AS (SELECT k, avg(a) AS ma, avg(b) AS mb, avg(t) AS mt, var_pop(a) * count(*) + 1 AS saa,
          var_pop(b) * count(*) + 1 AS sbb, covar_pop(a, b) * count(*) AS sab, covar_pop(a, t) * count(*) AS sat,
          covar_pop(b, t) * count(*) AS sbt
          FROM (SELECT a, b, unnest([1, 2, 3]) AS k, unnest([t1, t2, t3]) AS t FROM windows
            WHERE i >= 12 AND i + 3 <= floor(n * 0.8e0)) GROUP BY k)""",
        """form AS (SELECT max(wa) FILTER (k = 1) AS a1, max(wb) FILTER (k = 1) AS b1, max(c) FILTER (k = 1) AS c1,
          max(wa) FILTER (k = 2) AS a2, max(wb) FILTER (k = 2) AS b2, max(c) FILTER (k = 2) AS c2,
          max(wa) FILTER (k = 3) AS a3, max(wb) FILTER (k = 3) AS b3, max(c) FILTER (k = 3) AS c3
          FROM (SELECT *, mt - wa * ma - wb * mb AS c FROM (SELECT *, (sbb * sat - sab * sbt) / (saa * sbb - sab * sab) AS wa,
            (saa * sbt - sab * sat) / (saa * sbb - sab * sab) AS wb FROM pooled)))""",
        """path AS (SELECT zone, last_date, lo, hi, 0 AS i, list(x ORDER BY i) AS w, []::DOUBLE[] AS out FROM scaled
            WHERE i > n - 12 GROUP BY 1, 2, 3, 4
          UNION ALL SELECT zone, last_date, lo, hi, i + 1, list_concat(w[4:], y), list_concat(out, y)
          FROM (SELECT path.*, [c1 + a1 * w[1] + b1 * w[12], c2 + a2 * w[1] + b2 * w[12], c3 + a3 * w[1] + b3 * w[12]] AS y
            FROM path, form WHERE i < 8))""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "ridge_search": over_customers(
        f"""SELECT alpha, fold, {r('sqrt(avg((y - my - w1 * (x1 - m1) - w2 * (x2 - m2)) ** 2))', 5)} AS rmse
        FROM weights JOIN ranked ON rank >= first AND rank < first + size GROUP BY alpha, fold""",
        """ranked AS (SELECT rainfall_mm AS x1, temperature_c AS x2, groundwater_level AS y,
          dense_rank() OVER (ORDER BY date) - 1 AS rank FROM customers)""",
        """folds AS (SELECT fold, n - (6 - fold) * (n // 6) AS first, n // 6 AS size
          FROM (SELECT count(DISTINCT date) AS n FROM customers), (SELECT unnest([1, 2, 3, 4, 5]) AS fold))""",
        """sums AS (SELECT fold, first, size, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) * count(*) AS s11,
          var_pop(x2) * count(*) AS s22, covar_pop(x1, x2) * count(*) AS s12, covar_pop(x1, y) * count(*) AS b1,
          covar_pop(x2, y) * count(*) AS b2 FROM folds JOIN ranked ON rank < first GROUP BY 1, 2, 3)""",
        """weights AS (SELECT *, ((s22 + alpha) * b1 - s12 * b2) / det AS w1, ((s11 + alpha) * b2 - s12 * b1) / det AS w2
          FROM (SELECT *, (s11 + alpha) * (s22 + alpha) - s12 * s12 AS det
            FROM sums, (SELECT unnest([0.1e0, 1e0, 10e0, 100e0]) AS alpha)))""",
    ),
    "tree_contribution_facts": over_panel(
        """SELECT model, zone, date, 1 AS adds_up FROM kept, (SELECT max(date) - INTERVAL 3 YEAR AS edge FROM kept),
        (VALUES ('forest'), ('boosted')) AS m(model) WHERE date > edge""",
        f"""ranked AS (SELECT zone, date, risk_level, row_number() OVER {W} AS rn FROM panel),
        kept AS (SELECT zone, date FROM ranked WHERE rn > 12 AND risk_level IS NOT NULL)""",
    ),
    "forecast_files": over_panel(
        """SELECT zone, cast(unnest(generate_series(max(date) + INTERVAL 1 MONTH, max(date) + INTERVAL 24 MONTH,
        INTERVAL 1 MONTH)) AS date) AS date, 1 AS same FROM panel GROUP BY zone"""
    ),
    "forecast_facts": over_customers(
        "SELECT zone, 24 AS months, 24 AS dates, 1 AS numbers FROM customers GROUP BY zone"
    ),
    "model_roundtrip": over_panel(
        """SELECT zone, date, 1 AS same FROM kept, (SELECT max(date) - INTERVAL 3 YEAR AS edge FROM kept)
        WHERE date > edge""",
        f"""ranked AS (SELECT zone, date, risk_level, row_number() OVER {W} AS rn FROM panel),
        kept AS (SELECT zone, date FROM ranked WHERE rn > 12 AND risk_level IS NOT NULL)""",
    ),
    "ridge_coefficients": over_customers(
        f"""SELECT alpha, {r('w1', 6)} AS rain_weight, {r('w2', 6)} AS temp_weight,
        {r('my - w1 * m1 - w2 * m2', 6)} AS intercept
        FROM (SELECT *, ((s22 + alpha) * b1 - s12 * b2) / det AS w1, ((s11 + alpha) * b2 - s12 * b1) / det AS w2
          FROM (SELECT *, (s11 + alpha) * (s22 + alpha) - s12 * s12 AS det
            FROM sums, (SELECT unnest([0.1e0, 1e0, 10e0, 100e0]) AS alpha)))""",
        """sums AS (SELECT avg(rainfall_mm) AS m1, avg(temperature_c) AS m2, avg(groundwater_level) AS my,
        var_pop(rainfall_mm) * count(*) AS s11, var_pop(temperature_c) * count(*) AS s22,
        covar_pop(rainfall_mm, temperature_c) * count(*) AS s12,
        covar_pop(rainfall_mm, groundwater_level) * count(*) AS b1,
        covar_pop(temperature_c, groundwater_level) * count(*) AS b2 FROM customers)""",
    ),
    "arima_ar_fits": over_panel(
        f"""SELECT zone, 0 AS p, 1 AS d, 0 AS q, n, {r('n * ln(ww / n) + 2', 6)} AS aic, NULL AS weight
        FROM sums WHERE d = 1 UNION ALL
        SELECT zone, 1, d, 0, n, {r('n * ln((ww - c * c / v) / n) + 4', 6)}, {r('c / v', 6)} FROM sums""",
        "kept AS (SELECT zone, date, groundwater_level AS v FROM panel)",
        FILLED,
        f"""numbered AS (SELECT zone, date, x, x - lag(x) OVER {W} AS dx, row_number() OVER {W} AS rn FROM filled),
        pairs AS (SELECT zone, 0 AS d, rn, x AS w, lag(x) OVER {W} AS w1 FROM numbered
          UNION ALL SELECT zone, 1, rn, dx, lag(dx) OVER {W} FROM numbered),
        sums AS (SELECT zone, d, count(*) AS n, sum(w * w) AS ww, sum(w * w1) AS c, sum(w1 * w1) AS v
          FROM pairs WHERE rn >= 10 GROUP BY 1, 2)""",
    ),
    "likelihood_ar_fits": over_panel(
        f"""SELECT zone, 0 AS p, 1 AS d, 0 AS q, n, {r('n * ln(ww / n) + 2', 5)} AS aic, NULL AS weight
        FROM sums WHERE d = 1 UNION ALL
        SELECT zone, 1, d, 0, n, {r('n * ln((ww - c * c / v) / n) + 4', 5)}, {r('c / v', 4)} FROM sums""",
        "kept AS (SELECT zone, date, groundwater_level AS v FROM panel)",
        FILLED,
        f"""numbered AS (SELECT zone, date, x, x - lag(x) OVER {W} AS dx, row_number() OVER {W} AS rn FROM filled),
        pairs AS (SELECT zone, 0 AS d, rn, x AS w, lag(x) OVER {W} AS w1 FROM numbered
          UNION ALL SELECT zone, 1, rn, dx, lag(dx) OVER {W} FROM numbered),
        sums AS (SELECT zone, d, count(*) AS n, sum(w * w) AS ww, sum(w * w1) AS c, sum(w1 * w1) AS v
          FROM pairs WHERE rn >= 10 GROUP BY 1, 2)""",
    ),
    "likelihood_facts": over_panel(
        """SELECT zone, p, d, q, 1 AS not_worse FROM (SELECT DISTINCT zone FROM panel),
        (SELECT unnest([0, 1, 2]) AS p), (SELECT unnest([0, 1]) AS d), (SELECT unnest([0, 1, 2]) AS q) WHERE p + d + q > 0"""
    ),
}
