"""Whole jobs: train and rank models, report anomalies, run everything."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.operators import (
    anomaly,
    evaluation,
    explain,
    likelihood,
    models,
    scenarios,
    search,
    spatial,
    summaries,
)
from zonalis.operators.features import engineer
from zonalis.operators.selection import in_zones, split_by_time
from zonalis.session import stage
from zonalis.sources import panel as io

# Search effort by default: the full grids. ``QUICK`` keeps every step but draws less.
FULL = {"draws": None, "folds": 5, "grids": {}, "hybrid": {"trees": 200, "depth": 30}}
QUICK = {
    "draws": 1,
    "folds": 2,
    "hybrid": {"trees": 20, "depth": 6},
    "grids": {
        "Random_Forest": {"numTrees": [20], "maxDepth": [6]},
        "Column_Sampled_Boosting": {
            "maxIter": [8],
            "maxDepth": [4],
            "subsamplingRate": [0.8],
            "featureSubsetStrategy": ["0.8"],
        },
        "Gradient_Boosting": {"maxIter": [8], "maxDepth": [3]},
        "RF_Classifier": {"numTrees": [20], "maxDepth": [6]},
        "One_vs_Rest_Boosting": {"maxIter": [3], "maxDepth": [2]},
    },
}


def split_features(panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Engineered rows as train and test; panel and features are each written once."""
    rows = split_by_time(stage(engineer(stage(panel, "panel")), "features"))
    return rows.filter("role = 'train'"), rows.filter("role = 'test'")


def model_table(panel: DataFrame):
    """Fitted preparation and the prepared train and test rows (cached, read by every fit)."""
    train, test = split_features(panel)
    prep = models.prepare(train)
    return prep, models.prepared(train, prep).persist(), models.prepared(test, prep).persist()


def release(table) -> None:
    for rows in table[1:]:
        rows.unpersist()


def _search(kind, name, train, effort, default_draws):
    run = search.search_regressor if kind == "regressor" else search.search_classifier
    grid = effort["grids"].get(name)
    return run(name, train, effort["draws"] or default_draws, effort["folds"], grid)


def train_regressors(table, effort=FULL, model_dir: str | None = None) -> DataFrame:
    """Search, refit on all training rows, score the held-out years, rank; the best is saved.

    ``table`` is the result of ``model_table``.
    """
    prep, train, test = table
    fitted, metrics = {}, []
    for name in search.REGRESSORS:
        tried = _search("regressor", name, train, effort, fixed.REGRESSION_DRAWS)
        best = min(tried, key=lambda r: r["score"])
        fitted[name] = search.regressor(name, train, best["params"]).fit(train)
        metrics.append(evaluation.regression_metrics(models.predict(fitted[name], test, name)))
    scores = stage(reduce(DataFrame.unionByName, metrics), "metrics")
    board = evaluation.leaderboard(scores)
    if model_dir:
        winner = board.filter("winner = 1").first()["model"]
        for name, model in fitted.items():
            io.save_model(models.with_model(prep, model), f"{model_dir}/{name}")
        io.save_model(models.with_model(prep, fitted[winner]), f"{model_dir}/best_regressor")
        io.write_metrics(board, f"{model_dir}/model_comparison")
    return board


def train_classifiers(table, effort=FULL, model_dir: str | None = None) -> DataFrame:
    """Search by macro F1 on stratified folds, refit, report the held-out years by class.

    With ``model_dir`` each model is saved with its confusion counts, its 15 largest importances where
    it has any, and its 20 largest contributions to high risk.
    """
    prep, train, test = table
    fitted, reports, high = {}, [], fixed.RISK_LABELS.index("High")
    for name in search.CLASSIFIERS:
        tried = _search("classifier", name, train, effort, fixed.CLASSIFICATION_DRAWS)
        best = max(tried, key=lambda r: r["score"])
        fitted[name] = search.classifier(name, train, best["params"]).fit(train)
        scored = models.predict_class(fitted[name], test, name)
        reports.append(evaluation.classification_report(scored, by=("model",)))
        if model_dir:
            evaluation.confusion_counts(scored).write.parquet(f"{model_dir}/CLS_{name}_confusion")
            if hasattr(fitted[name], "featureImportances"):
                top = explain.top_features(train, fitted[name], 15)
                top.write.parquet(f"{model_dir}/CLS_{name}_importances")
            explain.class_contributions(fitted[name], train, test, high).write.parquet(f"{model_dir}/CLS_{name}_explanation")
    report = stage(reduce(DataFrame.unionByName, reports), "report")
    macro = report.filter("label = 'macro avg'")
    winner = macro.agg(F.max_by("model", F.struct("f1", "model"))).scalar()
    board = report.withColumn("winner", (F.col("model") == winner).cast("int"))
    if model_dir:
        best_name = board.filter("winner = 1").first()["model"]
        for name, model in fitted.items():
            io.save_model(models.with_model(prep, model), f"{model_dir}/CLS_{name}")
        io.save_model(models.with_model(prep, fitted[best_name]), f"{model_dir}/best_classifier")
    return board


def anomaly_report(panel: DataFrame, threshold: float = 1.5) -> DataFrame:
    """Rows and anomalies per zone by layer."""
    flagged = anomaly.detect(stage(panel, "panel"), threshold)
    return flagged.groupBy("zone").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("iso_anomaly").alias("forest"),
        F.sum("z_anomaly").alias("zscore"),
        F.sum("anomaly").alias("anomalies"),
    )


def hybrid_metrics(panel: DataFrame, test_years: int = 3, trees: int = 200, depth: int = 30) -> DataFrame:
    rows = split_by_time(stage(panel, "panel"), test_years)
    model = models.fit_hybrid(rows.filter("role = 'train'"), trees, depth)
    scored = model.transform(rows.filter("role = 'test'"))
    return evaluation.regression_metrics(
        scored.select(F.lit("Physics_Plus_Forest").alias("model"), F.col(fixed.TARGET).alias("y"), "p")
    )


STEPS = ["regressors", "sequences", "arima", "classifiers", "advanced", "spatial"]


def run_all(
    panel: DataFrame, steps: list[str] = STEPS, zones: list[str] | None = None, effort=FULL
) -> DataFrame:
    """Every step that is switched on, as rows (step, item, metric, value).

    ``zones`` limits the forecasting steps, as the other steps learn over all zones.
    """
    panel = stage(panel, "panel")
    chosen = in_zones(panel, zones)

    def rows(step, df, item, metrics):
        pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics]
        return df.select(F.lit(step).alias("step"), F.col(item).alias("item"), F.explode(F.array(*pairs)).alias("s")).select(
            "step", "item", "s.metric", "s.value"
        )

    out = []
    learns = {"regressors", "classifiers"} & set(steps)
    table = model_table(panel) if learns else None
    if "regressors" in steps:
        out.append(rows("regressors", train_regressors(table, effort), "model", ["RMSE", "MAE", "R2"]))
    if "sequences" in steps:
        scored = models.direct_multistep(chosen).withColumn("model", F.concat(F.lit("step "), "step"))
        out.append(rows("sequences", evaluation.regression_metrics(scored), "model", ["RMSE", "MAE", "R2"]))
        by_zone = models.sequence_backtest(models.fit_sequences(chosen), chosen).withColumn("model", F.col("zone"))
        out.append(rows("sequence zones", evaluation.regression_metrics(by_zone), "model", ["RMSE", "MAE", "R2"]))
    if "arima" in steps:
        out.append(rows("arima", likelihood.backtest_metrics(chosen), "model", ["RMSE", "MAE", "R2"]))
    if "classifiers" in steps:
        board = train_classifiers(table, effort).filter("label = 'macro avg'")
        out.append(rows("classifiers", board, "model", ["f1"]))
    if table:
        release(table)
    if "advanced" in steps:
        out.append(rows("hybrid", hybrid_metrics(panel, **effort["hybrid"]), "model", ["RMSE", "MAE", "R2"]))
        ends = scenarios.project(panel).groupBy("scenario").agg(F.avg("gw_level_proj").alias("mean_level"))
        out.append(rows("scenarios", ends, "scenario", ["mean_level"]))
        out.append(rows("anomalies", anomaly_report(panel), "zone", ["anomalies"]))
    if "spatial" in steps:
        grid = spatial.interpolate(summaries.zone_summary(panel), "gw_level")
        ends = grid.agg(F.min("value").alias("low"), F.max("value").alias("high")).withColumn(
            "item", F.lit("grid")
        )
        out.append(rows("spatial", ends, "item", ["low", "high"]))
    return reduce(DataFrame.unionByName, out)
