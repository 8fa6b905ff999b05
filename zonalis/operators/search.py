"""Randomised search over parameter grids with expanding or stratified folds."""

import itertools
import math
import random
from dataclasses import replace
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.operators import boosting, evaluation, models
from zonalis.operators.selection import stratified_folds, with_date_ranks
from zonalis.session import stage


def draw(grid: dict[str, list], draws: int, seed: int = fixed.SEED) -> list[dict]:
    """Seeded draws without repetition, at most the size of the grid."""
    names = list(grid)
    every = [dict(zip(names, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(every, min(draws, len(every)))


def regressor(name: str, train: DataFrame, params: dict):
    if name == "Ridge_Regression":
        return models.ridge(train, params["alpha"])
    if name == "Random_Forest":
        return models.forest_regressor(**params)
    return models.boosted_regressor(**params)


def classifier(name: str, train: DataFrame, params: dict):
    if name == "Logistic_Regression":
        return models.logit(train, params["C"])
    if name == "RF_Classifier":
        return models.forest_classifier(**params)
    return models.boosted_classifier(**params)


REGRESSORS = {
    "Ridge_Regression": {"alpha": fixed.RIDGE_ALPHAS},
    "Random_Forest": fixed.FOREST_GRID,
    "Column_Sampled_Boosting": fixed.BOOSTED_COLUMN_GRID,
    "Gradient_Boosting": fixed.BOOSTED_GRID,
}
CLASSIFIERS = {
    "Logistic_Regression": {"C": fixed.LOGIT_C},
    "RF_Classifier": fixed.FOREST_CLASSIFIER_GRID,
    "One_vs_Rest_Boosting": fixed.BOOSTED_CLASSIFIER_GRID,
}


def _search(tasks, fit_one, parallel: int):
    """Independent fits from a few driver threads; each returns one small score."""
    with ThreadPool(parallel) as pool:
        return pool.map(fit_one, tasks)


def ridge_search(
    train: DataFrame, alphas: list[float] = fixed.RIDGE_ALPHAS, folds: int = 5, label: str = "y", features: str = "features"
) -> DataFrame:
    """RMSE of every penalty on every expanding-window fold, from one pass over the rows.

    Tasks add the outer products of (1, features, label) by block of dates; a fold's training rows
    are the blocks before it, so their sums give its weights, and the sums of its own block the
    squared error. What reaches the driver is a matrix per block. Rows with a null label or vector
    are left out.
    """
    rows = train.filter(F.col(label).isNotNull() & F.col(features).isNotNull())
    some = with_date_ranks(train)
    size = F.greatest(F.floor(F.col("n_dates") / (folds + 1)), F.lit(1))
    first = F.col("n_dates") - folds * size
    block = F.when(F.col("date_rank") < first, 0).otherwise(F.floor((F.col("date_rank") - first) / size) + 1)
    known = some.join(rows.select("date").distinct(), "date").select("date", block.cast("int").alias("block")).distinct()
    table = rows.join(known, "date").select("block", F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))

    def products(batches):
        sums = {}
        for batch in batches:
            width = len(batch.column("x")[0]) if len(batch) else 0
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
            wide = np.column_stack([np.ones(len(batch)), x, batch.column("y").to_numpy()])
            blocks = batch.column("block").to_numpy()
            for b in np.unique(blocks):
                part = wide[blocks == b]
                sums[b] = sums.get(b, 0.0) + part.T @ part
        for b, total in sums.items():
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), b, np.int32)), pa.array(np.arange(len(flat))), pa.array(flat)],
                                             ["block", "cell", "value"])

    parts = table.mapInArrow(products, "block int, cell bigint, value double")
    found = parts.groupBy("block", "cell").agg(F.sum("value").alias("value")).orderBy("block", "cell").toArrow()
    blocks, values = found.column("block").to_numpy(), found.column("value").to_numpy()
    size = math.isqrt(len(values) // max(1, len(np.unique(blocks))))
    grams = {int(b): values[blocks == b].reshape(size, size) for b in np.unique(blocks)}
    scores = []
    for fold in range(1, folds + 1):
        seen = [g for b, g in grams.items() if b < fold]
        if seen and fold in grams:
            scores += [(float(a), fold, ridge_error(sum(seen), grams[fold], a)) for a in alphas]
    return train.sparkSession.createDataFrame(scores, "alpha double, fold int, rmse double")


def ridge_error(known: np.ndarray, held: np.ndarray, alpha: float) -> float:
    """RMSE on the rows of one sum of products of the ridge fit on the rows of another."""
    n, mean = known[0, 0], known[0, 1:] / known[0, 0]
    centred = known[1:, 1:] - n * np.outer(mean, mean)
    weights = np.linalg.solve(centred[:-1, :-1] + alpha * np.eye(len(mean) - 1), centred[:-1, -1])
    form = np.concatenate([[mean[-1] - weights @ mean[:-1]], weights, [-1.0]])
    return float(np.sqrt(max(form @ held @ form, 0.0) / held[0, 0]))


def search_regressor(
    name: str,
    train: DataFrame,
    draws: int = fixed.REGRESSION_DRAWS,
    folds: int = 5,
    grid: dict | None = None,
    parallel: int = 4,
) -> list[dict]:
    """Mean RMSE over expanding-window folds for each drawn setting."""
    if name == "Ridge_Regression":
        settings = draw(grid or REGRESSORS[name], draws)
        found = {(r["alpha"], r["fold"]): r["rmse"] for r in ridge_search(train, [s["alpha"] for s in settings], folds).collect()}
        return _summary(name, settings, [(i, f, found.get((s["alpha"], f))) for i, s in enumerate(settings) for f in range(1, folds + 1)])
    # one copy of the rows with their date rank; a fold is a rank filter on it
    ranked = with_date_ranks(train).persist()
    some = ranked.first()
    dates = some["n_dates"] if some else 0
    size = dates // (folds + 1)
    settings = draw(grid or REGRESSORS[name], draws)
    rank = F.col("date_rank")

    def fit_one(task):
        number, fold = task
        first = dates - (folds - fold + 1) * size
        known, held = ranked.filter(rank < first), ranked.filter((rank >= first) & (rank < first + size))
        model = regressor(name, known, settings[number]).fit(known)
        scored = models.predict(model, held, name)
        return number, fold, evaluation.regression_metrics(scored).first()["RMSE"]

    scores = _search(list(itertools.product(range(len(settings)), range(1, folds + 1))), fit_one, parallel)
    ranked.unpersist()
    return _summary(name, settings, scores)


def search_boosting(
    train: DataFrame, draws: int = fixed.REGRESSION_DRAWS, folds: int = 5, grid: dict | None = None,
    most_rounds: int | None = None,
) -> list[dict]:
    """Mean RMSE over expanding-window folds for each draw of second-order boosting.

    All draws of all folds grow in the same passes, so a search needs as many as its largest model.
    ``most_rounds`` bounds the rounds of every draw.
    """
    ranked = with_date_ranks(train)
    some = ranked.first()
    size = (some["n_dates"] if some else 0) // (folds + 1)
    first = (some["n_dates"] if some else 0) - folds * size
    rank = F.col("date_rank")
    # a row belongs to the fold that it is held out in; later folds do not see it before
    held = F.when(rank < first, boosting.ALL_ROWS - 1).otherwise(F.floor((rank - first) / F.lit(max(size, 1)))).cast("int")
    table = stage(ranked.withColumn("held", held), "folds")
    drawn_settings = draw(grid or fixed.BOOSTED_COLUMN_GRID, draws)
    tasks = list(itertools.product(range(len(drawn_settings)), range(folds)))
    made = boosting.fit(table, [replace(boosting_settings(drawn_settings[n], most_rounds), until=f) for n, f in tasks], fold="held")
    scored = [boosting.predict(model, table.where(F.col("held") == f), f"{n}:{f}") for (n, f), model in zip(tasks, made, strict=True)]
    report = evaluation.regression_metrics(reduce(DataFrame.unionByName, scored))
    scores = [(*map(int, row["model"].split(":")), row["RMSE"]) for row in report.collect()]
    return _summary("Second_Order_Boosting", drawn_settings, scores)


def boosting_settings(params: dict, most_rounds: int | None = None) -> boosting.Settings:
    rounds = min(params["maxIter"], most_rounds or params["maxIter"])
    return boosting.Settings(rounds, params["maxDepth"], params["stepSize"], params.get("subsamplingRate", 1.0),
                             float(params.get("featureSubsetStrategy", 1.0)))


def search_classifier(
    name: str,
    train: DataFrame,
    draws: int = fixed.CLASSIFICATION_DRAWS,
    folds: int = 5,
    grid: dict | None = None,
    parallel: int = 4,
) -> list[dict]:
    """Mean macro F1 over stratified folds for each drawn setting."""
    folded = stratified_folds(train, folds, label="risk").persist()
    settings = draw(grid or CLASSIFIERS[name], draws)

    def fit_one(task):
        number, fold = task
        known, held = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
        model = classifier(name, known, settings[number]).fit(known)
        report = evaluation.classification_report(models.predict_class(model, held, name))
        return number, fold, report.filter("label = 'macro avg'").first()["f1"]

    scores = _search(list(itertools.product(range(len(settings)), range(folds))), fit_one, parallel)
    folded.unpersist()
    return _summary(name, settings, scores)


def _summary(name, settings, scores) -> list[dict]:
    out = []
    for number, params in enumerate(settings):
        values = [s for n, _, s in scores if n == number and s is not None]
        out.append({"model": name, "params": params, "score": sum(values) / len(values) if values else float("nan"), "folds": len(values)})
    return out


def as_rows(spark, results: list[dict]) -> DataFrame:
    """Search scores (a few driver values) as a table."""
    rows = [(r["model"], str(sorted(r["params"].items())), float(r["score"]), r["folds"]) for r in results]
    return spark.createDataFrame(rows, "model string, params string, score double, folds int")
