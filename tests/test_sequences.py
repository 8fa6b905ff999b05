"""The pooled sequence forecaster: recursion by hand, skill, and ridge folds from sums of products."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.operators import evaluation, models, search

COLUMNS, LENGTH, STEPS = fixed.SEQUENCE_COVARIATES, fixed.HISTORY_ROWS, fixed.FORECAST_STEPS


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(3)
    rows = []
    for zone, n in (("A", 90), ("B", 70), ("C", 60), ("short", 8)):
        other = rng.normal(size=(n, 5)).round(3)
        level = 15 + 4 * np.sin(np.arange(n) * 2 * np.pi / 12 + len(rows)) + 0.1 * rng.normal(size=n)
        rows += [(zone, i, float(level[i]), *map(float, other[i])) for i in range(n)]
    shape = "zone string, month int, " + ", ".join(f"{c} double" for c in COLUMNS)
    return spark.createDataFrame(rows, shape).withColumn("date", F.expr("add_months(date'2001-01-01', month)"))


def by_hand(model, rows, months):
    """Rows of one zone in order, covariates as in COLUMNS."""
    x = np.array(rows, float)
    low, high = x.min(0), x.max(0)
    window = ((x - low) / (high - low))[-LENGTH:]
    out = []
    while len(out) < months:
        flat = window.ravel()[model["entries"]]
        made = [model["intercepts"][k] + model["shift"][k] + flat @ np.array(model["weights"][k]) for k in range(STEPS)]
        for y in made:
            window = np.vstack([window, [y, *window[-1][1:]]])
            out.append(y)
        window = window[-LENGTH:]
    return np.array(out[:months]) * (high[0] - low[0]) + low[0]


@pytest.mark.parametrize("entries,zones", [(None, True), ([0, 66, 71], False)])
def test_recursion_equals_a_loop(panel, entries, zones):
    model = models.fit_sequences(panel, entries=entries, zones=zones)
    made = models.sequence_recursion(model, panel, 8)
    got = {}
    for r in made.orderBy("zone", "step").collect():
        got.setdefault(r.zone, []).append(r.predicted_gw)
    assert set(got) == {"A", "B", "C"}
    for zone, values in got.items():
        rows = [[r[c] for c in COLUMNS] for r in panel.filter(F.col("zone") == zone).orderBy("date").collect()]
        plain = {"entries": model.entries, "weights": model.weights, "intercepts": model.intercepts,
                 "shift": model.zones.get(zone, [0.0] * STEPS)}
        np.testing.assert_allclose(values, by_hand(plain, rows, 8), rtol=1e-9)
    assert str(made.filter("zone = 'A' AND step = 1").first().date) == "2008-07-01"


def test_first_step_by_zone_and_unknown_zones(panel):
    model = models.fit_sequences(panel, alpha=0.1)
    scored = models.sequence_backtest(model, panel).withColumn("model", F.col("zone"))
    metrics = {r.model: r.R2 for r in evaluation.regression_metrics(scored).collect()}
    assert set(metrics) == {"A", "B", "C"} and min(metrics.values()) > 0.9
    renamed = panel.withColumn("zone", F.concat(F.lit("new "), "zone"))
    assert models.sequence_recursion(model, renamed, 3).count() == 9
    assert models.sequence_recursion(model, panel.limit(0), 3).count() == 0


def test_ridge_folds_equal_fits_of_each_fold(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=240)
    rows = [(i // 6, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    table = spark.createDataFrame(rows, "day int, x array<double>, y double").select(
        F.expr("date_add(date'2001-01-01', day)").alias("date"), "y", array_to_vector("x").alias("features"))
    found = {(r.alpha, r.fold): r.rmse for r in search.ridge_search(table.repartition(3), [0.5, 50.0], 3).collect()}
    assert len(found) == 6
    day = np.arange(240) // 6
    for (alpha, fold), rmse in found.items():
        first = 40 - (4 - fold) * 10
        known, held = day < first, (day >= first) & (day < first + 10)
        centre, level = x[known].mean(0), y[known].mean()
        w = np.linalg.solve((x[known] - centre).T @ (x[known] - centre) + alpha * np.eye(3), (x[known] - centre).T @ (y[known] - level))
        assert rmse == pytest.approx(np.sqrt((((x[held] - centre) @ w + level - y[held]) ** 2).mean()))
    odd = table.withColumn("y", F.when(F.rand(1) > 0.1, F.col("y")))
    assert search.ridge_search(odd, [1.0], 2).count() == 2
    assert search.ridge_search(table.limit(0), [1.0], 2).count() == 0
