"""Binned second-order boosting against a plain recursion, and its invariances."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from zonalis.operators import boosting, evaluation, search, trees
from zonalis.operators.boosting import Settings


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.integers(0, 6, 300), rng.integers(0, 4, 300), rng.integers(0, 9, 300)]).astype(float)
    y = x[:, 0] * (x[:, 1] > 1) + 0.3 * x[:, 2] + rng.normal(scale=0.2, size=300)
    return x, y, np.digitize(y, [1.5, 3.5])


@pytest.fixture(scope="module")
def table(spark, data):
    x, y, risk = data
    rows = [(f"z{i % 7}", i, a.tolist(), float(b), int(c), i % 3) for i, (a, b, c) in enumerate(zip(x, y, risk, strict=True))]
    made = spark.createDataFrame(rows, "zone string, date int, x array<double>, y double, risk int, fold int")
    return made.withColumn("features", array_to_vector("x"))


def grow(x, g, h, depth, s):
    """Exact greedy tree as nested tuples; a leaf is its weight."""
    weight = -g.sum() / (h.sum() + s.penalty)
    best = (1e-9, None)
    if depth:
        for j in range(x.shape[1]):
            for v in np.unique(x[:, j])[:-1]:
                left = x[:, j] <= v
                if h[left].sum() < s.least_weight or h[~left].sum() < s.least_weight:
                    continue
                score = lambda a, b: a**2 / (b + s.penalty)
                gain = (score(g[left].sum(), h[left].sum()) + score(g[~left].sum(), h[~left].sum()) - score(g.sum(), h.sum())) / 2
                if gain > best[0] + 1e-6:
                    best = (gain, (j, v, left))
    if best[1] is None:
        return weight
    j, v, left = best[1]
    return j, v, grow(x[left], g[left], h[left], depth - 1, s), grow(x[~left], g[~left], h[~left], depth - 1, s)


def reach(tree, row):
    while isinstance(tree, tuple):
        j, v, left, right = tree
        tree = left if row[j] <= v else right
    return tree


def plainly(x, y, s, classes=0):
    margins = np.zeros((len(x), max(classes, 1))) if classes else np.full((len(x), 1), y.mean())
    for _ in range(s.rounds):
        g, h = boosting.gradients(margins, y, classes)
        grown = [grow(x, g[:, k], h[:, k], s.depth, s) for k in range(margins.shape[1])]
        margins = margins + s.rate * np.array([[reach(t, row) for t in grown] for row in x])
    return margins


def outputs_of(model, table):
    return np.array([r[0] for r in table.orderBy("date").select(boosting.outputs(model, table)).collect()])


def test_level_and_class_models_equal_a_plain_recursion(table, data):
    x, y, risk = data
    s = Settings(rounds=3, depth=3, rate=0.3)
    [model] = boosting.fit(table, s)
    np.testing.assert_allclose(outputs_of(model, table), plainly(x, y, s), atol=1e-5)
    [model] = boosting.fit(table, s, label="risk", classes=3)
    np.testing.assert_allclose(outputs_of(model, table), plainly(x, risk, s, 3), atol=1e-5)


def test_models_in_one_pass_equal_models_alone_whatever_the_partitions(table, data, monkeypatch):
    monkeypatch.setattr(boosting, "RESTAGE", 2)
    x, y, _ = data
    settings = [Settings(rounds=5, depth=2, fold=0), Settings(rounds=3, depth=4, rate=0.5), Settings(rounds=4, depth=2, subsample=0.7, columns=0.6)]
    together = boosting.fit(table, settings, fold="fold")
    spread = boosting.fit(table.repartition(5, "x"), settings, fold="fold")
    for a, b in zip(together, spread, strict=True):
        np.testing.assert_allclose(a.trees.predict(x), b.trees.predict(x), atol=1e-12)
    alone = boosting.fit(table, settings[1])[0]
    np.testing.assert_allclose(together[1].trees.predict(x), alone.trees.predict(x), atol=1e-9)
    kept = np.arange(300) % 3 != 0
    held = plainly(x[kept], y[kept], settings[0])
    np.testing.assert_allclose(together[0].trees.predict(x[kept]), held, atol=1e-5)
    assert len(together[0].trees.roots) == 5 and len(together[1].trees.roots) == 3


def test_learns_and_explains(table):
    [model] = boosting.fit(table, Settings(rounds=30, depth=4, rate=0.3), label="risk", classes=3)
    scored = boosting.predict(model, table, "softmax")
    hits = scored.agg(F.avg((F.col("y") == F.col("p")).cast("double")), F.max(F.abs(
        F.aggregate("probability", F.lit(0.0), lambda a, v: a + v) - 1))).first()
    assert hits[0] > 0.97 and hits[1] < 1e-9
    for r in trees.explain(model.trees, table, 2, keep=("date",)).collect():
        assert r.base + sum(r.contributions) == pytest.approx(r.prediction, abs=1e-9)
    [level] = boosting.fit(table, Settings(rounds=60, depth=4, rate=0.3))
    assert evaluation.regression_metrics(boosting.predict(level, table, "level")).first()["R2"] > 0.98


def test_odd_rows(spark, table):
    odd = table.withColumn("y", F.when(F.col("date") > 3, F.col("y")))
    assert len(boosting.fit(odd, Settings(rounds=2))[0].trees.roots) == 2
    [empty] = boosting.fit(table.limit(0), Settings(rounds=2))
    assert (outputs_of(empty, table) == 0).all()
    constant = table.withColumn("features", array_to_vector(F.array(F.lit(1.0))))
    [flat] = boosting.fit(constant, Settings(rounds=2, depth=2))
    assert np.ptp(outputs_of(flat, constant)) == 0
    missing = table.withColumn("features", array_to_vector(F.array(F.when(F.col("date") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)))))
    [model] = boosting.fit(missing, Settings(rounds=1, depth=1))
    assert len(outputs_of(model, missing)) == 300
    with pytest.raises(ValueError):
        boosting.fit(table, Settings(), bins=1000)


def test_search_over_folds_in_one_pass_equals_fits_of_each_fold(spark, data):
    x, y, _ = data
    rows = [(f"z{i % 3}", i // 3, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    made = spark.createDataFrame(rows, "zone string, month int, x array<double>, y double")
    made = made.select("zone", F.expr("date_add(date'2000-01-01', month)").alias("date"), "y", array_to_vector("x").alias("features"))
    grid = {"maxIter": [3], "maxDepth": [2, 3], "stepSize": [0.3]}
    found = search.search_boosting(made, draws=2, folds=2, grid=grid)
    first = 100 - 2 * (100 // 3)
    for result in found:
        s, errors = Settings(rounds=3, depth=result["params"]["maxDepth"], rate=0.3), []
        for fold in range(2):
            start = first + fold * (100 // 3)
            day = np.arange(300) // 3
            known, held = day < start, (day >= start) & (day < start + 100 // 3)
            [model] = boosting.fit(made.where(F.datediff("date", F.lit("2000-01-01")) < start), s)
            assert known.sum() == start * 3
            errors.append(np.sqrt(((model.trees.predict(x[held])[:, 0] - y[held]) ** 2).mean()))
        assert result["score"] == pytest.approx(np.mean(errors), rel=1e-6)
