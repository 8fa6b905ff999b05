"""Shapley values of trees against their definition over all subsets of features."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from zonalis.operators import trees


def expected(ensemble, node, x, known):
    """The mean below a node with only some features known."""
    if ensemble.left[node] < 0:
        return ensemble.value[node, 0]
    left, right = ensemble.left[node], ensemble.right[node]
    if ensemble.feature[node] in known:
        goes_left = x[ensemble.feature[node]] <= ensemble.threshold[node]
        return expected(ensemble, left if goes_left else right, x, known)
    total = ensemble.cover[node]
    return sum(ensemble.cover[c] / total * expected(ensemble, c, x, known) for c in (left, right))


def by_definition(ensemble, x):
    n, worth = len(x), {}
    for size in range(n + 1):
        for some in itertools.combinations(range(n), size):
            worth[some] = sum(expected(ensemble, r, x, set(some)) for r in ensemble.roots)
    out = np.zeros(n)
    for i in range(n):
        for some in worth:
            if i not in some:
                weight = math.factorial(len(some)) * math.factorial(n - len(some) - 1) / math.factorial(n)
                out[i] += weight * (worth[tuple(sorted((*some, i)))] - worth[some])
    return out, worth[()]


def random_trees(rng, count=3, features=6, depth=5):
    left, right, feature, threshold, cover, roots = [], [], [], [], [], []

    def grow(rows, level):
        at = len(left)
        for column, value in ((left, -1), (right, -1), (feature, -1), (threshold, np.nan), (cover, float(rows))):
            column.append(value)
        if level and rows > 1 and rng.random() < 0.9:
            feature[at], threshold[at] = int(rng.integers(features)), float(rng.normal())
            a = int(rng.integers(0 if level == 2 else 1, rows))
            left[at], right[at] = grow(a, level - 1), grow(rows - a, level - 1)
        return at

    for _ in range(count):
        roots.append(grow(200, depth))
    arrays = [np.array(c) for c in (roots, left, right, feature, threshold, cover)]
    return trees.Trees(*arrays, rng.normal(size=(len(left), 1)), np.array([0.5]))


@pytest.mark.parametrize("seed", range(6))
def test_values_equal_the_definition(seed, monkeypatch):
    monkeypatch.setattr(trees, "CELLS", 50)
    rng = np.random.default_rng(seed)
    ensemble = random_trees(rng)
    x = rng.normal(size=(9, 6))
    got = trees.shapley(ensemble.paths(), x)
    for row, values in zip(x, got, strict=True):
        want, base = by_definition(ensemble, row)
        np.testing.assert_allclose(values, want, atol=1e-9)
        assert ensemble.expectation()[0] == pytest.approx(base + 0.5)
    np.testing.assert_allclose(got.sum(1) + ensemble.expectation()[0], ensemble.predict(x)[:, 0], atol=1e-9)


def test_deep_path_stays_exact():
    depth = 40  # one feature per level
    left, right = [], []
    for level in range(depth):
        left.append(2 * level + 1)
        right.append(2 * level + 2)
        left.append(-1)
        right.append(-1)
    left, right = np.array([*left, -1]), np.array([*right, -1])
    inner = left >= 0
    order = np.where(inner, np.arange(len(left)) // 2, -1)
    cover = np.array([2.0 ** (depth - i // 2 - (i % 2)) for i in range(len(left))])
    ensemble = trees.Trees(np.array([0]), left, right, order, np.where(inner, 0.0, np.nan), cover,
                           np.arange(len(left), dtype=float)[:, None], np.zeros(1))
    x = np.random.default_rng(3).normal(size=(20, depth))
    got = trees.shapley(ensemble.paths(), x)
    np.testing.assert_allclose(got.sum(1) + ensemble.expectation()[0], ensemble.predict(x)[:, 0], rtol=1e-9)


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(300).select(
        "id", *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(17)) / 4).alias(f"f{i}") for i in range(4)],
        F.pmod(F.xxhash64("id", F.lit(9)), F.lit(2)).cast("double").alias("flag"))
    rows = rows.withColumn("y", F.col("f0") * F.col("f1") + 3 * F.col("flag") - F.col("f2"))
    rows = rows.withColumn("risk", F.when(F.col("y") < 2, 0.0).when(F.col("y") < 5, 1.0).otherwise(2.0))
    made = VectorAssembler(inputCols=["f0", "f1", "f2", "f3", "flag"], outputCol="features").transform(rows)
    slots = {"numeric": [{"idx": i, "name": f"f{i}"} for i in range(4)], "binary": [{"idx": 4, "name": "flag"}]}
    return made.withColumn("features", F.col("features").alias("features", metadata={"ml_attr": {"attrs": slots, "num_attrs": 5}}))


MODELS = [
    (lambda: RandomForestRegressor(labelCol="y", numTrees=7, maxDepth=5, seed=1), "prediction", 0),
    (lambda: GBTRegressor(labelCol="y", maxIter=6, maxDepth=3, stepSize=0.3, seed=1), "prediction", 0),
    (lambda: RandomForestClassifier(labelCol="risk", numTrees=7, maxDepth=5, seed=1), "probability", 2),
    (lambda: OneVsRest(classifier=GBTClassifier(maxIter=4, maxDepth=3, seed=1), labelCol="risk", rawPredictionCol="rawPrediction"), "rawPrediction", 1),
]


@pytest.mark.parametrize("estimator,column,output", MODELS)
def test_fitted_models_are_read_and_explained(spark, table, estimator, column, output):
    model = estimator().fit(table)
    ensemble = trees.from_model(model, spark)
    own = F.col(column) if column == "prediction" else vector_to_array(column)[output]
    scored = {r.id: (r.own, r.x) for r in model.transform(table).select("id", own.alias("own"), vector_to_array("features").alias("x")).collect()}
    rows = trees.explain(ensemble, table, output, keep=("id",)).collect()
    assert len(rows) == len(scored)
    for r in rows:
        assert r.prediction == pytest.approx(scored[r.id][0], abs=1e-9)
        assert r.base + sum(r.contributions) == pytest.approx(r.prediction, abs=1e-9)
    first = rows[0]
    want, base = by_definition(ensemble.only(output), np.array(scored[first.id][1]))
    np.testing.assert_allclose(first.contributions, want, atol=1e-9)
    assert first.base == pytest.approx(base)


def test_null_rows_and_empty_tables(spark, table):
    ensemble = trees.from_model(MODELS[0][0]().fit(table), spark)
    odd = spark.range(298, 301).join(table, "id", "left")  # the last id has no vector
    rows = trees.explain(ensemble, odd, keep=("id",)).collect()
    assert sorted(r.contributions is None for r in rows) == [False, False, True]
    assert trees.explain(ensemble, table.limit(0)
                         .withColumn("zone", F.lit("")).withColumn("date", F.current_date())).count() == 0
    top = trees.mean_contributions(trees.explain(ensemble, table, keep=("id",)), ["f0", "f1", "f2", "f3", "flag"], 3)
    assert {r.feature for r in top.collect()} == {"f0", "f1", "f2"} or len(top.collect()) == 3
