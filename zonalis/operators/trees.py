"""Tree ensembles as node arrays: predictions and Shapley values by leaf paths.

The value of a set of features is the expectation of the ensemble where the other features are
unknown: at a split on an unknown feature both branches count by their share of training rows. For a
leaf, the splits on its path merge to one interval per feature; with ``o`` whether the row lies in it
and ``z`` the share of training rows that take these branches, the leaf adds to feature i

    value * (o_i - z_i) * integral over t in [0, 1] of prod_{j != i} (o_j t + z_j (1 - t))

because the weight s! (m - 1 - s)! / m! of a subset of size s is the integral of t^s (1 - t)^(m - 1 - s).
The integrand is a polynomial, so Gauss-Legendre nodes integrate it exactly, and all rows and all
leaves with the same number of features are one array computation. A row's values add up to its
prediction less the ensemble's expectation.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import OneVsRestModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.session import fresh_path

#: Row-by-leaf-by-feature cells that are worked on at once.
CELLS = 1 << 21


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees; ``left`` is -1 at a leaf, ``value`` has a leaf's share of each output."""

    roots: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    cover: np.ndarray
    value: np.ndarray
    offset: np.ndarray

    @property
    def outputs(self) -> int:
        return self.value.shape[1]

    def only(self, output: int) -> "Trees":
        """The same trees for one output."""
        return Trees(self.roots, self.left, self.right, self.feature, self.threshold, self.cover,
                     self.value[:, [output]], self.offset[[output]])

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Rows by outputs. A missing number goes right."""
        total = np.repeat(self.offset[None, :], len(x), 0).astype(float)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while (inner := self.left[at] >= 0).any():
                goes_left = x[rows, np.where(inner, self.feature[at], 0)] <= self.threshold[at]
                at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
            total += self.value[at]
        return total

    def expectation(self) -> np.ndarray:
        """The mean output over the training rows by cover."""
        return self.offset + sum(((p.share.prod(1)[:, None] * p.value).sum(0) for p in self.paths()), np.zeros(self.outputs))

    def paths(self) -> list["Paths"]:
        """The leaves' merged conditions, in groups of equal numbers of features."""
        groups: dict[int, list[tuple]] = {}
        stack = [(int(root), {}) for root in self.roots]
        while stack:
            node, conditions = stack.pop()
            if self.left[node] < 0:
                groups.setdefault(len(conditions), []).append((node, conditions))
                continue
            feature, threshold = int(self.feature[node]), float(self.threshold[node])
            for child, low, high in ((self.left[node], -np.inf, threshold), (self.right[node], threshold, np.inf)):
                share = self.cover[child] / self.cover[node] if self.cover[node] else 0.0
                lower, upper, before = conditions.get(feature, (-np.inf, np.inf, 1.0))
                merged = (max(lower, low), min(upper, high), before * share)
                stack.append((int(child), conditions | {feature: merged}))
        found = []
        for size, leaves in sorted(groups.items()):
            features = np.array([list(c) for _, c in leaves], np.int64).reshape(len(leaves), size)
            bounds = np.array([list(c.values()) for _, c in leaves]).reshape(len(leaves), size, 3)
            found.append(Paths(features, bounds[:, :, 0], bounds[:, :, 1], bounds[:, :, 2],
                               self.value[[node for node, _ in leaves]]))
        return found


@dataclass(frozen=True)
class Paths:
    feature: np.ndarray  # leaves by features of the path
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray  # leaves by outputs


def shapley(paths: list[Paths], x: np.ndarray, output: int = 0) -> np.ndarray:
    """Rows by features: what each feature adds to one output."""
    out = np.zeros(x.shape)
    for group in paths:
        leaves, size = group.feature.shape
        if not size:
            continue
        points, weights = np.polynomial.legendre.leggauss((size + 1) // 2)
        points, weights = (points + 1) / 2, weights / 2
        step = max(1, CELLS // (size * max(1, min(len(x), 256))))
        for a in range(0, leaves, step):
            part = slice(a, a + step)
            feature, share, value = group.feature[part], group.share[part], group.value[part, output]
            rows = max(1, CELLS // (size * len(feature)))
            for b in range(0, len(x), rows):
                known = x[b : b + rows][:, feature]
                inside = ~(known <= group.low[part]) & ((known <= group.high[part]) | np.isposinf(group.high[part]))
                integral = np.zeros(known.shape)
                for t, weight in zip(points, weights, strict=True):
                    factor = inside * t + share * (1 - t)
                    # no factor is zero: a share is, only where the training rows never went, and then inside decides
                    product = factor.prod(2, keepdims=True)
                    rest = np.divide(product, factor, out=np.zeros(factor.shape), where=factor > 0)
                    if (factor <= 0).any():
                        rest = _without_each(factor, rest)
                    integral += weight * rest
                added = value[:, None] * (inside - share) * integral
                flat = np.arange(len(known))[:, None, None] * x.shape[1] + feature
                out[b : b + rows] += np.bincount(flat.ravel(), added.ravel(), len(known) * x.shape[1]).reshape(len(known), -1)
    return out


def _without_each(factor: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Products over the other factors where some factor is zero."""
    zeros = (factor <= 0).sum(2, keepdims=True)
    others = np.where(factor > 0, factor, 1.0).prod(2, keepdims=True)
    return np.where(zeros == 0, rest, np.where((zeros == 1) & (factor <= 0), others, 0.0))


# --- Spark's own ensembles -------------------------------------------------------
def from_model(model, spark) -> Trees:
    """Node arrays of a fitted forest or boosted ensemble, as large as the model.

    Outputs: a regressor's prediction, a forest classifier's probabilities, the margins of the classes
    of a one-vs-rest ensemble (of the one margin of a boosted classifier).
    """
    if isinstance(model, OneVsRestModel):
        parts = [from_model(m, spark) for m in model.models]
        shifted = np.cumsum([0, *(len(p.left) for p in parts)])
        values = np.zeros((shifted[-1], len(parts)))
        for i, p in enumerate(parts):
            values[shifted[i] : shifted[i + 1], i] = p.value[:, 0]
        moved = lambda name: np.concatenate([np.where(getattr(p, name) < 0, -1, getattr(p, name) + s)
                                             for p, s in zip(parts, shifted, strict=False)])
        joined = lambda name: np.concatenate([getattr(p, name) for p in parts])
        return Trees(moved("roots"), moved("left"), moved("right"), joined("feature"), joined("threshold"),
                     joined("cover"), values, np.zeros(len(parts)))
    path = fresh_path(spark, "trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").toPandas()
    return from_nodes(nodes, np.array(model.treeWeights), isinstance(model, RandomForestClassificationModel),
                      hasattr(model, "getNumTrees") and "RandomForest" in type(model).__name__)


def from_nodes(nodes, weights: np.ndarray, classes: bool, averaged: bool) -> Trees:
    """``nodes`` has a row per node with the fields of a saved model, in order of tree and node."""
    tree, own = nodes["treeID"].to_numpy(), nodes["id"].to_numpy()
    first = np.flatnonzero(own == 0)
    start = first[np.searchsorted(tree[first], tree)]
    stats = np.array(nodes["impurityStats"].tolist())
    left, right = (np.where(nodes[c] < 0, -1, nodes[c] + start) for c in ("leftChild", "rightChild"))
    feature = np.array([s["featureIndex"] for s in nodes["split"]])
    threshold = np.full(len(nodes), np.nan)
    for i, split in enumerate(nodes["split"]):
        if left[i] < 0:
            continue
        bounds = list(split["leftCategoriesOrThreshold"])
        if split["numCategories"] < 0:
            threshold[i] = bounds[0]
        elif split["numCategories"] == 2:  # a 0/1 slot
            threshold[i] = 0.5
            if bounds == [1.0]:
                left[i], right[i] = right[i], left[i]
        else:
            raise ValueError("splits on more than two categories are not supported")
    cover = stats.sum(1) if classes else stats[:, 0]
    value = stats / stats.sum(1, keepdims=True) if classes else nodes["prediction"].to_numpy()[:, None]
    share = np.full(len(weights), 1 / len(weights)) if averaged else weights
    value = value * share[np.searchsorted(tree[first], tree)][:, None]
    return Trees(first, left, right, feature, threshold, cover, value, np.zeros(value.shape[1]))


def explain(trees: Trees, df: DataFrame, output: int = 0, features: str = "features", keep: tuple[str, ...] = ("zone", "date")) -> DataFrame:
    """One row per row: kept columns, ``base`` (the ensemble's expectation), ``prediction``, and
    ``contributions``, an array with a number per feature slot.

    The node arrays are broadcast: they are as large as the model, whatever the number of rows. Vectors
    are made dense, so hashed zones make wide rows. Rows with a null vector have null results.
    """
    spark = df.sparkSession
    one = trees.only(output)
    base = float(one.expectation()[0])
    sent = spark.sparkContext.broadcast((one, one.paths()))

    @F.arrow_udf("struct<prediction:double,contributions:array<double>>")
    def parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ensemble, paths = sent.value
        for batch in batches:
            known = batch.drop_null()
            width = len(known[0]) if len(known) else 0
            x = known.flatten().to_numpy(zero_copy_only=False).reshape(len(known), width)
            prediction, added = ensemble.predict(x)[:, 0] if len(x) else np.empty(0), shapley(paths, x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(added.ravel()))
            made = pa.StructArray.from_arrays([pa.array(prediction), lists], ["prediction", "contributions"])
            places = np.cumsum(batch.is_valid().to_numpy(zero_copy_only=False)) - 1
            yield made.take(pa.array(places, mask=batch.is_null().to_numpy(zero_copy_only=False)))

    dense = F.when(F.col(features).isNotNull(), vector_to_array(features))
    made = df.withColumn("__parts", parts(dense))
    return made.select(*[F.col(f"`{c}`") for c in keep], F.lit(base).alias("base"), "__parts.prediction", "__parts.contributions")


def mean_contributions(explained: DataFrame, names: list[str], k: int = 20) -> DataFrame:
    """The k features with the largest mean absolute contribution."""
    slots = explained.select(F.posexplode("contributions").alias("slot", "added"))
    means = slots.groupBy("slot").agg(F.avg(F.abs("added")).alias("mean_abs"))
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("slot") + 1)
    return means.select(label.alias("feature"), "mean_abs").orderBy(F.desc("mean_abs"), "feature").limit(k)
