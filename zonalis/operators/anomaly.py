"""Isolation forest, combined flags and anomaly reports."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonalis.functions import fixed
from zonalis.operators.summaries import exact_quantiles
from zonalis.operators.timeseries import rolling_zscore
from zonalis.session import stage

NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, size long"


def _uniform(*parts):
    """A number in [0, 1) from a hash of the row, so reruns and retries agree."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def tree_samples(
    df: DataFrame,
    features: list[str],
    trees: int = fixed.FOREST_TREES,
    sample: int = fixed.FOREST_SAMPLE,
    seed: int = fixed.SEED,
) -> DataFrame:
    """For each tree the ``sample`` rows of lowest hash (all rows where there are fewer).

    Rows are thinned twice by hash before the ranking: once to a pool sized by the trees,
    then per tree to four times the sample, so a tree's group stays small at any table size.
    """
    n = df.agg(F.count(F.lit(1))).scalar()
    pool_size = float(4 * trees * sample)
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    pool = df.select("zone", "date", *filled).filter(
        _uniform(F.lit(seed), "zone", "date") * n < pool_size
    )
    pooled = F.least(n.cast("double"), F.lit(pool_size))
    draws = (
        pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("draw", _uniform(F.lit(seed + 1), "tree", "zone", "date"))
        .filter(F.col("draw") * pooled < 4.0 * sample)
    )
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("draw", "zone", "date"))
    return draws.withColumn("rank", rank).filter(F.col("rank") <= sample).select("tree", *features)


def grow_trees(samples: DataFrame, features: list[str], seed: int = fixed.SEED) -> DataFrame:
    """One isolation tree per group of at most ``sample`` rows, as a node table."""

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        data = rows[features].sort_values(features).to_numpy(dtype=np.float64)
        rng = np.random.default_rng([seed, tree])
        limit = int(np.ceil(np.log2(max(len(data), 2))))
        nodes: list[list] = []
        todo = [(np.arange(len(data)), 0, None, None)]
        while todo:
            members, depth, parent, side = todo.pop()
            number = len(nodes)
            nodes.append([tree, number, -1, 0.0, -1, -1, len(members)])
            if parent is not None:
                nodes[parent][4 + side] = number
            part = data[members]
            usable = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) > 1 else []
            if depth >= limit or len(usable) == 0:
                continue
            feature = int(rng.choice(usable))
            column = part[:, feature]
            cut = rng.uniform(column.min(), column.max())
            goes_left = column <= cut
            nodes[number][2:4] = [feature, float(cut)]
            todo.append((members[~goes_left], depth + 1, number, 1))
            todo.append((members[goes_left], depth + 1, number, 0))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "size"])

    return samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def mean_path(n):
    """Expected path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        long = 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def padded_trees(table: pd.DataFrame) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per tree its depth, each node's feature, cut and two children, and each leaf's whole path length.

    A leaf is its own child, so that all rows take as many steps as the tree is deep.
    """
    out = []
    for _, tree in table.sort_values(["tree", "node"]).groupby("tree"):
        feature, left, right = (tree[c].to_numpy(dtype=np.intp) for c in ["feature", "left", "right"])
        inner, own = feature >= 0, np.arange(len(tree))
        children = np.stack([np.where(inner, left, own), np.where(inner, right, own)], axis=1).ravel()
        depth = np.zeros(len(tree))
        for node in np.flatnonzero(inner):  # parents come before their children
            depth[children[2 * node : 2 * node + 2]] = depth[node] + 1
        cut = np.where(inner, tree["cut"].to_numpy(), np.inf)
        path = depth + mean_path(tree["size"].to_numpy())
        out.append((int(depth.max()), np.where(inner, feature, 0), cut, children, path))
    return out


def path_lengths(columns: np.ndarray, trees: list[tuple]) -> np.ndarray:
    """Summed path lengths over all trees of each row; ``columns`` has a row per feature."""
    n = columns.shape[1]
    flat, row, total = columns.ravel(), np.arange(n), np.zeros(n)
    for depth, feature, cut, children, path in trees:
        offset = feature * n
        at = np.zeros(n, np.intp)
        for _ in range(depth):
            value = flat.take(offset.take(at) + row)
            right = value > cut.take(at)
            at <<= 1
            at += right
            at = children.take(at)
        total += path.take(at)
    return total


def score_rows(df: DataFrame, nodes: DataFrame, features: list[str], sample_rows: int) -> DataFrame:
    """Adds ``iso_score`` = 2^(-mean depth / c).

    The node table has at most trees x (2 x sample - 1) rows (51,100 by default) whatever
    the data size; that bound is what makes it fit for a broadcast variable.
    """
    model = df.sparkSession.sparkContext.broadcast(padded_trees(nodes.toPandas()))
    norm = float(mean_path(sample_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        for batch in batches:
            data = np.empty((len(features), len(batch)))
            for i, name in enumerate(features):
                data[i] = batch.column(name).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
            data[np.isnan(data)] = 0.0  # nulls too
            total = path_lengths(data, trees)
            scores = 2.0 ** (-total / len(trees) / norm) if norm > 0 else np.full(len(batch), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "iso_score"])

    schema = T.StructType([*df.schema.fields, T.StructField("iso_score", T.DoubleType())])
    return df.mapInArrow(score, schema)


def isolation_forest(
    df: DataFrame,
    features: list[str] = fixed.ANOMALY_FEATURES,
    contamination: float = fixed.CONTAMINATION,
    trees: int = fixed.FOREST_TREES,
    sample: int = fixed.FOREST_SAMPLE,
    seed: int = fixed.SEED,
) -> DataFrame:
    """Fit on all rows, score all rows, flag the highest ``contamination`` share."""
    drawn = tree_samples(df, features, trees, sample, seed)
    nodes = grow_trees(drawn, features, seed)
    sample_rows = min(sample, df.count())
    # scored once, read by the quantile passes and the result
    scored = stage(score_rows(df, nodes, features, sample_rows), "scored")
    edge = exact_quantiles(scored, ["iso_score"], [1.0 - contamination]).select("quantile").scalar()
    return scored.withColumn("iso_anomaly", (F.col("iso_score") > edge).cast("int"))


@dataclass(frozen=True)
class Detector:
    """A fitted forest with the score above which a row is an anomaly."""

    nodes: DataFrame
    features: list[str]
    sample_rows: int
    edge: float


def fit_detector(
    df: DataFrame,
    path: str,
    features: list[str] = fixed.ANOMALY_FEATURES,
    contamination: float = fixed.CONTAMINATION,
    trees: int = fixed.FOREST_TREES,
    sample: int = fixed.FOREST_SAMPLE,
    seed: int = fixed.SEED,
) -> Detector:
    """Fit on all rows, keep the trees and the edge under ``path``, and load them from there."""
    spark = df.sparkSession
    grow_trees(tree_samples(df, features, trees, sample, seed), features, seed).write.parquet(f"{path}/nodes")
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes")
    sample_rows = min(sample, df.count())
    scored = stage(score_rows(df.select(*features), nodes, features, sample_rows), "scored")
    edge = exact_quantiles(scored, ["iso_score"], [1.0 - contamination]).first()
    facts = [(list(features), sample_rows, edge["quantile"] if edge else None)]
    spark.createDataFrame(facts, "features array<string>, sample_rows int, edge double").write.parquet(f"{path}/facts")
    return load_detector(spark, path)


def load_detector(spark: SparkSession, path: str) -> Detector:
    facts = spark.read.parquet(f"{path}/facts").first()
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes")
    return Detector(nodes, list(facts["features"]), facts["sample_rows"], facts["edge"])


def apply_detector(df: DataFrame, detector: Detector) -> DataFrame:
    """Scores and flags of any rows, without the rows it was fitted on."""
    scored = score_rows(df, detector.nodes, detector.features, detector.sample_rows)
    return scored.withColumn("iso_anomaly", (F.col("iso_score") > F.lit(detector.edge)).cast("int"))


def detect(df: DataFrame, threshold: float = 1.5, **forest) -> DataFrame:
    """Both layers and the combined flag."""
    flagged = rolling_zscore(isolation_forest(df, **forest), threshold)
    return flagged.withColumn("anomaly", F.greatest("iso_anomaly", "z_anomaly"))


def zscore_anomalies(df: DataFrame, threshold: float = 1.5, **options) -> DataFrame:
    """The statistical layer alone, with its flag as the anomaly."""
    return rolling_zscore(df, threshold, **options).withColumn("anomaly", F.col("z_anomaly"))


def anomaly_rows(flagged: DataFrame, columns: list[str]) -> DataFrame:
    return flagged.filter("anomaly = 1").select(*columns)


def anomaly_counts(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("zone").agg(F.sum("anomaly").alias("anomalies"))
