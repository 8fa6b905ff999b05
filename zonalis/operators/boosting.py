"""Second-order boosting over binned features, for many settings and folds in the same passes.

Features are cut once at quantiles of the training rows, and rows are kept as one byte per feature. A
pass over the rows grows one level of the current tree of every model: each task adds gradients and
hessians by (model, class, node, feature, bin) for all models at once, Spark sums the cells, and the
driver reads totals whose number depends on the settings only. Then a leaf's weight is
``-G / (H + penalty)`` and a split gains ``(GL^2 / (HL + penalty) + GR^2 / (HR + penalty) -
G^2 / (H + penalty)) / 2``. So a search over settings and folds needs no more passes than its largest
model. Gradients are summed as whole multiples of 2^-24: results do not depend on the order of rows.

Squared error has one output that starts at the mean of the label; class labels have one output per
class, joined by a softmax (not one model against the rest). Each output has its own tree in a round.
Every ``RESTAGE`` rounds the sums so far are written beside the rows, so a pass replays few trees.

Rows with a null label or vector are left out of a fit; missing numbers go right.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions import fixed
from zonalis.operators.trees import Trees
from zonalis.session import stage

BINS = 64
UNIT = float(1 << 24)
RESTAGE = 16
#: A fold that no row has: the model sees all rows.
ALL_ROWS = -1
#: Above every fold.
NO_END = 1 << 30


@dataclass(frozen=True)
class Settings:
    rounds: int = 100
    depth: int = 3
    rate: float = 0.1
    subsample: float = 1.0
    columns: float = 1.0  # share of features per tree
    penalty: float = 1.0
    least_weight: float = 1.0
    fold: int = ALL_ROWS  # rows of this fold are left out
    until: int = NO_END  # rows of this and later folds are left out


class Grown:
    """A tree over bin numbers while it grows."""

    def __init__(self):
        self.left, self.right, self.feature, self.bin, self.weight, self.cover = [-1], [-1], [-1], [-1], [0.0], [0.0]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(c) for c in (self.left, self.right, self.feature, self.bin, self.weight))

    def split(self, node: int, feature: int, at: int, sides: list[tuple[float, float]]) -> list[int]:
        """Two children with (weight, cover) each."""
        children = [len(self.left), len(self.left) + 1]
        for weight, cover in sides:
            for column, value in zip((self.left, self.right, self.feature, self.bin, self.weight, self.cover),
                                     (-1, -1, -1, -1, weight, cover), strict=True):
                column.append(value)
        self.left[node], self.right[node] = children
        self.feature[node], self.bin[node] = feature, at
        return children


def places(tree: tuple[np.ndarray, ...], codes: np.ndarray) -> np.ndarray:
    """The node that each row reaches."""
    left, right, feature, at, _ = tree
    node, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
    while (inner := left[node] >= 0).any():
        goes_left = codes[rows, np.where(inner, feature[node], 0)] <= at[node]
        node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
    return node


def gradients(margins: np.ndarray, y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows by outputs: first and second derivatives of the loss."""
    if not classes:
        return margins - y[:, None], np.ones_like(margins)
    odds = np.exp(margins - margins.max(1, keepdims=True))
    p = odds / odds.sum(1, keepdims=True)
    return p - (y[:, None] == np.arange(classes)), np.maximum(2 * p * (1 - p), 1e-16)


def drawn(number: np.ndarray, model: int, round_: int, share: float) -> np.ndarray:
    """Rows that a round of a model sees, by the hash of the row."""
    h = number.view(np.uint64) ^ np.uint64((model * 0x9E3779B97F4A7C15 + round_ * 0xC2B2AE3D27D4EB4F) % 2**64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(11)) / 2.0**53 < share


def quantile_edges(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Upper ends of the bins of each feature, from one aggregate."""
    probs = [i / bins for i in range(1, bins)]
    if not width:
        return []
    x = F.col("x")
    row = rows.agg(*[F.percentile_approx(x[j], probs, 100 * bins).alias(f"q{j}") for j in range(width)],
                   *[F.max(F.when(~F.isnan(x[j]), x[j])).alias(f"m{j}") for j in range(width)]).first()
    edges = []
    for j in range(width):
        known = [v for v in row[f"q{j}"] or [] if np.isfinite(v)]
        edges.append(np.unique([*known, row[f"m{j}"]])[:-1] if row[f"m{j}"] is not None else np.empty(0))
    return edges


_STAGED = "number bigint, fold int, y double, codes binary, margins binary"


@dataclass(frozen=True)
class Boosted:
    """A fitted ensemble: ``trees`` has one output, or one per class."""

    trees: Trees
    classes: int
    settings: Settings


def fit(rows: DataFrame, settings: Settings | list[Settings], label: str = "y", classes: int = 0,
        features: str = "features", fold: str | None = None, key: tuple[str, ...] = ("zone", "date"), bins: int = BINS) -> list[Boosted]:
    """One ensemble per setting. ``classes`` is the number of classes of an integer label, 0 for a number.

    ``fold`` names a column of fold numbers for settings that leave one or the later ones out.
    """
    settings = [settings] if isinstance(settings, Settings) else list(settings)
    if bins > 256:
        raise ValueError("a bin number must fit in a byte")
    number = F.xxhash64(F.lit(fixed.SEED), *[F.col(k) for k in key])
    known = rows.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        number.alias("number"), (F.col(fold) if fold else F.lit(ALL_ROWS - 1)).cast("int").alias("fold"),
        F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))
    known = stage(known, "boosting")
    width, outputs = known.agg(F.max(F.size("x"))).first()[0] or 0, max(classes, 1)
    seen = {(s.fold, s.until): (F.col("fold") != s.fold) & (F.col("fold") < s.until) for s in settings}
    means = dict(zip(seen, known.agg(*[F.avg(F.when(c, F.col("y"))) for c in seen.values()]).first(), strict=True))
    offsets = [np.zeros(outputs) if classes else np.array([means[s.fold, s.until] or 0.0]) for s in settings]
    edges = quantile_edges(known, width, bins)
    begun = np.stack(offsets).astype("<f8").tobytes()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
            codes = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], 1).astype(np.uint8) if width else x.astype(np.uint8)
            columns = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([begun] * len(batch), pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("number", "fold", "y")), *columns],
                                             ["number", "fold", "y", "codes", "margins"])

    table = stage(known.mapInArrow(code, _STAGED), "binned")
    done: list[list[list[Grown]]] = [[] for _ in settings]  # model, round, output
    for round_ in range(max(s.rounds for s in settings)):
        if round_ and round_ % RESTAGE == 0:
            table = stage(_with_margins(table, done, settings, width, outputs, round_ - RESTAGE), "margins")
        _grow(table, done, settings, edges, width, classes, round_)
    return [Boosted(_assembled(trees, s, o, edges), classes, s) for trees, s, o in zip(done, settings, offsets, strict=True)]


def _batch_arrays(batch: pa.RecordBatch, width: int, models: int, outputs: int):
    read = lambda name, kind: np.frombuffer(b"".join(batch.column(name).to_pylist()), kind)
    codes = read("codes", np.uint8).reshape(len(batch), width)
    margins = read("margins", "<f8").reshape(len(batch), models, outputs).copy()
    return codes, margins, *(batch.column(c).to_numpy() for c in ("number", "fold", "y"))


def _added(margins: np.ndarray, codes: np.ndarray, trees: list, rates: list[float]) -> None:
    """Adds the outputs of trees (model, round, output) to the sums."""
    for m, rounds in enumerate(trees):
        for outputs in rounds:
            for k, tree in enumerate(outputs):
                margins[:, m, k] += rates[m] * tree[4][places(tree, codes)]


def _with_margins(table: DataFrame, done, settings: list[Settings], width: int, outputs: int, since: int) -> DataFrame:
    trees = [[[t.arrays() for t in r] for r in rounds[since:]] for rounds in done]
    rates, models = [s.rate for s in settings], len(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, margins, *_ = _batch_arrays(batch, width, models, outputs)
            _added(margins, codes, trees, rates)
            column = pa.array([m.astype("<f8").tobytes() for m in margins], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], batch.schema.names)

    return table.select("number", "fold", "y", "codes", "margins").mapInArrow(run, _STAGED)


def _grow(table: DataFrame, done, settings: list[Settings], edges: list[np.ndarray], width: int, classes: int, round_: int) -> None:
    """One round: every level of the trees of all models that still have rounds to go."""
    outputs, cells = max(classes, 1), max((len(e) for e in edges), default=0) + 1
    live = [m for m, s in enumerate(settings) if round_ < s.rounds]
    trees = {(m, k): Grown() for m in live for k in range(outputs)}
    frontier = {lane: [0] for lane in trees}
    allowed = {}
    for m in live:
        draw = np.random.default_rng([fixed.SEED, m, round_])
        count = max(1, round(settings[m].columns * width))
        allowed[m] = np.isin(np.arange(width), draw.permutation(width)[:count]) if count < width else np.ones(width, bool)
    for level in range(max((settings[m].depth for m in live), default=0)):
        lanes = {lane: nodes for lane, nodes in frontier.items() if nodes and level < settings[lane[0]].depth}
        if not lanes or not width:
            break
        totals = _histograms(table, done, trees, lanes, settings, width, cells, classes, round_)
        for (m, k), nodes in lanes.items():
            s, tree, following = settings[m], trees[m, k], []
            for place, node in enumerate(nodes):
                cell = totals.get((m, k))
                if cell is None:
                    continue
                g, h = cell[place, :, :, 0], cell[place, :, :, 1]  # feature by bin
                whole_g, whole_h = g[0].sum(), h[0].sum()
                if level == 0:
                    tree.weight[0], tree.cover[0] = float(-whole_g / (whole_h + s.penalty)), float(whole_h)
                left_g, left_h = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                right_g, right_h = whole_g - left_g, whole_h - left_h
                worth = left_g**2 / (left_h + s.penalty) + right_g**2 / (right_h + s.penalty) - whole_g**2 / (whole_h + s.penalty)
                fits = (left_h >= s.least_weight) & (right_h >= s.least_weight) & allowed[m][:, None]
                worth = np.where(fits, worth / 2, -np.inf)
                if not worth.size or worth.max() <= 1e-9:
                    continue
                feature, at = np.unravel_index(worth.argmax(), worth.shape)
                sides = [(float(-a / (b + s.penalty)), float(b)) for a, b in
                         ((left_g[feature, at], left_h[feature, at]), (right_g[feature, at], right_h[feature, at]))]
                following += tree.split(node, int(feature), int(at), sides)
            frontier[m, k] = following
    for m in live:
        done[m].append([trees[m, k] for k in range(outputs)])


def _histograms(table: DataFrame, done, trees, lanes, settings: list[Settings], width: int, cells: int, classes: int,
                round_: int) -> dict:
    """Sums of gradients and hessians by lane, as arrays of frontier node by feature by bin by two."""
    outputs, models = max(classes, 1), len(settings)
    since = round_ - round_ % RESTAGE
    earlier = [[[t.arrays() for t in r] for r in rounds[since:]] for rounds in done]
    current = {lane: (trees[lane].arrays(), nodes) for lane, nodes in lanes.items()}
    rates = [s.rate for s in settings]
    used = sorted({m for m, _ in lanes})
    plain = {m: (settings[m].fold, settings[m].until, settings[m].subsample) for m in used}
    unit = UNIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {lane: np.zeros((len(nodes) * width * cells, 2), np.int64) for lane, (_, nodes) in current.items()}
        for batch in batches:
            codes, margins, number, fold, y = _batch_arrays(batch, width, models, outputs)
            _added(margins, codes, earlier, rates)
            offset = np.arange(width) * cells + codes
            for m in used:
                left_out, until, share = plain[m]
                seen = (fold != left_out) & (fold < until)
                if share < 1:
                    seen &= drawn(number, m, round_, share)
                g, h = gradients(margins[:, m], y, classes)
                for k in range(outputs):
                    if (m, k) not in current:
                        continue
                    tree, nodes = current[m, k]
                    place = np.full(len(tree[0]), -1)
                    place[nodes] = np.arange(len(nodes))
                    at = place[places(tree, codes)]
                    rows = np.flatnonzero(seen & (at >= 0))
                    flat = (at[rows, None] * (width * cells) + offset[rows]).ravel()
                    for c, values in enumerate((g, h)):
                        whole = np.rint(values[rows, k] * unit)
                        sums[m, k][:, c] += np.rint(np.bincount(flat, np.repeat(whole, width), len(sums[m, k]))).astype(np.int64)
        for (m, k), total in sums.items():
            some = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), m * outputs + k)), pa.array(some), pa.array(total[some, 0]), pa.array(total[some, 1])],
                ["lane", "cell", "g", "h"])

    parts = table.mapInArrow(run, "lane bigint, cell bigint, g bigint, h bigint")
    found = parts.groupBy("lane", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    lane, cell, g, h = (found.column(c).to_numpy() for c in ("lane", "cell", "g", "h"))
    totals = {}
    for m, k in lanes:
        of = lane == m * outputs + k
        if of.any():
            total = np.zeros((len(lanes[m, k]) * width * cells, 2))
            total[cell[of], 0], total[cell[of], 1] = g[of] / unit, h[of] / unit
            totals[m, k] = total.reshape(len(lanes[m, k]), width, cells, 2)
    return totals


def _assembled(rounds: list[list[Grown]], s: Settings, offset: np.ndarray, edges: list[np.ndarray]) -> Trees:
    """Node arrays in the features' own units."""
    columns = [[] for _ in range(6)]
    roots, values, base = [], [], 0
    for grown in rounds:
        for k, tree in enumerate(grown):
            left, right, feature, at, weight = tree.arrays()
            value = np.zeros((len(left), len(offset)))
            value[:, k] = np.where(left < 0, s.rate * weight, 0.0)
            roots.append(base)
            values.append(value)
            threshold = np.array([edges[f][b] if f >= 0 else np.nan for f, b in zip(feature, at, strict=True)])
            for column, part in zip(columns, (np.where(left < 0, -1, left + base), np.where(right < 0, -1, right + base),
                                              feature, threshold, np.array(tree.cover)), strict=False):
                column.append(part)
            base += len(left)
    joined = [np.concatenate(c) if c else np.empty(0) for c in columns[:5]]
    value = np.concatenate(values) if values else np.empty((0, len(offset)))
    return Trees(np.array(roots, np.int64), *joined[:2], *joined[2:], value, offset)


def outputs(model: Boosted, df: DataFrame, features: str = "features") -> Column:
    """The ensemble's outputs per row as an array: the level, or a margin per class."""
    sent = df.sparkSession.sparkContext.broadcast(model.trees)

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            known = batch.drop_null()
            width = len(known[0]) if len(known) else 0
            made = sent.value.predict(known.flatten().to_numpy(zero_copy_only=False).reshape(len(known), width))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * made.shape[1]), pa.array(made.ravel()))
            at = np.cumsum(batch.is_valid().to_numpy(zero_copy_only=False)) - 1
            yield lists.take(pa.array(at, mask=batch.is_null().to_numpy(zero_copy_only=False)))

    return run(F.when(F.col(features).isNotNull(), vector_to_array(features)))


def predict(model: Boosted, df: DataFrame, name: str, features: str = "features") -> DataFrame:
    """The shape of ``models.predict``, or with classes that of ``models.predict_class``."""
    scored = df.withColumn("__out", outputs(model, df, features))
    if not model.classes:
        return scored.select("zone", "date", F.lit(name).alias("model"), "y", F.col("__out")[0].alias("p"))
    top = F.array_max("__out")
    odds = F.transform("__out", lambda v: F.exp(v - top))
    total = F.aggregate(odds, F.lit(0.0), lambda a, v: a + v)
    best = (F.array_position("__out", top) - 1).cast("int")
    return scored.select("zone", "date", F.lit(name).alias("model"), F.col("risk").cast("int").alias("y"), best.alias("p"),
                         F.transform(odds, lambda v: v / total).alias("probability"))
