"""Toxicity severity by cumulative-link ordinal regression over sparse word features.

One weight vector is shared by all thresholds: P(grade > k) = sigmoid(x.w - theta_k) with rising
thetas. Features of a text are the distinct words of the whole lower-cased text and their first 4 to
7 bytes, known by 64-bit hashes; the model keeps those whose presence differs between toxic and
clean texts of the sample by a likelihood ratio of ``SCREEN``. Output: the probability of each
grade or more, the expected grade, and the likeliest grade.

Labels with more than two values are taken as grades. From 0/1 labels three grades are made: clean,
and toxic with fewer or with more than the median number of marker features of toxic texts.

The sample is bounded (``LABELLED_BOUND`` rows, the first in a fixed hash order; repeated texts
count once). Null and empty texts have no features and get the clean end of the scale that the
thresholds give; null labels are left out. Every row is scored by itself, extra columns stay.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import Words, flat, hashed_rank, mix, pieces, powers, prefix_hash, table, text_batches
from zonalis.session import stage

LABELLED_BOUND = 20_000
MIN_DOCS = 4
SCREEN = 24.0
HEADS = (4, 5, 6, 7)
SHARDS = 32
RIDGE = 1e-5
STEPS = 400


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # rising

    def logits(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        row, at = known_features(data, bounds, self.words)
        return np.bincount(row, self.weights[at], n) if len(row) else np.zeros(n)

    def at_least(self, logits: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... by row."""
        return _sigmoid(logits[:, None] - self.thresholds[None, :])


def features(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and feature hashes: of whole words, then of their beginnings by length."""
    words = Words(data, bounds)
    whole = prefix_hash(words.data)
    _, down = powers(len(words.data) + 1)
    rows, length = words.rows, words.ends - words.starts
    yield rows, mix((whole[words.ends] - whole[words.starts]) * down[words.starts])
    for n in HEADS:
        long = length >= n
        at = words.starts[long]
        yield rows[long], mix((whole[at + n] - whole[at]) * down[at] ^ np.uint64(n))


def known_features(data: np.ndarray, bounds: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and position in the vocabulary of each known feature, once a row."""
    found = [np.empty(0, np.int64)]
    if len(vocabulary):
        for rows, hashes in features(data, bounds):
            at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            hit = np.flatnonzero(vocabulary[at] == hashes)
            found.append(rows[hit] * len(vocabulary) + at[hit])
    pair = np.unique(np.concatenate(found))
    return pair // max(1, len(vocabulary)), pair % max(1, len(vocabulary))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, bound: int) -> DataFrame:
    """``label``, ``text`` and ``hash`` of at most ``bound`` labelled rows, each distinct text once.

    Of rows with the same id the one with the smallest text hash counts.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(
        F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(hashed_rank(key), key).limit(bound)
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias("text"))
    # one row per id, however often it is repeated: at most ``bound`` rows
    sample = rows.join(F.broadcast(chosen), key).groupBy(key).agg(
        F.max("label").alias("label"), F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return stage(sample.select("label", "least.text", "least.hash").dropDuplicates(["hash", "label"]), "labelled")


def _batch_pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    data, bounds = flat(batch.column("text"))
    for start, stop in pieces(bounds):
        part = bounds[start : stop + 1]
        yield data[part[0] : part[-1]], part - part[0], start


def ratio(inside, outside, p: int, n: int):
    """Likelihood ratio statistic of presence in positive and other texts, signed."""
    with np.errstate(divide="ignore", invalid="ignore"):
        total = 0.0
        share = (inside + outside) / (p + n)
        for seen, size in ((inside, p), (outside, n)):
            for k, e in ((seen, size * share), (size - seen, size * (1 - share))):
                total = total + np.where(k > 0, k * np.log(k / e), 0.0)
    return 2 * total * np.sign(inside / p - outside / n)


def screened(sample: DataFrame, p: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Features that tell positive from other texts, sorted, and whether they speak for positive."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = []
        for batch in batches:
            positive = batch.column("label").to_numpy(zero_copy_only=False) > 0
            for data, bounds, start in _batch_pieces(batch):
                for rows, hashes in features(data, bounds):
                    order = np.lexsort((hashes, rows))
                    r, h = rows[order], hashes[order]
                    once = np.concatenate([[True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])]) if len(r) else r > 0
                    keys.append((h[once] & ~np.uint64(1)) | positive[start + r[once]].astype(np.uint64))
        if keys:
            distinct, counts = np.unique(np.concatenate(keys), return_counts=True)
            edges = np.searchsorted(distinct >> np.uint64(32), np.arange(SHARDS + 1, dtype=np.uint64) * np.uint64(2**32 // SHARDS))
            edges[-1] = len(distinct)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SHARDS), pa.int32()),
                 pa.array([distinct[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
                 pa.array([counts[a:b].astype("<u4").tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary())],
                ["shard", "keys", "counts"])

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for batch in batches:
            keys += [np.frombuffer(x, "<u8") for x in batch.column("keys").to_pylist()]
            counts += [np.frombuffer(x, "<u4") for x in batch.column("counts").to_pylist()]
        keys, counts = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
        found, at = np.unique(keys & ~np.uint64(1), return_inverse=True)
        inside = np.bincount(at, counts * (keys & np.uint64(1)).astype(np.int64), len(found))
        outside = np.bincount(at, counts, len(found)) - inside
        value = ratio(inside, outside, p, n)
        keep = (inside + outside >= MIN_DOCS) & (np.abs(value) >= SCREEN)
        yield pa.RecordBatch.from_arrays([pa.array(found[keep].view(np.int64)), pa.array(value[keep] > 0)], ["feature", "toxic"])

    if not p or not n:
        return np.empty(0, np.uint64), np.empty(0, bool)
    counted = sample.select("label", "text").mapInArrow(count, "shard int, keys binary, counts binary")
    rows = counted.groupBy("shard").applyInArrow(screen, "feature bigint, toxic boolean").toPandas()
    words = rows["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], rows["toxic"].to_numpy(bool)[order]


def design(sample: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, and rows and columns of the ones of the sparse design matrix."""
    spark = sample.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, bounds, start in _batch_pieces(batch):
                row, at = known_features(data, bounds, sent.value)
                n = len(bounds) - 1
                cuts = np.searchsorted(row, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(start, n), batch.column("hash").slice(start, n),
                     pa.array([at[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                    ["label", "hash", "found"])

    rows = sample.mapInArrow(find, "label int, hash bigint, found binary").toPandas()  # the bounded sample
    rows = rows.sort_values(["hash", "label"], na_position="first")
    sets = [np.frombuffer(x, "<u4").astype(np.int64) for x in rows["found"]]
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    return rows["label"].to_numpy(np.int64), row, np.concatenate([*sets, np.empty(0, np.int64)])


def severity(labels: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 from 0/1 labels by the number of markers; other labels as they are."""
    if not len(labels) or labels.max() != 1:
        return labels
    toxic = labels == 1
    return labels + (toxic & (marks > np.median(marks[toxic])))


def fit_ordinal(row: np.ndarray, col: np.ndarray, grades: np.ndarray, width: int, top: int):
    """Weights and rising thresholds by Adam on the penalised likelihood."""
    n = len(grades)
    share = np.array([(np.sum(grades >= k) + 0.5) / (n + 1) for k in range(1, top + 1)])
    theta = np.log(1 / share - 1)
    step = np.log(np.maximum(np.diff(theta), 1e-2))
    par = np.concatenate([np.zeros(width), theta[:1], step])
    first = np.zeros_like(par)
    second = np.zeros_like(par)
    for t in range(1, STEPS + 1):
        w, theta = par[:width], np.concatenate([par[width : width + 1], par[width] + np.cumsum(np.exp(par[width + 1 :]))])
        logit = np.bincount(row, w[col], n) if width else np.zeros(n)
        above = np.concatenate([np.ones((n, 1)), _sigmoid(logit[:, None] - theta), np.zeros((n, 1))], axis=1)
        chance = above[np.arange(n), grades] - above[np.arange(n), grades + 1]
        slope = above * (1 - above)  # derivative by the logit, zero at the ends
        low, high = slope[np.arange(n), grades], slope[np.arange(n), grades + 1]
        inverse = 1 / np.maximum(chance, 1e-12)
        by_logit = -(low - high) * inverse
        by_theta = np.zeros(top)
        for k in range(top):
            by_theta[k] = np.sum((low * inverse)[grades == k + 1]) - np.sum((high * inverse)[grades == k])
        steps = np.exp(par[width + 1 :])
        grad = np.concatenate([
            np.bincount(col, by_logit[row], width) / n + RIDGE * w if width else np.empty(0),
            [by_theta.sum() / n],
            steps * np.cumsum(by_theta[::-1])[::-1][1:] / n,
        ])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        par = par - 0.1 * (1 - t / (STEPS + 1)) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return par[:width], np.concatenate([par[width : width + 1], par[width] + np.cumsum(np.exp(par[width + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        bound: int = LABELLED_BOUND) -> Model:
    text_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, key, text, label, bound)
    sizes = {r["positive"]: r["n"] for r in sample.groupBy((F.col("label") > 0).alias("positive")).agg(
        F.count("*").alias("n")).collect()}
    vocabulary, toxic = screened(sample, sizes.get(True, 0), sizes.get(False, 0))
    if not len(vocabulary):  # nothing tells toxic from clean
        return Model(vocabulary, np.empty(0), np.array([20.0]))
    found, row, col = design(sample, vocabulary)
    marks = np.bincount(row, toxic[col], len(found))
    grades = severity(found, marks)
    weights, thresholds = fit_ordinal(row, col, grades, len(vocabulary), int(grades.max()))
    return Model(vocabulary, weights, thresholds)


SCORED = "at_least:array<double>,expected:double,grade:int"


def score(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """All columns plus ``out``: struct of at_least, expected and grade."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by the labelled sample

    @F.arrow_udf(f"struct<{SCORED}>")
    def graded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for batch in batches:
            data, bounds = flat(batch)
            parts = []
            for start, stop in pieces(bounds):
                part = bounds[start : stop + 1]
                parts.append(model.logits(data[part[0] : part[-1]], part - part[0]))
            chance = model.at_least(np.concatenate(parts) if parts else np.empty(0))
            mass = -np.diff(np.concatenate([np.ones((len(chance), 1)), chance, np.zeros((len(chance), 1))], axis=1), axis=1)
            yield pa.StructArray.from_arrays(
                [pa.array(list(chance), pa.list_(pa.float64())), pa.array(chance.sum(axis=1)),
                 pa.array(mass.argmax(axis=1).astype(np.int32))],
                ["at_least", "expected", "grade"],
            )

    return df.withColumn(out, graded(F.col(f"`{text}`")))


def toxic(out: str = "toxicity", threshold: float = 0.3):
    """Rejected: some grade above clean is at least as likely as the threshold."""
    return F.col(out)["at_least"][0] >= threshold


def op4_toxicity(spark, sf_dir):
    """Severity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        F.col("toxicity.at_least")[0].alias("p_toxic"),
        F.col("toxicity.expected").alias("expected_severity"),
        F.col("toxicity.grade").alias("grade"),
        toxic().alias("rejected"),
    )
