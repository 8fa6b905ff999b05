"""Interpolated modified Kneser-Ney bigram model: counted in Spark, memory-mapped for scoring.

Counting moves packed arrays, not a row per n-gram: a task sorts and sums what it reads before it
writes one row per shard. The vocabulary is the sorted array of 64-bit word hashes, a word's number
its rank there. Pairs are sorted arrays of (first << 32 | second) with one-byte counts (255: see the
list of large ones). They are sharded on a grid, by remainders of both numbers, so that a word that
starts or ends a third of all pairs is spread over a row or column of the grid; counts by context
and by continuation are summed from the grid's cells into dense arrays by number.

All of it lies in the shared folder, which must be a mounted file system; workers map the files and
do not hold the model in memory. Everything grows with the corpus; nothing is pruned.

Texts are lower-cased (A-Z); a null text is empty and has only the end token. Every row is scored by
itself; extra columns are not read. With no training rows every token has the same probability 1.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm.common import Words, flat, map_array, mounted, pieces, table, write_array
from zonalis.session import fresh_path

#: Tokens a task holds before it sorts and sums them.
FLUSH_TOKENS = 3_000_000
END = np.uint64(0x5EED0E4D)  # stands for the end of a text among word hashes
LARGE = 255

PACKED = "shard int, keys binary, counts binary"


@dataclass
class Store:
    """Where the model lies; arrays are mapped on first use in each worker."""

    folder: str
    side: int  # the grid has side x side cells, the vocabulary as many shards
    sizes: list[int] = field(default_factory=list)  # words by shard
    tokens: int = 0
    pairs: int = 0
    pair_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_mass: float = 1.0  # what the continuation shares leave to the uniform distribution
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_open": {}}

    @property
    def shards(self) -> int:
        return self.side * self.side

    @property
    def words(self) -> int:
        return sum(self.sizes)

    @property
    def block(self) -> int:
        """Word numbers by dense block."""
        return max(1, -(-(self.words + 1) // self.shards))

    def path(self, kind: str, i: int) -> str:
        return f"{self.folder}/{kind}-{i:06d}"

    def array(self, kind: str, i: int, dtype: str) -> np.ndarray:
        if (kind, i) not in self._open:
            self._open[kind, i] = map_array(self.path(kind, i), dtype)
        return self._open[kind, i]

    def shard_of(self, hashes: np.ndarray) -> np.ndarray:
        return (((hashes >> np.uint64(32)) * np.uint64(self.shards)) >> np.uint64(32)).astype(np.int64)

    def cell_of(self, pairs: np.ndarray) -> np.ndarray:
        a, b = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
        side = np.uint64(self.side)
        return ((a % side) * side + b % side).astype(np.int64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers of sorted distinct hashes, -1 for those not in the vocabulary."""
        before = np.concatenate([[0], np.cumsum(self.sizes)])
        out = np.full(len(hashes), -1, np.int64)
        edges = np.searchsorted(self.shard_of(hashes), np.arange(self.shards + 1))
        for i in np.flatnonzero(np.diff(edges)):
            asked, known = hashes[edges[i] : edges[i + 1]], self.array("words", i, "<u8")
            if len(known):
                at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                out[edges[i] : edges[i + 1]] = np.where(known[at] == asked, at + before[i], -1)
        return out

    def pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pairs, 0 for unseen ones."""
        cell = self.cell_of(pairs)
        order = np.argsort(cell, kind="stable")
        edges = np.searchsorted(cell[order], np.arange(self.shards + 1))
        out = np.zeros(len(pairs), np.int64)
        for i in np.flatnonzero(np.diff(edges)):
            rows = order[edges[i] : edges[i + 1]]
            known = self.array("pairs", i, "<u8")
            if not len(known):
                continue
            asked = pairs[rows]
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            found = np.where(known[at] == asked, self.array("paircounts", i, "u1")[at], 0).astype(np.int64)
            if (big := np.flatnonzero(found == LARGE)).size:
                place = self.array("large", i, "<u8").reshape(-1, 2)
                found[big] = place[np.searchsorted(place[:, 0], asked[big]), 1]
            out[rows] = found
        return out

    def dense(self, kind: str, numbers: np.ndarray, width: int = 1) -> np.ndarray:
        """Values of sorted distinct word numbers from the dense blocks."""
        out = np.zeros((len(numbers), width), np.int64)
        edges = np.searchsorted(numbers // self.block, np.arange(self.shards + 1))
        for i in np.flatnonzero(np.diff(edges)):
            part = slice(edges[i], edges[i + 1])
            held = self.array(kind, i, "<u8").reshape(-1, width)
            if len(held):
                out[part] = held[numbers[part] - i * self.block]
        return out


def _tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token hashes and the number of tokens by row, piece by piece; each row ends in END."""
    data, bounds = flat(column)
    for start, stop in pieces(bounds):
        part = bounds[start : stop + 1]
        words = Words(data[part[0] : part[-1]], part - part[0])
        counts = np.diff(words.first)
        hashes = words.hashes()
        hashes[hashes == END] ^= np.uint64(1)
        yield np.insert(hashes, words.first[1:], END), counts + 1


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]


def _packed(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row per shard; keys come sorted and stay so within a shard."""
    order = np.argsort(shard, kind="stable")
    shard, keys, counts = shard[order], keys[order], counts[order]
    edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else [0]
    spans = list(zip(edges, edges[1:], strict=False))
    width = "u1" if not len(counts) or counts.max() < 256 else "<u8"
    return pa.RecordBatch.from_arrays(
        [pa.array([int(shard[a]) for a, _ in spans], pa.int32()),
         pa.array([keys[a:b].tobytes() for a, b in spans], pa.binary()),
         pa.array([counts[a:b].astype(width).tobytes() for a, b in spans], pa.binary())],
        ["shard", "keys", "counts"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> tuple[int, np.ndarray, np.ndarray]:
    shard, keys, counts = 0, [], []
    for batch in batches:
        for s, k, c in zip(*(batch.column(n).to_pylist() for n in ("shard", "keys", "counts")), strict=True):
            shard = s
            keys.append(np.frombuffer(k, "<u8"))
            counts.append(np.frombuffer(c, "u1" if len(c) == len(keys[-1]) else "<u8").astype(np.int64))
    return shard, np.concatenate(keys), np.concatenate(counts)


def _count(rows: DataFrame, keys_of, shard_of) -> DataFrame:
    """Packed counts of the keys that ``keys_of`` makes of each piece of tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            keys = np.sort(np.concatenate(held))
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(np.concatenate([starts, [len(keys)]]))
            return _packed(shard_of(keys[starts]), keys[starts], counts)

        for batch in batches:
            for hashes, lengths in _tokens(batch.column("text")):
                held.append(keys_of(hashes, lengths))
                n += len(held[-1])
                if n >= FLUSH_TOKENS:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return rows.select("text").mapInArrow(run, PACKED)


def _numbered(store: Store, hashes: np.ndarray) -> np.ndarray:
    distinct, at = np.unique(hashes, return_inverse=True)
    return store.numbers(distinct)[at]


def _contexts(numbers: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The number before each token; ``start`` at the beginning of a text."""
    before = np.concatenate([[start], numbers[:-1]])
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = start
    return before


def count_words(rows: DataFrame, store: Store) -> Store:
    """Write the vocabulary with the counts of its words."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, counts = _unpacked(batches)
        keys, counts = _summed(keys, counts)
        write_array(store.path("words", shard), keys.astype("<u8"))
        write_array(store.path("wordcounts", shard), counts.astype("<u8"))
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n": [len(keys)], "tokens": [int(counts.sum())]})

    packed = _count(rows, lambda hashes, lengths: hashes, store.shard_of)
    made = packed.groupBy("shard").applyInArrow(write, "shard int, n bigint, tokens bigint").collect()
    sizes = {r["shard"]: r["n"] for r in made}  # a row per shard
    store.sizes = [sizes.get(i, 0) for i in range(store.shards)]
    store.tokens = sum(r["tokens"] for r in made)
    return store


def count_pairs(rows: DataFrame, store: Store) -> Store:
    """Write the pairs and the dense counts by context and continuation; set the discounts."""

    def pairs_of(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        numbers = _numbered(store, hashes)
        before = _contexts(numbers, lengths, store.words)
        return (before.astype(np.uint64) << np.uint64(32)) | numbers.astype(np.uint64)

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, pairs, counts = _unpacked(batches)
        pairs, counts = _summed(pairs, counts)
        big = counts >= LARGE
        write_array(store.path("pairs", shard), pairs.astype("<u8"))
        write_array(store.path("paircounts", shard), np.minimum(counts, LARGE).astype("u1"))
        write_array(store.path("large", shard), np.stack([pairs[big], counts[big].astype(np.uint64)], 1).astype("<u8"))
        first, second = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        yield _by_block(first, [counts, counts == 1, counts == 2, counts > 2], "context")
        yield _by_block(second, [np.ones(len(second), np.int64)], "continuation")
        seen = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1 - shard % store.side], pa.int32()), pa.array(["pairs"]), pa.array([b""], pa.binary()),
             pa.array([seen.astype("<i8").tobytes()], pa.binary())], names)

    def _by_block(numbers: np.ndarray, values: list[np.ndarray], kind: str) -> pa.RecordBatch:
        order = np.argsort(numbers, kind="stable")
        ranked = numbers[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.empty(0, int)
        sums = np.stack([np.add.reduceat(v[order].astype(np.int64), starts) for v in values], 1) if len(starts) else np.empty((0, len(values)))
        ids = ranked[starts]
        edges = np.searchsorted(ids // store.block, np.arange(store.shards + 1))
        spans = [(i, edges[i], edges[i + 1]) for i in np.flatnonzero(np.diff(edges))]
        small = "<u4" if not sums.size or sums.max() < 2**32 else "<u8"
        return pa.RecordBatch.from_arrays(
            [pa.array([int(i) for i, _, _ in spans], pa.int32()), pa.array([kind] * len(spans), pa.string()),
             pa.array([ids[a:b].astype("<u4").tobytes() for _, a, b in spans], pa.binary()),
             pa.array([sums[a:b].astype(small).tobytes() for _, a, b in spans], pa.binary())],
            names)

    names = ["block", "kind", "numbers", "values"]

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {"context": np.zeros((store.block, 4), np.int64), "continuation": np.zeros((store.block, 1), np.int64),
                 "pairs": np.zeros((1, 4), np.int64)}
        block = 0
        for batch in batches:
            for block, kind, ids, values in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                into = total[kind]
                if kind == "pairs":
                    into += np.frombuffer(values, "<i8")
                    continue
                at = np.frombuffer(ids, "<u4").astype(np.int64) - block * store.block
                width = "<u4" if len(values) == 4 * len(at) * into.shape[1] else "<u8"
                into[at] += np.frombuffer(values, width).reshape(-1, into.shape[1]).astype(np.int64)
        if block >= 0:
            write_array(store.path("context", block), total["context"].astype("<u8"))
            write_array(store.path("continuation", block), total["continuation"].astype("<u8"))
        held = total["continuation"][:, 0]
        seen = np.bincount(np.minimum(held, 5), minlength=6)[1:5]
        seen = [*seen.tolist(), int((held > 2).sum()), int(held.sum())]
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "pairs": [total["pairs"][0].tolist()],
                                          "words": [seen]})

    packed = _count(rows, pairs_of, store.cell_of)
    cells = packed.groupBy("shard").applyInArrow(cell, "block int, kind string, numbers binary, values binary")
    made = cells.groupBy("block").applyInArrow(dense, "block int, pairs array<bigint>, words array<bigint>").collect()
    if not made:
        return store
    pairs = np.sum([r["pairs"] for r in made], axis=0)
    words = np.sum([r["words"] for r in made], axis=0)  # n1..n4, words with 3 or more, all pairs
    store.pairs = int(words[5])
    store.pair_discounts = discounts(pairs)
    store.word_discounts = discounts(words[:4])
    taken = np.array(store.word_discounts) @ np.array([words[0], words[1], words[4]])
    store.word_mass = float(taken / store.pairs)
    return store


def discounts(seen) -> tuple[float, float, float]:
    """For counts 1, 2 and above from the counts of counts; small corpora may lack some."""
    n1, n2, n3, n4 = (float(x) for x in seen)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = [k - (k + 1) * y * b / a if a else k * y for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(float(min(max(d, 0.0), k)) if d > 0 else min(0.5, y or 0.5) for k, d in enumerate(out, 1))


def train(rows: DataFrame, text: str = "text", side: int | None = None) -> Store:
    """Count the texts. ``side``: the grid's edge, by default the root of the shuffle partitions."""
    spark = rows.sparkSession
    if side is None:
        side = max(2, int(np.ceil(np.sqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    store = Store(mounted(fresh_path(spark, "kneser-ney")), side)
    texts = rows.select(F.col(f"`{text}`").alias("text"))
    store = count_words(texts, store)
    return count_pairs(texts, store) if store.tokens else store


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


class Scorer:
    """Log10 probabilities of token hashes for one worker."""

    def __init__(self, store: Store):
        self.store = store
        self.before = np.concatenate([[0], np.cumsum(store.sizes)])

    def word_counts(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.int64)
        edges = np.searchsorted(numbers, self.before)
        for i in np.flatnonzero(np.diff(edges)):
            part = slice(edges[i], edges[i + 1])
            out[part] = self.store.array("wordcounts", i, "<u8")[numbers[part] - self.before[i]]
        return out

    def __call__(self, hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts, log10 of the base model and log10 of the bigram model by token."""
        store = self.store
        distinct, at = np.unique(hashes, return_inverse=True)
        numbers = store.numbers(distinct)
        known = np.flatnonzero(numbers >= 0)
        counts = np.zeros(len(distinct), np.int64)
        shares = np.full(len(distinct), store.word_mass / (store.words + 1))
        if len(known):
            counts[known] = self.word_counts(numbers[known])
            held = store.dense("continuation", numbers[known])[:, 0]
            shares[known] += (held - _discount(held, store.word_discounts)) / store.pairs
        base = np.log10((counts + 1) / (store.tokens + store.words + 1))
        now = numbers[at]
        before = _contexts(now, lengths, store.words)
        chance = shares[at]
        seen = np.flatnonzero(before >= 0)  # contexts of the vocabulary
        if store.pairs and len(seen):
            ids, place = np.unique(before[seen], return_inverse=True)
            total, one, two, more = store.dense("context", ids, 4).T
            left = np.array(store.pair_discounts) @ np.stack([one, two, more]) / np.maximum(total, 1)
            pair_rows = np.flatnonzero(now[seen] >= 0)
            keys = (before[seen][pair_rows].astype(np.uint64) << np.uint64(32)) | now[seen][pair_rows].astype(np.uint64)
            asked, where = np.unique(keys, return_inverse=True)
            found = store.pair_counts(asked)[where]
            direct = np.zeros(len(seen))
            direct[pair_rows] = found - _discount(found, store.pair_discounts)
            used = total[place] > 0
            mixed = direct / np.maximum(total[place], 1) + left[place] * chance[seen]
            chance[seen] = np.where(used, mixed, chance[seen])
        return counts[at], base[at], np.log10(chance)


SCORES = "n_tokens bigint, n_known bigint, base_score double, score double"


def score(df: DataFrame, store: Store, keys: list[str], text: str = "text") -> DataFrame:
    """The key columns with the counts and log10 probabilities of each whole text."""
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    names = ["n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(store)
        for batch in batches:
            parts = []
            for hashes, lengths in _tokens(batch.column("__text")):
                counts, base, own = scorer(hashes, lengths)
                starts = np.cumsum(lengths) - lengths
                parts.append([lengths, *(np.add.reduceat(v, starts) for v in ((counts > 0).astype(np.int64), base, own))])
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0)] * 4
            arrays = [pa.array(c.astype(t)) for c, t in zip(columns, ("i8", "i8", "f8", "f8"), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *arrays], [*keys, *names])

    return df.select(*keys, F.col(f"`{text}`").alias("__text")).mapInArrow(run, f"{shape}, {SCORES}")


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out().alias("held_out"))
    store = train(docs.where("NOT held_out"))
    scored = score(docs, store, ["doc_id", "held_out"])
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(store.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
