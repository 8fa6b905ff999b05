"""Packing by lexical retrieval: windows of related documents from a sharded BM25 index.

A document is its ids and a closing id. Whole windows of long documents are sequences of their own;
what is left of each document is routed by content: all pieces of the input are ordered by their
heaviest term that a share ``BROAD`` of all documents has, then by their heaviest that two have, then by their
ids. Range partitions of that order are the tasks, so a hot term is divided by the next ones, and
copies are neighbours wherever they lay in the input. A shard is some ``SHARD_TOKENS`` of
neighbours in it, with an inverted index of their ids; pieces of other shards are not ranked.
Document frequencies are counted over all documents. The longest unused piece of a shard seeds a
window; the index ranks the unused pieces by BM25 for all terms of the seed; in that order pieces that fit go in whole, then the best of the rest is cut
so that the window is full, and what remains of it stays in the shard. With no unused neighbour
left, the longest pieces follow. What does not fill a window passes on to the task's next shard;
the last of a task is cut at powers of two, so nothing is padded.

Every id lies in exactly one piece. Null and empty texts have the closing id only. Repeated rows are
packed like any others; extra columns are not read; an empty table gives no rows. The order is
total, so pieces do not depend on where a task runs, and a lost executor's task gives the same pieces again.
"""

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm import bpe
from zonalis.llm.common import pieces, sum_vectors, table, text_batches, worker_state
from zonalis.session import fresh_path

WINDOW = 2048
CLOSING = 1
SHARD_TOKENS = 3_000_000
#: Share of all documents that a term needs to be the first by which pieces are routed.
BROAD = 1 / 256
#: Ids whose terms are weighed together, which bounds the memory of array work.
ROUTED_IDS = 1 << 20
K1, B = 1.2, 0.75
#: Terms that this share of a shard's pieces has get a row of all pieces' weights: 40 bytes a posting at most.
DENSE = 0.2

ENCODED = "key bigint, ids binary, frequencies binary"


def encode_documents(df: DataFrame, definition: str, key: str, text: str, closing: int) -> DataFrame:
    """Ids of each document as unsigned 16- or 32-bit integers, and each task's document frequencies."""
    sent = df.sparkSession.sparkContext.broadcast(definition)  # bounded by the vocabulary
    size = vocabulary_size(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = width(size)
        encoder = worker_state(("packing", kind, sent.value), lambda: bpe.quick_encoder(sent.value, kind))
        end = np.array([closing], kind)
        seen = np.zeros(size, np.int64)
        for batch in batches:
            coded = []
            ids, bounds = encoder.column(batch.column("text"))
            for start, stop in itertools.pairwise(bounds.tolist()):
                own = np.concatenate([ids[start:stop], end])
                seen[own] += 1  # by one, however often the document has the id
                coded.append(own.tobytes())
            none = pa.array([None] * len(coded), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(coded, pa.binary()), none],
                                             ["key", "ids", "frequencies"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([None], pa.binary()), pa.array([seen.astype("<u8").tobytes()], pa.binary())],
            ["key", "ids", "frequencies"])

    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, ENCODED)


def written(df: DataFrame, name: str) -> DataFrame:
    """Staged with a codec that shrinks ids, which the default one does not."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def vocabulary_size(definition: str) -> int:
    return bpe.Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True)


def width(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


ROUTED = "key bigint, ids binary, broad int, narrow int, digest bigint, place bigint"
ROUTE = ["broad", "narrow", "digest", "place"]


def heaviest(ids: list[np.ndarray], weights: np.ndarray, frequencies: np.ndarray, broad: float) -> list[np.ndarray]:
    """The heaviest term of each piece that ``broad`` and the one that two documents have, or -1; ties by id."""
    owner = np.repeat(np.arange(len(ids)) << 32, [len(x) for x in ids])
    pair, count = np.unique(owner + np.concatenate([np.empty(0, np.int64), *ids]), return_counts=True)
    piece, term = pair >> 32, pair & 0xFFFFFFFF
    weight = weights[term] * count * (K1 + 1) / (count + K1)
    found = []
    for least in (broad, 2):
        some = np.flatnonzero(frequencies[term] >= least)
        heavy = np.full(len(ids), -np.inf)
        np.maximum.at(heavy, piece[some], weight[some])
        best = some[weight[some] == heavy[piece[some]]]
        named, first = np.unique(piece[best], return_index=True)
        found.append(np.full(len(ids), -1))
        found[-1][named] = term[best[first]]
    return found


def by_content(rows: DataFrame, sent, kind: str, window: int) -> DataFrame:
    """Keys and ids in the order of their routes, in range partitions of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, frequencies, documents = sent.value
        broad = max(2.0, BROAD * documents)
        place = TaskContext.get().partitionId() << 32
        for batch in batches:
            rests = []
            for packed in batch.column("ids"):
                ids = np.frombuffer(packed.as_py(), kind)
                rests.append(ids[len(ids) // window * window :])
            digests = [zlib.crc32(x.tobytes()) for x in rests]
            spans = pieces(np.cumsum([0, *map(len, rests)]), ROUTED_IDS)
            terms = [heaviest(rests[a:b], idf, frequencies, broad) for a, b in spans]
            both = [np.concatenate(x) for x in zip(*terms, strict=True)] if terms else [(), ()]
            columns = [*both, digests, np.arange(place, place + len(rests))]
            place += len(rests)
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("ids"), *made], ["key", "ids", *ROUTE])

    # written, as the range partitions' sample would work out all routes once more
    routed = written(rows.mapInArrow(run, ROUTED), "routes")
    return routed.repartitionByRange(*ROUTE).sortWithinPartitions(*ROUTE).select("key", "ids")


class Shard:
    """BM25 index over the ids of some pieces, and the pieces not yet used."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray):
        self.length = np.array([len(x) for x in ids])
        n, size = len(ids), len(idf)
        owner = np.repeat(np.arange(n), self.length)
        pair, count = np.unique(owner * size + np.concatenate(ids), return_counts=True)
        self.doc, term = pair // size, pair % size
        norm = K1 * (1 - B + B * self.length / self.length.mean())
        self.weight = idf[term] * count * (K1 + 1) / (count + norm[self.doc])
        self.of_doc = np.searchsorted(self.doc, np.arange(n + 1))
        self.term = term
        dense = np.flatnonzero(np.bincount(term, minlength=size) > DENSE * n)
        self.row = np.full(size, -1)
        self.row[dense] = np.arange(len(dense))
        self.rows, self.live = np.zeros((len(dense), n)), np.arange(n)
        row = self.row[term]
        some, others = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        self.rows[row[some], self.doc[some]] = self.weight[some]
        order = others[np.argsort(term[others], kind="stable")]
        self.posting_doc, self.posting_weight = self.doc[order], self.weight[order]
        self.from_term = np.searchsorted(term[order], np.arange(size + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all pieces that are not forgotten, for all terms of the seed."""
        terms = self.term[self.of_doc[seed] : self.of_doc[seed + 1]]
        row = self.row[terms]
        others = terms[row < 0]
        spans = [slice(0, 0), *map(slice, self.from_term[others].tolist(), self.from_term[others + 1].tolist())]
        dense = np.zeros(len(self.live))
        for k in row[row >= 0].tolist():
            dense += self.rows[k]
        score = np.zeros(len(self.length))
        score[self.live] = dense
        score += np.bincount(np.concatenate([self.posting_doc[x] for x in spans]),
                             np.concatenate([self.posting_weight[x] for x in spans]), len(score))
        return score

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused pieces with a term of the seed, best first; ties by position."""
        score = self.scores(seed)
        found = np.flatnonzero(unused & (score > 0))
        return found[np.argsort(-score[found], kind="stable")]

    def forget(self, unused: np.ndarray) -> None:
        """Take used pieces out of the postings and rows."""
        live = unused[self.live]
        self.live, self.rows = self.live[live], np.compress(live, self.rows, axis=1)
        keep = unused[self.posting_doc]
        self.from_term = np.concatenate([[0], np.cumsum(keep)])[self.from_term]
        self.posting_doc, self.posting_weight = self.posting_doc[keep], self.posting_weight[keep]


class Packer:
    """Fills windows from shards of pieces (key, start, tokens of the document, ids)."""

    def __init__(self, idf: np.ndarray, window: int):
        self.idf, self.window = idf, window
        self.done: list[tuple] = []
        self.sequence = 0

    def put(self, pieces: list[tuple]) -> None:
        """One sequence."""
        offset = 0
        for key, start, whole, ids in pieces:
            self.done.append((key, start, whole, ids, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def whole_windows(self, key, ids: np.ndarray) -> tuple | None:
        """Sequences of the document's own; what is left of it."""
        full = len(ids) // self.window * self.window
        for start in range(0, full, self.window):
            self.put([(key, start, len(ids), ids[start : start + self.window])])
        return (key, full, len(ids), ids[full:]) if full < len(ids) else None

    def fill(self, pieces: list[tuple]) -> list[tuple]:
        """Pack a shard; the pieces that do not fill a window come back."""
        if not pieces:
            return []
        index = Shard([p[3] for p in pieces], self.idf)
        left = index.length.copy()  # a cut piece keeps its end
        unused = np.ones(len(pieces), bool)
        by_length = np.argsort(-left, kind="stable")
        cut: list[int] = []
        total, at = int(left.sum()), 0
        indexed = total

        def take(i: int, room: int) -> tuple:
            key, start, whole, ids = pieces[i]
            begin = len(ids) - left[i]
            size = min(room, int(left[i]))
            left[i] -= size
            unused[i] = left[i] > 0
            return (key, start + int(begin), whole, ids[begin : begin + size])

        while total >= self.window:
            if total < 0.8 * indexed:
                index.forget(unused)
                indexed = total
            while not unused[by_length[at]]:
                at += 1
            # what was cut seeds the next window, so that its ends stay near each other
            seed = cut.pop() if cut and unused[cut[-1]] else int(by_length[at])
            members = [take(seed, self.window)]
            room = self.window - len(members[0][3])
            if room:
                score = index.scores(seed)
                found = np.flatnonzero(unused & (score > 0))  # as ``neighbours``, without sorting what is not taken
                fits = found[left[found] <= room]
                while len(fits):  # whole pieces that fit, best first
                    i = int(fits[score[fits].argmax()])
                    members.append(take(i, room))
                    room -= len(members[-1][3])
                    fits = fits[unused[fits] & (left[fits] <= room)]
                found = found[unused[found]]
                if room and len(found):
                    i = int(found[score[found].argmax()])
                    members.append(take(i, room))
                    room -= len(members[-1][3])
                    if unused[i]:
                        cut.append(i)
            ahead = at
            while room:  # no neighbour is left: the longest pieces follow
                while not unused[by_length[ahead]]:
                    ahead += 1
                i = int(by_length[ahead])
                members.append(take(i, room))
                room -= len(members[-1][3])
                if unused[i]:
                    cut.append(i)
            total -= self.window
            self.put(members)
        return [take(int(i), self.window) for i in np.flatnonzero(unused)]

    def finish(self, pieces: list[tuple]) -> None:
        """Sequences of lengths that are powers of two from what is left of a task."""
        rest = list(reversed(pieces))
        total = sum(len(p[3]) for p in pieces)
        while total:
            size = min(self.window, 1 << (total.bit_length() - 1))
            members, room = [], size
            while room:
                key, start, whole, ids = rest.pop()
                members.append((key, start, whole, ids[:room]))
                if len(ids) > room:
                    rest.append((key, start + room, whole, ids[room:]))
                room -= len(members[-1][3])
            self.put(members)
            total -= size


PIECES = "key bigint, start bigint, length bigint, doc_tokens bigint, ids binary, sequence_id bigint, offset bigint"


def pack(df: DataFrame, definition: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         closing: int = CLOSING) -> DataFrame:
    """Pieces: ``key``, place in the document, ``ids`` (32-bit), ``sequence_id`` and place there.

    ``window`` must be a power of two for sequences of other lengths to need no padding.
    """
    spark = df.sparkSession
    text_batches(spark)
    size = vocabulary_size(definition)
    encoded = written(encode_documents(df, definition, key, text, closing), "ids")
    parts = encoded.where("frequencies IS NOT NULL").select(F.lit(0).alias("all"), "frequencies")
    total = np.zeros(size, np.int64)
    for row in sum_vectors(parts, "all", "frequencies", "<u8").collect():  # one row, as long as the vocabulary
        total = np.frombuffer(row["frequencies"], "<u8").astype(np.int64)
    documents = int(total[closing]) if len(total) > closing else 0
    idf = np.log1p((documents - total + 0.5) / (total + 0.5))
    sent = spark.sparkContext.broadcast((idf, total, documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, base = width(size), TaskContext.get().partitionId() << 32
        packer = Packer(sent.value[0], window)
        shard: list[tuple] = []
        held = 0

        def rows():
            done, packer.done = packer.done, []
            columns = list(zip(*done, strict=True)) if done else [()] * 6
            ids = [np.ascontiguousarray(x, "<u4") for x in columns[3]]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array([len(x) for x in ids], pa.int64()), pa.array(columns[2], pa.int64()),
                 pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([base + s for s in columns[4]], pa.int64()),
                 pa.array(columns[5], pa.int64())],
                ["key", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"])

        for batch in batches:
            for name, packed in zip(batch.column("key").to_pylist(), batch.column("ids"), strict=True):
                ids = np.frombuffer(packed.as_py(), kind)
                rest = packer.whole_windows(name, ids)
                if rest:
                    shard.append(rest)
                    held += len(rest[3])
                if held >= SHARD_TOKENS:
                    shard = packer.fill(shard)
                    held = sum(len(p[3]) for p in shard)
                    yield rows()
            if packer.done:
                yield rows()
        packer.finish(packer.fill(shard))
        yield rows()

    routed = by_content(encoded.where("ids IS NOT NULL").select("key", "ids"), sent, width(size), window)
    return routed.mapInArrow(run, PIECES).withColumnRenamed("key", key)


def op9_packing(spark, sf_dir):
    """Pieces of all documents in windows of 2048 ids."""
    definition = bpe.from_json(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = pack(table(spark, sf_dir, "documents"), definition)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")
