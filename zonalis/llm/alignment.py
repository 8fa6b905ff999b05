"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes at different places. A token points to the farthest-right token
that overlaps it: the other tokenizer's token that holds its last byte or, where both end there, the
left one of the two, which points to itself. Replacing every pointer by its pointer's pointer until
nothing changes takes each token to the last token of its component after as many rounds as the
longest chain has binary digits; that token labels the group. All texts of a piece are aligned in one
pass over arrays, as their tokens tile the same line of bytes.

A link is a pair of overlapping tokens. How many links of the whole corpus have the same two ids is
counted in Spark: tasks work in blocks of texts and send a row per distinct pair of a block, the
counts are summed by pair, and the pairs of a block come back to it as one table. So no task holds
more than a block, and a frequent pair is a row per block. The best count of each right id has a row
per id of the vocabulary and is broadcast.

Left are byte-level BPE ids of a space and the text, right are SentencePiece ids of the text, whose
first piece has that space. Null and empty texts have no tokens; nor have texts whose tokens do not
spell the text, such as those with U+2581. Repeated rows are texts of their own and count
each. Columns other than key and text are not read. An empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from zonalis.llm import bpe, sentencepieces
from zonalis.llm.common import table, text_batches, worker_state
from zonalis.session import stage

#: Bytes of text that are aligned at once, and whose pairs are counted at once.
PIECE, BLOCK = 1 << 19, 1 << 23
#: Blocks that a task of the second pass reads, and chunks that a worker's encoder keeps.
TASK_BLOCKS, ROOM = 4, 250_000


class Left:
    """Byte-level ids of texts after a space."""

    def __init__(self, definition: str):
        decoder = bpe.Decoder(definition)
        self.bytes, self.lengths = decoder.bytes, decoder.lengths
        self.encoder = bpe.quick_encoder(definition, room=ROOM)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        # the letter is a match of its own before the space, whatever follows
        return [np.frombuffer(self.encoder("a " + t), "<u4")[1:] for t in texts]


class Right:
    """SentencePiece ids of texts."""

    def __init__(self, model: bytes):
        self.processor = SentencePieceProcessor(model_proto=model)
        size = self.processor.get_piece_size()
        self.bytes = [self.spelled(i) for i in range(size)]
        self.lengths = np.array([len(b) for b in self.bytes])

    def spelled(self, i: int) -> bytes:
        piece = self.processor.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.processor.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, "<u4") for ids in self.processor.encode(texts, num_threads=1)]


def worker_left(definition: str) -> Left:
    """One per worker process."""
    return worker_state(("alignment left", definition), lambda: Left(definition))


def worker_right(model: bytes) -> Right:
    return worker_state(("alignment right", model), lambda: Right(model))


def jump(pointers: np.ndarray) -> np.ndarray:
    """The end of each chain of pointers, by successor doubling."""
    while True:
        further = pointers[pointers]
        if np.array_equal(further, pointers):
            return pointers
        pointers = further


class Alignment:
    """Groups and links of texts whose left and right tokens (lengths in bytes, end to end) tile the same bytes.

    ``left_first`` and ``right_first`` are the token bounds of the texts.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, left_first: np.ndarray, right_first: np.ndarray):
        n = len(left)
        left_end, right_end = np.cumsum(left), np.cumsum(right)
        #: the token of the other side that holds the last byte
        self.over = np.searchsorted(right_end, left_end)
        self.under = np.searchsorted(left_end, right_end)
        last = right_end[self.over] == left_end if n else np.empty(0, bool)
        own = np.arange(n)
        ends = jump(np.concatenate([np.where(last, own, n + self.over), self.under]))
        number = np.cumsum(last) - 1
        self.left_group, self.right_group = number[ends[:n]], number[ends[n:]]
        self.inner = np.flatnonzero(right_end != left_end[self.under]) if n else np.empty(0, np.int64)
        self.left_first, self.right_first = left_first, right_first
        ended = np.concatenate([[0], np.cumsum(last)])
        self.group_first = ended[left_first]
        self.inner_first = np.searchsorted(self.inner, right_first)

    def codes(self, left: np.ndarray, right: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Pair codes of the links that end with a left token, and of those that end within one."""
        a, b = left.astype(np.int64), right.astype(np.int64)
        return a * size + b[self.over], a[self.under[self.inner]] * size + b[self.inner]

    def sums(self, of_left: np.ndarray, of_inner: np.ndarray) -> np.ndarray:
        """Sums by text of values of the links, given in the order of ``codes``."""
        out = np.zeros(len(self.left_first) - 1, np.int64)
        for values, first in ((of_left, self.left_first), (of_inner, self.inner_first)):
            out += np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[first])
        return out

    def shown(self, left: np.ndarray, right: np.ndarray, printed: np.ndarray) -> list[str]:
        """Each text's groups as ``a1,a2|b1;a3|b2``; ``printed`` has each id with each of the three marks."""
        n, m = len(left), len(right)
        if not n:
            return [""] * (len(self.left_first) - 1)
        groups = int(self.left_group[-1]) + 1
        in_left, in_right = (np.bincount(g, minlength=groups) for g in (self.left_group, self.right_group))
        parts = np.empty(n + m, object)
        for ids, group, before, mark in (
            (left, self.left_group, np.cumsum(in_right) - in_right, 1), (right, self.right_group, np.cumsum(in_left), 2)
        ):
            closes = np.concatenate([group[1:] != group[:-1], [True]])
            parts[np.arange(len(ids)) + before[group]] = printed[ids.astype(np.int64) * 3 + closes * mark]
        first = (self.left_first + self.right_first).tolist()
        return ["".join(parts[a:b].tolist())[:-1] for a, b in zip(first, first[1:], strict=False)]


def printed_ids(size: int) -> np.ndarray:
    make = lambda: np.array([f"{i}{mark}" for i in range(size) for mark in ",|;"], object)
    return worker_state(("printed ids", size), make)


def bounds(parts: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([0, *map(len, parts)])


def joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, "<u4"), *parts])


def tokens(texts: list[str | None], left: Left, right: Right) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of both sides; none where they do not spell a space and the text."""
    asked = [t or "" for t in texts]
    found = [], []
    for text, a, b in zip(asked, left(asked), right(asked), strict=True):
        want = f" {text}".encode()
        same = text and all(b"".join(map(side.bytes.__getitem__, ids.tolist())) == want
                            for side, ids in ((left, a), (right, b)))
        found[0].append(a if same else a[:0])
        found[1].append(b if same else b[:0])
    return found


def parts_of(sizes: list[int], limit: int) -> Iterator[slice]:
    """Neighbouring rows of some ``limit`` in all, at least one."""
    start = held = 0
    for i, size in enumerate(sizes):
        held += size
        if held >= limit:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


def width(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


STAGED = "block bigint, keys array<{kind}>, sizes binary, left_ids binary, right_ids binary, code bigint, links bigint"
_NAMES = ["block", "keys", "sizes", "left_ids", "right_ids", "code", "links"]


def packed(parts: list[np.ndarray], kind: str) -> bytes:
    """Ids end to end, compressed: they are written twice on their way."""
    return zstandard.ZstdCompressor(level=3).compress(joined(parts).astype(kind).tobytes())


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind).astype("<u4")


def encode_blocks(df: DataFrame, definition: str, model: bytes, key: str, text: str) -> DataFrame:
    """Two kinds of rows: the keys, sizes and ids of a piece of texts, and a pair of ids (``code``) with
    its number of links in a block of pieces."""
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast((definition, model))  # bounded by the vocabularies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = worker_left(sent.value[0]), worker_right(sent.value[1])
        kinds, size = (width(len(left.bytes)), width(len(right.bytes))), len(right.bytes)
        block, held = TaskContext.get().partitionId() << 32, 0
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            key_type = batch.schema.field("key").type
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for part in parts_of(lengths, PIECE):
                a, b = tokens(batch.column("text")[part.start : part.stop].to_pylist(), left, right)
                flat, first = (joined(a), joined(b)), (bounds(a), bounds(b))
                aligned = Alignment(left.lengths[flat[0]], right.lengths[flat[1]], *first)
                seen.append(np.unique(np.concatenate(aligned.codes(*flat, size)), return_counts=True))
                keys = pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), batch.column("key")[part.start : part.stop])
                blobs = [np.concatenate([np.diff(f) for f in first]).astype("<u4").tobytes(),
                         *(packed(x, k) for x, k in zip((a, b), kinds, strict=True))]
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), keys, *(pa.array([x], pa.binary()) for x in blobs), none, none], _NAMES)
                held += sum(lengths[part])
                if held >= BLOCK:
                    yield pair_rows(seen, block, key_type)
                    seen, held, block = [], 0, block + 1
        if seen:
            yield pair_rows(seen, block, key_type)

    return rows.mapInArrow(run, STAGED.format(kind=kind))


def pair_rows(seen: list[tuple[np.ndarray, np.ndarray]], block: int, kind: pa.DataType) -> pa.RecordBatch:
    """The distinct pairs of a block's pieces with their numbers of links."""
    codes, place = np.unique(np.concatenate([c for c, _ in seen]), return_inverse=True)
    links = np.zeros(len(codes), np.int64)
    np.add.at(links, place, np.concatenate([n for _, n in seen]))
    n = len(codes)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, block)), pa.nulls(n, pa.list_(kind)), *[pa.nulls(n, pa.binary())] * 3,
         pa.array(codes), pa.array(links)], _NAMES)


ALIGNED = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
_COUNTED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def align(df: DataFrame, definition: str, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: key, tokens of both sides, groups, links, links whose pair is the most frequent of
    its right id (ties included), sum of the corpus-wide counts of its links, and ``groups``: left and right
    ids of each group in order, as ``a1,a2|b1;a3|b2,b3``.
    """
    text_batches(df.sparkSession)
    right_size = SentencePieceProcessor(model_proto=model).get_piece_size()
    print_size = max(right_size, bpe.Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True))
    staged = stage(encode_blocks(df, definition, model, key, text), "aligned")
    pairs = staged.where("code IS NOT NULL").select("block", "code", "links")
    totals = pairs.groupBy("code").agg(F.sum("links").alias("total")).withColumn("right", F.expr(f"code % {right_size}"))
    totals = stage(totals, "pair-counts")
    best = totals.groupBy("right").agg(F.max("total").alias("most"))  # at most a row per id
    known = totals.join(F.broadcast(best), "right").select("code", "total", (F.col("total") == F.col("most")).alias("best"))
    answers = pairs.select(F.col("block").alias("asked"), "code").join(known.hint("merge"), "code")
    texts = staged.where("code IS NULL").select("block", "keys", "sizes", "left_ids", "right_ids")
    # a group is a block, whatever the input; the number of tasks follows the number of blocks
    blocks = texts.agg(F.count_distinct("block")).first()[0]
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks // TASK_BLOCKS))
    texts, answers = texts.repartition(tasks, "block"), answers.repartition(tasks, "asked")
    sent = df.sparkSession.sparkContext.broadcast((definition, model))
    kind = texts.schema["keys"].dataType.elementType.simpleString()

    def count(texts: pa.Table, answers: pa.Table) -> pa.Table:
        left, right = worker_left(sent.value[0]), worker_right(sent.value[1])
        kinds, printed = (width(len(left.bytes)), width(len(right.bytes))), printed_ids(print_size)
        codes, total, best = (answers.column(c).to_numpy() for c in ("code", "total", "best"))
        order = np.argsort(codes)
        codes, total, best = codes[order], total[order], best[order]
        columns = [[] for _ in _COUNTED]
        for sizes, a, b in zip(*(texts.column(c) for c in ("sizes", "left_ids", "right_ids")), strict=True):
            flat = unpacked(a.as_py(), kinds[0]), unpacked(b.as_py(), kinds[1])
            counts = np.frombuffer(sizes.as_py(), "<u4").astype(np.int64).reshape(2, -1)
            first = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
            aligned = Alignment(left.lengths[flat[0]], right.lengths[flat[1]], *first)
            places = [np.searchsorted(codes, c) for c in aligned.codes(*flat, right_size)]
            numbers = [*counts, np.diff(aligned.group_first), counts[0] + np.diff(aligned.inner_first),
                       aligned.sums(*(best[p] for p in places)), aligned.sums(*(total[p] for p in places))]
            for column, values in zip(columns, numbers, strict=False):
                column.append(pa.array(values.astype(np.int64)))
            columns[6].append(pa.array(aligned.shown(*flat, printed), pa.string()))
        types = [pa.int64()] * 6 + [pa.string()]
        keys = pa.chunked_array([x.flatten() for x in texts.column("keys").chunks], texts.schema.field("keys").type.value_type)
        return pa.Table.from_arrays([keys, *(pa.chunked_array(c, t) for c, t in zip(columns, types, strict=True))],
                                    ["key", *_COUNTED])

    made = texts.groupBy("block").cogroup(answers.groupBy("asked")).applyInArrow(count, f"key {kind}, {ALIGNED}")
    return made.withColumnRenamed("key", key)


def op13_alignment(spark, sf_dir):
    """Groups and links of the tokens of every document, with corpus-wide counts of the linked ids."""
    definition = bpe.from_json(public_tokenizers.path("byte_bpe_50k.json"))
    model = sentencepieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    found = align(table(spark, sf_dir, "documents"), definition, model)
    hashed = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return found.withColumn("groups_sha256", hashed).drop("groups")
