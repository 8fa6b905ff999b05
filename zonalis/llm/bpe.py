"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file lists byte strings by rank. Its merges follow from the ranks: the last merge of a
token joins the two parts to which the lower ranks reduce it. Bytes travel through the library as
printable characters; the same table turns token strings back into bytes.

A single space or newline between two non-space characters always starts a match of the
pattern, so what stands between such places is encoded apart and each distinct chunk once per
worker while its cache has room. Texts with other white space are encoded whole. Both ways
give the same ids.

The ranks of a definition allow more: whole columns are cut at all places that start a match whatever
stands around them, and each distinct chunk of some megabytes is encoded once, or once per worker while
there is room.
"""

import base64
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from zonalis.llm.common import flat, pieces, ranges, table, text_batches, worker_state

#: Distinct chunks a worker keeps (some 150 bytes each); beyond it chunks are encoded anew.
CACHE_CHUNKS = 300_000
#: Letters below this code point are letters to every version of Unicode.
LATIN_END = "\u0250"
#: Bytes of text whose distinct chunks are encoded together, which bounds the memory of array work.
CHUNK_BYTES = 1 << 22
#: Distinct chunks a worker keeps, the first that it saw; larger tables take longer to look up than to encode anew.
KNOWN_CHUNKS = 50_000
#: White space beyond ASCII in any version of Unicode, its UTF-8 bytes read as a number.
WIDE_SPACE = [int.from_bytes(chr(c).encode(), "big")
              for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 ones for themselves."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in own else spare))
        spare += b not in own
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The pair whose merge makes the token, using merges of lower rank before."""
    own, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, i = min(found)
        if rank >= own:
            return None
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def from_ranks(path: str, pattern: str = public_tokenizers.PATTERN) -> str:
    """A tokenizer for a rank file, as the library's JSON."""
    ranks, shown = read_ranks(path), byte_characters()
    text = lambda token: "".join(shown[b] for b in token)
    merges = [last_merge(t, ranks) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
    model = models.BPE(
        vocab={text(t): r for t, r in ranks.items()},
        merges=[(text(a), text(b)) for a, b in filter(None, merges)],
        ignore_merges=True,
    )
    built = Tokenizer(model)
    built.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return built.to_str()


def from_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _regular(chunk: str) -> bool:
    """No white space at an edge (Python's idea of white space holds all that the pattern's does)."""
    return bool(chunk) and not chunk[0].isspace() and not chunk[-1].isspace()


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | (data - np.uint8(9) < 5)


def after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space beyond ASCII ends at each place; a character beyond ASCII must end there."""
    two = data[at - 2].astype(np.int64) << 8 | data[at - 1]
    three = data[at - 3].astype(np.int64) << 16 | two
    return np.isin(two, WIDE_SPACE) | np.isin(three, WIDE_SPACE)


def chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The bounds of texts and of chunks in them.

    A chunk starts with white space after another character, or with another ASCII character after an
    ASCII letter. No match of the byte-level pattern spans such a place or depends on what is before it.
    """
    space, letter = is_space(data), (data | np.uint8(32)) - np.uint8(97) < 26
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (space[1:] & ~space[:-1]) | (letter[:-1] & ~letter[1:] & (data[1:] < 128))
    high = np.flatnonzero(cut[1:-1] & (data[:-1] > 127)) + 1
    cut[high[after_wide_space(data, high)]] = False
    cut[bounds] = True
    return np.flatnonzero(cut)


class Encoder:
    """Texts to packed ids (little-endian, ``dtype``) for one worker."""

    def __init__(self, definition: str, dtype: str = "<u4", room: int = CACHE_CHUNKS):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.dtype, self.room = dtype, room
        self.inner: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.newline = self.whole("\n")
        self.marks = {mark: self.whole(mark) for mark in ".,"}
        [self.newline_id] = np.frombuffer(self.newline, dtype)

    def whole(self, text: str) -> bytes:
        [coded] = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(coded.ids, self.dtype).tobytes()

    def added(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks after a space, encoded in one call with a newline between them."""
        joined = np.frombuffer(self.whole(" " + "\n ".join(chunks)), self.dtype)
        cuts = np.flatnonzero(joined == self.newline_id)
        starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(joined)]
        found = {c: joined[s:e].tobytes() for c, s, e in zip(chunks, starts, ends, strict=True)}
        if len(self.inner) < self.room:
            self.inner.update(found)
        return found

    def head(self, chunk: str) -> bytes:
        ids = self.heads.get(chunk)
        if ids is None:
            ids = self.whole(chunk)
            if len(self.heads) < self.room // 8:
                self.heads[chunk] = ids
        return ids

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts: list[bytes | None] = []
        chunks: list[str] = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            if not _regular(head):
                return self.whole(text)
            parts.append(self.head(head))
            parts.extend(map(self.inner.get, rest))
            parts.append(self.newline)
            chunks.append("")
            chunks.extend(rest)
            chunks.append("")
        parts.pop()
        if None in parts:
            gaps = [i for i, ids in enumerate(parts) if ids is None]
            new = {chunks[i] for i in gaps}
            if not all(map(_regular, new)):
                return self.whole(text)
            marked = {c for c in new if c[-1] in self.marks and c[:-1].isalpha() and max(c) < LATIN_END}
            bases = {c[:-1] for c in marked}
            asked = list((new - marked) | {b for b in bases if b not in self.inner})
            found = self.added(asked) if asked else {}
            for c in marked:  # the mark is a match of its own
                base = found.get(c[:-1])
                found[c] = (self.inner[c[:-1]] if base is None else base) + self.marks[c[-1]]
                if len(self.inner) < self.room:
                    self.inner[c] = found[c]
            for i in gaps:
                parts[i] = found[chunks[i]]
        return b"".join(parts)

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the bounds of each text's; null has none."""
        coded = [np.frombuffer(self(t.as_py()), self.dtype) for t in texts]
        return np.concatenate([np.empty(0, self.dtype), *coded]), np.cumsum([0, *map(len, coded)])


class RankEncoder:
    """The ids of ``Encoder`` by the tiktoken library, for tokenizers whose merges are their vocabulary.

    Right where merges ascend by id, each token has one way to be merged last, the pattern is the
    byte-level one and nothing is normalized; other definitions are refused.
    """

    def __init__(self, definition: str, dtype: str = "<u4", room: int = KNOWN_CHUNKS):
        rules = json.loads(definition)
        vocab, merges, split = rules["model"]["vocab"], rules["model"]["merges"], rules["pre_tokenizer"] or {}
        back = {c: b for b, c in enumerate(byte_characters())}
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        own = {t: i for t, i in vocab.items() if all(c in back for c in t)}
        special = {t["content"] for t in rules["added_tokens"]}
        ranks = {bytes(back[c] for c in t): i for t, i in own.items() if t not in special}
        if not plain or rules["normalizer"] or made != sorted(set(made)) or len(ranks) != len(made) + 256:
            raise ValueError("ids of this tokenizer do not follow from ranks")
        self.coding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = Encoder(definition, dtype).whole
        self.dtype = dtype
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.lengths[list(ranks.values())] = [len(t) for t in ranks]
        self.room = room
        none = np.empty(0, np.int64)
        #: Chunks encoded before, and what ``distinct`` gave for them.
        self.known = (pa.array([], pa.large_binary()), np.empty(0, dtype), none, none)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        try:
            return self.coding.encode_to_numpy(text).astype(self.dtype).tobytes()
        except ValueError:  # white space of some hundred thousand characters is too long for its pattern
            return self.whole(text)

    def distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each chunk start and how many they are.

        Chunks that end without white space are encoded in one call: those that start with it stand end to
        end, the others follow a newline, which is a match of its own there.
        """
        data, bounds = flat(chunks)
        size, head, last = np.diff(bounds), data[bounds[:-1]], data[bounds[1:] - 1]
        spaced, joins = is_space(head), ~is_space(last) & (head < 128)
        high = np.flatnonzero(last > 127)
        joins[high] &= ~after_wide_space(data, bounds[1:][high])
        close, lined, alone = (np.flatnonzero(x) for x in (joins & spaced, joins & ~spaced, ~joins))
        text = b"\n".join([flat(chunks.take(pa.array(close)))[0].tobytes(), *chunks.take(pa.array(lined)).to_pylist()])
        ids = np.frombuffer(self(text.decode()), self.dtype)

        order = np.concatenate([close, lined])
        newlines = np.maximum(np.arange(len(order)) - len(close) + 1, 0)
        start = np.cumsum(size[order]) - size[order] + newlines
        place = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        first, count = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        first[order] = np.searchsorted(place, start)
        count[order] = np.searchsorted(place, start + size[order]) - first[order]

        own = [np.frombuffer(self(c.decode()), self.dtype) for c in chunks.take(pa.array(alone)).to_pylist()]
        count[alone] = [len(x) for x in own]
        first[alone] = len(ids) + np.cumsum(count[alone]) - count[alone]
        return np.concatenate([ids, *own]), first, count

    def chunks(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of neighbouring chunks end to end, and how many each has."""
        known, ids, first, count = self.known
        given = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        found = pa.concat_arrays([known, given]).dictionary_encode()  # the known ones keep their places
        more = self.distinct(found.dictionary[len(known) :])
        first = np.concatenate([first, more[1] + len(ids)])
        ids, count = np.concatenate([ids, more[0]]), np.concatenate([count, more[2]])
        if len(known) < self.room and bounds[-1] - bounds[0] <= CHUNK_BYTES:
            self.known = (found.dictionary[: self.room], ids, first[: self.room], count[: self.room])
        which = found.indices.to_numpy()[len(known) :]
        return ids[ranges(first[which], count[which])], count[which]

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the bounds of each text's; null has none."""
        data, bounds = flat(texts)
        coded, ends, total = [np.empty(0, self.dtype)], [np.zeros(1, np.int64)], 0
        for a, b in pieces(bounds, CHUNK_BYTES):
            part, within = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
            starts, counts = chunk_starts(part, within), [np.zeros(1, np.int64)]
            for s, e in pieces(starts, CHUNK_BYTES):
                ids, count = self.chunks(part, starts[s : e + 1])
                coded.append(ids)
                counts.append(count)
            before = np.cumsum(np.concatenate(counts))
            ends.append(total + before[np.searchsorted(starts, within[1:])])
            total += int(before[-1])
        return np.concatenate(coded), np.concatenate(ends)


def quick_encoder(definition: str, dtype: str = "<u4", room: int = CACHE_CHUNKS) -> "RankEncoder | Encoder":
    """The faster of both that gives the definition's ids."""
    try:
        return RankEncoder(definition, dtype)
    except ValueError:
        return Encoder(definition, dtype, room)


class Decoder:
    """Packed ids back to bytes: token strings through the reversed byte table."""

    def __init__(self, definition: str):
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = Tokenizer.from_str(definition).get_vocab()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in back for c in token)
            self.bytes[i] = bytes(back[c] for c in token) if known else token.encode()
        self.lengths = np.array([len(t) for t in self.bytes])

    def __call__(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(packed, "<u4").tolist()))

    def spans(self, packed: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one character of each id.

        A character whose bytes are split between ids belongs to each of them.
        """
        ends = np.cumsum(self.lengths[np.frombuffer(packed, "<u4")]).astype(np.int64)
        starts = np.concatenate([ends[:0], [0], ends[:-1]]) if len(ends) else ends
        lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        number = np.cumsum(lead) - 1  # of the character that a byte belongs to
        return (number[starts], number[ends - 1] + 1) if len(ends) else (starts, ends)


def worker_encoder(definition: str) -> Encoder:
    """One encoder per worker process, so that its caches serve all its tasks and are held once."""
    return worker_state(("byte-level encoder", definition), lambda: Encoder(definition))


def worker_decoder(definition: str) -> Decoder:
    return worker_state(("byte-level decoder", definition), lambda: Decoder(definition))


def encode(
    df: DataFrame, definition: str, text: str = "text", out: str = "ids", spans: str | None = None
) -> DataFrame:
    """All columns plus ``out``: ids as little-endian 32-bit integers in a binary.

    ``spans`` names one more column, an array of (start, stop) characters by id. Null and empty
    texts get no ids. Columns of the same names are replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(definition)  # bounded by the vocabulary
    kind = "ids:binary,spans:array<struct<start:int,stop:int>>" if spans else "ids:binary"
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    @F.arrow_udf(f"struct<{kind}>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(sent.value)
        decoder = worker_decoder(sent.value) if spans else None
        for batch in batches:
            ids = [encoder(t.as_py()) for t in batch]
            columns = {"ids": pa.array(ids, pa.binary())}
            if decoder:
                found = []
                for packed, t in zip(ids, batch, strict=True):
                    first, last = decoder.spans(packed, (t.as_py() or "").encode())
                    found.append([{"start": a, "stop": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)])
                columns["spans"] = pa.array(found, span_type)
            yield pa.StructArray.from_arrays(list(columns.values()), list(columns))

    made = df.withColumn("__coded", coded(F.col(f"`{text}`")))
    made = made.withColumn(out, F.col("__coded.ids"))
    if spans:
        made = made.withColumn(spans, F.col("__coded.spans"))
    return made.drop("__coded")


def decode(df: DataFrame, definition: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns plus ``out``, the bytes of the ids; null ids give no bytes."""
    sent = df.sparkSession.sparkContext.broadcast(definition)

    @F.arrow_udf("binary")
    def plain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = worker_decoder(sent.value)
        for batch in batches:
            yield pa.array([decoder(x.as_py() or b"") for x in batch], pa.binary())

    return df.withColumn(out, plain(F.col(f"`{ids}`")))


def op6_bpe(spark, sf_dir):
    """Ids of every document and their way back, as digests."""
    text_batches(spark)
    definition = from_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, definition).select("doc_id", "ids")
    return decode(coded, definition).select(
        "doc_id",
        F.expr("bigint(octet_length(ids) div 4)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
