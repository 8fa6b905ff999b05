"""SentencePiece encoding and decoding for merge-type (BPE) models, exact by backtracking.

Merging the best neighbours until none is left has one result, and a sequence of pieces is that
result if and only if each two neighbours are: merging their joined characters again must give back
the two. So no merge queue over the text is needed. An Aho-Corasick automaton gives the longest
piece at each place; the walk takes it if it is compatible with the piece before, else the next
shorter one that starts there, else it steps back and marks the place in a bitfield as one that no
sequence can pass. The pieces up to a place are themselves the merge result of that prefix, so a
place fails whatever led to it and is tried once: time is linear in the text.

Two characters that no piece holds side by side are never merged, so texts are cut there, and each
distinct chunk between spaces is encoded once per worker process while its cache has room.

Characters without a piece become the byte pieces of their UTF-8, or the unknown id where the model
has none. Null and empty texts have no ids. The model must be of merge type, without character map,
white-space trimming, user-defined or unused pieces; others are refused.
"""

import re
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from zonalis.llm.common import table, text_batches, worker_state

SPACE = "▁"
#: Distinct chunks and pairs of pieces that a worker keeps; beyond it they are worked out anew.
CACHE_CHUNKS, CACHE_PAIRS = 450_000, 1_000_000
#: Texts whose ids are Python numbers at once.
DECODED_AT_ONCE = 100
ID = "<i4"


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Pieces:
    """What encoding needs of a model: texts, merge ranks and packed ids of its pieces."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules, kinds = proto.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE:
            raise ValueError("not a merge-type model")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("models with character maps or white-space rules are not supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("white space as a suffix is not supported")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        score = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        number = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        #: smaller ranks merge first, equal ranks from the left
        self.rank = {piece: number[s] for piece, s in score.items()}
        packed = {p.piece: np.array([i], ID).tobytes() for i, p in enumerate(proto.pieces)}
        unknown = next(packed[p.piece] for p in proto.pieces if p.type == kinds.UNKNOWN)
        held = [packed.get(f"<0x{b:02X}>", unknown) for b in range(256)]
        self.fallback = held if proto.trainer_spec.byte_fallback else None
        self.unknown = unknown
        #: neighbours within pieces; other neighbours never merge
        self.joints = {a + b for piece in score for a, b in pairwise(piece)}
        characters = {c for piece in score for c in piece}
        self.texts = [p for p in score if len(p) == 1 or len(self.merged(p)) == 1]
        self.texts += sorted(c for c in characters if c not in score)
        self.packed = [packed[p] if p in score else self.without_piece(p) for p in self.texts]

    def without_piece(self, character: str) -> bytes:
        if self.fallback is None:
            return self.unknown
        return b"".join(self.fallback[b] for b in character.encode())

    def merged(self, text: str) -> list[str]:
        """The merge result of a short text, by its definition."""
        rank, none, parts = self.rank, len(self.rank), list(text)
        ranks = [rank.get(a + b, none) for a, b in pairwise(parts)]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)  # the leftmost
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get(parts[i] + parts[i + 1], none)
            if i:
                ranks[i - 1] = rank.get(parts[i - 1] + parts[i], none)
        return parts


class Encoder:
    """Texts to packed ids (little-endian, 32 bits)."""

    def __init__(self, model: bytes, room: int = CACHE_CHUNKS, pair_room: int = CACHE_PAIRS):
        self.pieces = Pieces(model)
        self.texts, self.packed = self.pieces.texts, self.pieces.packed
        number = {text: i for i, text in enumerate(self.texts)}
        self.length = [len(t) for t in self.texts]
        #: the longest piece that starts like a piece and is shorter, or -1
        self.shorter = [next((number[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in number), -1)
                        for t in self.texts]
        self.automaton = ahocorasick.Automaton()
        for text, i in number.items():
            if len(text) > 1:  # single characters are looked up
                self.automaton.add_word(text, i)
        self.matches = lambda text: ()
        if len(self.automaton):
            self.automaton.make_automaton()
            self.matches = self.automaton.iter
        self.number = number
        self.room, self.pair_room = room, pair_room
        #: by left piece, what is known of its right neighbours; nothing is known of the start
        self.fits: list[dict[int, bool]] = [{} for _ in self.texts]
        self.always: dict[int, bool] = {}
        self.pairs = 0
        self.spaced: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        joints = self.pieces.joints
        #: whether a space after another character, and a line end, always end a chunk
        self.spaces_cut = not any(j[1] == SPACE != j[0] for j in joints)
        self.lines_cut = not any("\n" in j for j in joints)
        self.chunk = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of two neighbouring pieces again gives the two."""
        a, b = self.texts[left], self.texts[right]
        known = a[-1] + b[0] not in self.pieces.joints or self.pieces.merged(a + b) == [a, b]
        if self.pairs < self.pair_room:
            self.fits[left][right] = known
            self.pairs += 1
        return known

    def without_piece(self, character: str) -> int:
        """The number of a character that no piece holds; it is compatible with all others."""
        self.texts.append(character)
        self.packed.append(self.pieces.without_piece(character))
        self.length.append(1)
        self.shorter.append(-1)
        self.fits.append({})
        self.number[character] = len(self.texts) - 1
        return len(self.texts) - 1

    def run(self, text: str) -> bytes:
        """Ids of a text without the rule of the prefix."""
        number, length = self.number, self.length
        whole = number.get(text)
        if whole is not None:
            return self.packed[whole]
        longest = list(map(number.get, text))
        if None in longest:
            for i, piece in enumerate(longest):
                if piece is None:
                    known = number.get(text[i])
                    longest[i] = self.without_piece(text[i]) if known is None else known
        for last, piece in self.matches(text):
            longest[last + 1 - length[piece]] = piece  # ends ascend, so the longest comes last
        longest.append(-1)
        failed = bytearray((len(text) >> 3) + 1)
        taken: list[int] = []
        fits, compatible, shorter, stop = self.fits, self.compatible, self.shorter, len(text)
        at, before, piece = 0, -1, longest[0]
        row = self.always
        while at < stop:
            while piece >= 0:
                after = at + length[piece]
                if not failed[after >> 3] & 1 << (after & 7):
                    fit = row.get(piece)
                    if fit is None:
                        fit = before < 0 or compatible(before, piece)
                    if fit:
                        taken.append(piece)
                        before, at, piece = piece, after, longest[after]
                        row = fits[before]
                        break
                piece = shorter[piece]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                before = taken[-1] if taken else -1
                row = fits[before] if taken else self.always
                at -= length[piece]
                piece = shorter[piece]
        return b"".join([self.packed[i] for i in taken])

    def spaced_word(self, word: str) -> bytes:
        """Ids of a word after a space; a last character that never merges with the word is encoded alone."""
        ids = self.spaced.get(word)
        if ids is None:
            if len(word) > 1 and word[-2:] not in self.pieces.joints:
                base = word[:-1]
                ids = (self.spaced.get(base) or self.run(SPACE + base)) + self.run(word[-1])
            else:
                ids = self.run(SPACE + word)
            if len(self.spaced) < self.room:
                self.spaced[word] = ids
        return ids

    def head(self, chunk: str) -> bytes:
        """Ids of a chunk that no space precedes."""
        if not chunk:
            return b""
        ids = self.heads.get(chunk)
        if ids is None:
            ids = self.run(chunk)
            if len(self.heads) < self.room // 8:
                self.heads[chunk] = ids
        return ids

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        text = self.pieces.prefix + text.replace(" ", SPACE)
        if not self.spaces_cut:
            return self.run(text)
        parts: list[bytes] = []
        line_end = self.run("\n") if self.lines_cut else b""
        for line in text.split("\n") if self.lines_cut else [text]:
            head, *rest = line.split(SPACE)
            if "" in rest:
                parts.extend(map(self.run, self.chunk.findall(line)))
            else:
                parts.append(self.head(head))
                found = list(map(self.spaced.get, rest))
                if None in found:
                    for i, ids in enumerate(found):
                        if ids is None:
                            found[i] = self.spaced_word(rest[i])
                parts.extend(found)
            parts.append(line_end)
        parts.pop()
        return b"".join(parts)


def worker_encoder(model: bytes) -> Encoder:
    """One encoder per worker process, so that its caches serve all its tasks."""
    return worker_state(("sentencepiece encoder", model), lambda: Encoder(model))


def worker_processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return worker_state(("sentencepiece", model), lambda: sentencepiece.SentencePieceProcessor(model_proto=model))


def id_lists(packed: list[bytes]) -> pa.ListArray:
    """Packed ids as one list column."""
    ends = np.cumsum([0, *(len(x) >> 2 for x in packed)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), ID)))


def number_lists(column: pa.ListArray) -> Iterator[list[list[int]]]:
    """The lists of a column as Python numbers, ``DECODED_AT_ONCE`` rows at once; a null is an empty list."""
    ends, known = column.offsets.to_numpy().tolist(), column.is_valid().to_numpy(zero_copy_only=False).tolist()
    for start in range(0, len(column), DECODED_AT_ONCE):
        stop = min(start + DECODED_AT_ONCE, len(column))
        # by way of numpy, which makes them many times faster than Arrow
        numbers, first = column.values[ends[start] : ends[stop]].to_numpy(zero_copy_only=False).tolist(), ends[start]
        yield [numbers[ends[i] - first : ends[i + 1] - first] if known[i] else [] for i in range(start, stop)]


def encode(df: DataFrame, model: bytes, text: str = "text", out: str = "ids") -> DataFrame:
    """All columns plus ``out``, the ids as an array of integers; a column of that name is replaced."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # as large as the model file

    @F.arrow_udf("array<int>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(sent.value)
        for batch in batches:
            yield id_lists([encoder(t.as_py()) for t in batch])

    return df.withColumn(out, coded(F.col(f"`{text}`")))


def decode(df: DataFrame, model: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns plus ``out``, the text that the library's decoding makes of the ids; null ids give
    an empty text. Bytes that are not UTF-8 become replacement characters."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def plain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        processor = worker_processor(sent.value)
        for batch in batches:
            texts: list[str] = []
            for lists in number_lists(batch):
                texts.extend(processor.decode(lists, num_threads=1))
            yield pa.array(texts, pa.string())

    return df.withColumn(out, plain(F.col(f"`{ids}`")))


def op11_sentencepiece(spark, sf_dir):
    """Ids of every document and their way back, as digests."""
    text_batches(spark)
    model = read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, model).select("doc_id", "ids")
    return decode(coded, model).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
