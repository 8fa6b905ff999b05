import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st

from zonalis.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def definition():
    return bpe.from_ranks(RANKS)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS),
                             special_tokens={})


@pytest.fixture(scope="module")
def encoder(definition):
    return bpe.Encoder(definition, room=50)


ODD = ["a  b", "\tx y", " a", "a ", "a\n\nb", "a \nb", "don't I'll 's", "a b c", "123 4a5", "<|endoftext|> a",
       "\x1ca b", "x\u0085y z", "a　 b", "İ ſ 's"]


@pytest.mark.parametrize("text", [t for t in TEXTS if t] + ODD)
def test_ids_equal_the_reference(encoder, reference, definition, text):
    packed = encoder(text)
    assert np.frombuffer(packed, "<u4").tolist() == reference.encode_ordinary(text)
    assert bpe.Decoder(definition)(packed) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sabA1."))))
def test_any_text(encoder, reference, text):
    assert np.frombuffer(encoder(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_split_characters_belong_to_each_id(definition, encoder):
    text = "a漢 \U0001f600b"
    packed = encoder(text)
    first, last = bpe.Decoder(definition).spans(packed, text.encode())
    assert first[0] == 0 and last[-1] == len(text) and (last > first).all() and (first[1:] <= last[:-1]).all()
    pieces = [bpe.Decoder(definition)(x.tobytes()) for x in np.frombuffer(packed, "<u4")]
    for piece, a, b in zip(pieces, first, last, strict=True):
        assert piece in text[a:b].encode()


def test_columns_in_spark(spark, definition):
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, ids string")
    got = bpe.decode(bpe.encode(df, definition, spans="spans"), definition).orderBy("doc_id").collect()
    for row, text in zip(got, TEXTS, strict=True):
        assert bytes(row.decoded) == (text or "").encode() and len(row.spans) == len(row.ids) // 4
    assert bpe.encode(df.limit(0), definition).count() == 0


def test_query(spark, sf_small, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = bpe.op6_bpe(spark, sf_small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = np.array(reference.encode_ordinary(texts[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.fixture(scope="module")
def by_ranks():
    return bpe.RankEncoder(bpe.from_json(public_tokenizers.path("byte_bpe_50k.json")))


@pytest.fixture(scope="module")
def whole():
    return bpe.Encoder(bpe.from_json(public_tokenizers.path("byte_bpe_50k.json"))).whole


@pytest.mark.parametrize("text", [t for t in TEXTS if t] + ODD + [" " * 1_200_000])
def test_rank_encoder_gives_the_ids_of_the_definition(by_ranks, whole, text):
    assert by_ranks(text) == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sabA1.")), min_size=1))
def test_rank_encoder_on_any_text(by_ranks, whole, text):
    assert by_ranks(text) == whole(text)


@pytest.fixture(scope="module")
def by_chunks():
    return bpe.RankEncoder(bpe.from_json(public_tokenizers.path("byte_bpe_50k.json")), "<u2", room=40)


def check_column(encoder, whole, texts):
    ids, bounds = encoder.column(pa.array(texts, pa.string()))
    assert len(bounds) == len(texts) + 1 and bounds[0] == 0 and bounds[-1] == len(ids)
    for text, start, stop in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[start:stop].astype("<u4").tobytes() == (whole(text) if text else b"")


#: Places where a chunk must not start, or where chunks out of their order would grow together.
SEAMS = ["a\u00a0 b", "a \u00a0b", "\u00a0\u00a0b", "x\u2003", "\n", " ", "  a", "a  ", "it's 're ' s", "a,b,, c", "é, é b", "\x85a \x1c b",
         "\u3000漢字 漢字\u3000 b", "<|endoftext|> a", "\n\n a\n", "a\u0301 b\u0301,", "\u180e \u180ea", "1st 2nd,3", ",", "'t", None, ""]


@pytest.mark.parametrize("limit", [1, 9, 1 << 22])
def test_a_column_of_distinct_chunks_gives_the_ids_of_whole_texts(by_chunks, whole, monkeypatch, limit):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", limit)
    texts = [*TEXTS, *ODD, *SEAMS, *reversed(SEAMS), " " * 1_200_000 + "a"]
    for given_texts in (texts, texts[::-1], [], [None], [""]):
        check_column(by_chunks, whole, given_texts)
    sliced, bounds = by_chunks.column(pa.array(["a b", "c d", "e"]).slice(1, 1))
    assert sliced.astype("<u4").tobytes() == whole("c d") and len(bounds) == 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sabA1.,\u00a0\u2003é")))))
def test_a_column_of_any_texts(by_chunks, whole, texts):
    check_column(by_chunks, whole, texts)


def test_other_definitions_encode_columns_too(definition):
    encoder = bpe.Encoder(definition)
    check_column(encoder, encoder.whole, ["a b", None, "", "b  c"])


def test_repeated_words_of_a_column_are_encoded_once(monkeypatch):
    """Each text went through the library in whole: 491 CPU seconds a GB of packing, most of them here."""
    encoder = bpe.RankEncoder(bpe.from_json(public_tokenizers.path("byte_bpe_50k.json")))
    asked = []

    class Counting:
        def encode_to_numpy(self, text, coding=encoder.coding):
            asked.append(len(text))
            return coding.encode_to_numpy(text)

    encoder.coding = Counting()
    texts = [" ".join(f"word{(i * j) % 50}x" for j in range(1, 200)) for i in range(1, 60)]
    for _ in range(2):
        encoder.column(pa.array(texts))
    assert sum(asked) < sum(map(len, texts)) / 20


def test_a_worker_keeps_no_more_chunks_than_it_has_room_for(by_chunks, whole):
    """All of the first batch were kept, and each later batch paid for them."""
    for k in range(3):
        check_column(by_chunks, whole, [" ".join(f"n{k}x{i}" for i in range(200)), "a b"])
        assert len(by_chunks.known[0]) <= 40


def test_other_definitions_have_no_rank_encoder(definition):
    with pytest.raises(ValueError):
        bpe.RankEncoder(definition)  # its pattern is a step of its own
    assert isinstance(bpe.quick_encoder(definition), bpe.Encoder)


def test_a_worker_holds_one_encoder_and_short_batches(spark, tmp_path, definition):
    """Encoders of earlier tasks and batches of 10,000 whole texts took more memory than an executor has."""
    assert bpe.worker_encoder(definition) is bpe.worker_encoder(definition)
    assert bpe.worker_decoder(definition) is bpe.worker_decoder(definition)
    texts = list(enumerate([*(t for t in TEXTS if t), "a b", None, ""] * 3))
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        rows = {r.doc_id: r for r in bpe.op6_bpe(spark, str(tmp_path)).collect()}
        assert int(spark.conf.get(key)) <= 2000
    finally:
        spark.conf.set(key, before)
    for i, text in texts:
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        assert (rows[i].n_tokens == 0) == (not text)
