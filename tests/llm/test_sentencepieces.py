import hashlib
import time
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from zonalis.llm import sentencepieces as sp

MODEL = sp.read_model(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def encoder():
    return sp.Encoder(MODEL, room=50, pair_room=500)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def ids(packed):
    return np.frombuffer(packed, sp.ID).tolist()


ODD = ["a  b", " a", "a ", "  ", "\n", "a\n\nb", "a \n b", "▁a▁▁b", "<0x41><s></s><unk>", "\x00 \x01", "a" * 5000,
       "=" * 3001, " " * 999, "漢字の한국𝔘😀", "?!" * 4000, "don't.I'll,x", "́ ́e"]


@pytest.mark.parametrize("text", TEXTS + ODD)
def test_ids_equal_the_library(encoder, library, text):
    assert ids(encoder(text)) == library.encode(text or "")


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.characters(exclude_categories=["Cs"]),
                          st.sampled_from([p.replace("▁", " ") for p in sp.Pieces(MODEL).texts[::7]]))).map("".join))
def test_any_text(encoder, library, text):
    assert ids(encoder(text)) == library.encode(text)


def tiny(pieces, fallback=True, **rules):
    """A model of the given pieces, best first."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(MODEL)
    kept = [p for p in proto.pieces if p.type != 1 and (fallback or p.type != 6)]
    del proto.pieces[:]
    proto.pieces.extend(kept)
    for i, piece in enumerate(pieces):
        proto.pieces.add(piece=piece, score=-float(i), type=1)
    proto.trainer_spec.byte_fallback = fallback
    for name, value in rules.items():
        setattr(proto.normalizer_spec, name, value)
    return proto.SerializeToString()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc▁\n", min_size=2, max_size=4), max_size=12, unique=True), st.text("abcx \n", max_size=40),
       st.booleans(), st.booleans())
def test_small_models_with_unreachable_pieces_and_ties(pieces, text, fallback, prefix):
    model = tiny(pieces + list("abc▁"), fallback, add_dummy_prefix=prefix)
    want = sentencepiece.SentencePieceProcessor(model_proto=model).encode(text)
    if not fallback:  # the library joins neighbouring unknown characters into one id
        want = [x for x, before in zip(want, [None, *want], strict=False) if x or before != 0]
    got = ids(sp.Encoder(model)(text))
    if not fallback:
        got = [x for x, before in zip(got, [None, *got], strict=False) if x or before != 0]
    assert got == want


def test_neighbours_are_compatible_and_walk_steps_back(library):
    encoder = sp.Encoder(MODEL)
    text = "▁" + "internationalization".replace(" ", "▁")
    found = [library.id_to_piece(i) for i in library.encode("internationalization")]
    for a, b in pairwise(found):
        assert encoder.pieces.merged(a + b) == [a, b]
    assert "".join(found) == text
    # longest first would take "ab", but "bc" merges first
    assert [t for t in sp.Pieces(tiny(["bc", "ab", "a", "b", "c", "▁"])).merged("abc")] == ["a", "bc"]
    assert ids(sp.Encoder(tiny(["bc", "ab", "a", "b", "c", "▁"]))("abc")) == [262 + 2, 259 + 2, 259]


@pytest.mark.parametrize("rules", [{"precompiled_charsmap": b"x"}, {"remove_extra_whitespaces": True}])
def test_other_models_are_refused(rules):
    with pytest.raises(ValueError):
        sp.Encoder(tiny(["ab", "a", "b"], **rules))


def test_columns_in_spark(spark, library):
    df = spark.createDataFrame([(i, t, "mine", 1.5) for i, t in enumerate(TEXTS + TEXTS)],
                               "doc_id bigint, text string, ids string, `a.b` double")
    rows = sp.decode(sp.encode(df, MODEL), MODEL).orderBy("doc_id").collect()
    for row, text in zip(rows, TEXTS + TEXTS, strict=True):
        assert row.ids == library.encode(text or "") and row.decoded == library.decode(row.ids) and row["a.b"] == 1.5
        assert row.decoded == (text or "")
    assert sp.decode(sp.encode(df.limit(0), MODEL), MODEL).count() == 0
    assert [r.decoded for r in sp.decode(spark.sql("SELECT cast(null AS array<int>) AS ids"), MODEL).collect()] == [""]


def test_query(spark, sf_small, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = sp.op11_sentencepiece(spark, sf_small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want).encode()).hexdigest()


def test_number_lists_are_the_rows_at_a_fraction_of_the_time():
    lists = [[1, 2], None, [], list(range(300)), *([[7] * 200] * 500)]
    column = pa.array(lists, pa.list_(pa.int32()))
    for some in (column, column[1:], column[2:140], column[:0], column[3:4]):
        assert [x for part in sp.number_lists(some) for x in part] == [x or [] for x in some.to_pylist()]
    # a null may stand over numbers
    over = pa.ListArray.from_arrays(pa.array([0, 2, 3]), pa.array([1, 2, 3], pa.int32()), mask=pa.array([True, False]))
    assert [*sp.number_lists(over)] == [[[], [3]]]

    def least(work):
        times = []
        for _ in range(3):
            begun = time.process_time()
            work()
            times.append(time.process_time() - begun)
        return min(times)

    assert least(lambda: [*sp.number_lists(column)]) < 0.5 * least(column.to_pylist)
