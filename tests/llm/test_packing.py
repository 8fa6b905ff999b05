import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import TEXTS
from tokenizers import Tokenizer

from zonalis.llm import bpe, packing
from zonalis.session import drop_staged

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check(rows, texts, tokenizer, window=2048):
    """Each id once, sequences gapless and full or of a power of two."""
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append(r)
        ids = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes()) and r.doc_tokens == len(want[r.doc_id])
    assert set(of_doc) == set(want)
    for i, pieces in of_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0
            at += p.length
        assert at == len(want[i])
    for pieces in of_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window and at & (at - 1) == 0
    return of_sequence


def with_crc(df):
    return df.selectExpr("doc_id", "start", "length", "crc32(ids) AS ids_crc32", "doc_tokens", "sequence_id", "offset")


def test_query(spark, sf_small, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    check(packing.op9_packing(spark, sf_small).collect(), texts, tokenizer)
    drop_staged(spark)


def test_odd_texts_and_small_shards(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 300)
    texts = dict(enumerate([*TEXTS, *(f"{w} " * n for w in ("red", "blue") for n in (1, 7, 30, 90, 200))]))
    df = spark.createDataFrame([(i, t, 9) for i, t in texts.items()], "doc_id bigint, text string, start int")
    definition = bpe.from_json(PATH)
    check(with_crc(packing.pack(df.repartition(2), definition, window=64)).collect(), texts, tokenizer, 64)
    assert packing.pack(df.limit(0), definition).count() == 0
    drop_staged(spark)


def test_windows_hold_related_documents():
    draw = np.random.default_rng(0)
    topics = [draw.choice(5000, 200, replace=False) for _ in range(8)]
    labels = draw.integers(0, 8, 400)
    ids = [draw.choice(topics[k], draw.integers(40, 120)) for k in labels]
    packer = packing.Packer(np.full(5000, 2.0), 512)
    rest = packer.fill([(i, 0, len(x), x) for i, x in enumerate(ids)])
    groups = defaultdict(list)
    for key, _, _, x, sequence, _ in packer.done:
        groups[sequence] += [labels[key]] * len(x)
    same = np.mean([np.bincount(g).max() / len(g) for g in groups.values()])
    assert same > 0.7 and sum(len(p[3]) for p in rest) < 512


def test_bm25_ranks_as_the_formula_says():
    ids = [np.array(x) for x in ([1, 1, 2], [1, 3, 3, 3], [2, 2, 2, 4], [5])]
    idf = np.array([0.0, 1.0, 2.0, 0.5, 1.0, 3.0])
    shard = packing.Shard(ids, idf)
    length, mean = np.array([3, 4, 4, 1]), 3.0

    def score(doc):
        norm = packing.K1 * (1 - packing.B + packing.B * length[doc] / mean)
        return sum(idf[t] * (ids[doc] == t).sum() * (packing.K1 + 1) / ((ids[doc] == t).sum() + norm) for t in (1, 2))

    unused = np.array([False, True, True, True])
    assert shard.neighbours(0, unused).tolist() == sorted([1, 2], key=lambda d: -score(d))


def test_copies_of_other_tasks_meet(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 600)
    draw = np.random.default_rng(1)
    words = [f"w{i}x{i * 7}" for i in range(4000)]
    texts = [" ".join(draw.choice(words, 12)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id bigint, text string")
    split = df.repartitionByRange(2, "doc_id")  # the copies of a text lie in two tasks
    rows = packing.pack(split, bpe.from_json(PATH), window=256).collect()
    drop_staged(spark)
    held = defaultdict(set)
    for r in rows:
        held[r.doc_id].add(r.sequence_id)
    assert sum(bool(held[i] & held[i + 60]) for i in range(60)) > 45


def test_light_terms_of_a_seed_count():
    seed = np.arange(1, 61)
    idf = np.concatenate([[0.0], np.full(59, 5.0), [0.1], np.full(40, 1.0)])
    shard = packing.Shard([seed, np.array([60, 61, 62]), np.array([70, 71])], idf)
    unused = np.array([False, True, True])
    assert shard.neighbours(0, unused).tolist() == [1]
    shard.forget(np.array([True, False, True]))
    assert shard.neighbours(0, np.array([False, False, True])).tolist() == []


def test_scores_of_frequent_and_rare_terms_are_those_of_the_formula():
    """Frequent terms stand in rows of their own; forgotten pieces leave both."""
    draw = np.random.default_rng(2)
    ids = [np.concatenate([draw.integers(0, 5, 20), draw.integers(5, 200, 10)]) for _ in range(50)]
    idf = draw.random(200) + 0.1
    shard = packing.Shard(ids, idf)
    assert 0 < len(shard.rows) < 200
    norm = packing.K1  # all pieces are equally long

    def score(seed, doc):
        found = [(ids[doc] == t).sum() for t in np.unique(ids[seed])]
        return sum(idf[t] * c * (packing.K1 + 1) / (c + norm) for t, c in zip(np.unique(ids[seed]), found, strict=True))

    unused = np.ones(50, bool)
    for gone in ([], [3, 4], [10, 49]):
        unused[gone] = False
        shard.forget(unused)
        want = [score(7, doc) * unused[doc] for doc in range(50)]
        assert np.allclose(shard.scores(7), want)
        assert shard.neighbours(7, unused).tolist() == sorted(np.flatnonzero(unused), key=lambda d: -want[d])


def test_windows_take_the_best_that_fits_then_cut_the_best():
    """What sorting all neighbours gave."""
    draw = np.random.default_rng(3)
    ids = [draw.integers(0, 300, n) for n in draw.integers(5, 120, 200)]
    packer = packing.Packer(draw.random(300) + 0.1, 256)
    packer.fill([(i, 0, len(x), x) for i, x in enumerate(ids)])
    first = [d for d in packer.done if d[4] == 0]
    seed = first[0][0]
    assert len(ids[seed]) == max(map(len, ids))
    unused = np.ones(200, bool)
    unused[seed] = False
    ranked = packing.Shard(ids, packer.idf).neighbours(seed, unused).tolist()
    want, room = [], 256 - len(ids[seed])
    for i in ranked:
        if len(ids[i]) <= room:
            want.append((i, len(ids[i])))
            room -= len(ids[i])
    if room:
        want.append((next(i for i in ranked if i not in dict(want)), room))
    assert [(d[0], len(d[3])) for d in first[1:]] == want


def test_terms_of_routes_are_those_of_each_document():
    draw = np.random.default_rng(4)
    ids = [draw.integers(0, 60, n).astype("<u2") for n in (0, 1, 5, 40, 40, 0, 300)]
    weights, known = np.round(draw.random(60), 1), draw.integers(0, 9, 60)
    found = packing.heaviest(ids, weights, known, 5.0)
    for least, terms in zip((5.0, 2), found, strict=True):
        for x, term in zip(ids, terms.tolist(), strict=True):
            own, count = np.unique(x, return_counts=True)
            weight = weights[own] * count * (packing.K1 + 1) / (count + packing.K1)
            some = [(-w, t) for w, t in zip(weight.tolist(), own.tolist(), strict=True) if known[t] >= least]
            assert term == (min(some)[1] if some else -1)
    assert [len(x) for x in packing.heaviest([], weights, known, 5.0)] == [0, 0]


def test_document_frequencies_count_a_document_once(spark, tokenizer):
    texts = ["red red red", "red blue", "", None, 'a " b "']  # the quotation mark is the closing id, too
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(2)
    rows = packing.encode_documents(df, bpe.from_json(PATH), "doc_id", "text", 1).collect()
    got = sum(np.frombuffer(r.frequencies, "<u8") for r in rows if r.frequencies is not None)
    want = np.zeros(len(got), int)
    for t in texts:
        want[list({*tokenizer.encode(t or "", add_special_tokens=False).ids, 1})] += 1
    assert (got == want).all()
