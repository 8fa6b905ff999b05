import hashlib
import random

import numpy as np
from conftest import TEXTS

from zonalis.llm import suffix_dedup as sd
from zonalis.session import drop_staged


def plain(rows, length=50):
    """Kept bytes and removed spans by a dictionary of all strings."""
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        if i is not None:
            for p in range(len(raw) - length + 1):
                s = raw[p : p + length]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        if i is not None:
            for p in range(len(raw) - length + 1):
                if first[raw[p : p + length]] < i:
                    gone[p : p + length] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((i, kept, list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))))
    return sorted(out, key=str)


def found(df, length=50):
    rows = sd.remove_repeats(df, length=length).collect()
    return sorted([(r.doc_id, bytes(r.kept), [(s.start, s.stop) for s in r.removed]) for r in rows], key=str)


def noise(draw, n, letters="abcdefghij é"):
    return "".join(draw.choice(letters) for _ in range(n))


def test_planted_passages_equal_brute_force(spark):
    draw = random.Random(1)
    passages = [noise(draw, n) for n in (49, 50, 51, 70, 200, 400)]
    rows = []
    for i in range(80):
        parts = [noise(draw, draw.randrange(0, 80))]
        for _ in range(draw.randrange(4)):
            p = draw.choice(passages)
            a = draw.randrange(len(p) // 2)
            parts += [p[a:] if draw.random() < 0.5 else p, noise(draw, draw.randrange(0, 60))]
        rows.append((draw.randrange(10**6), "".join(parts)))
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[4][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert found(df) == plain(rows)
    drop_staged(spark)


def test_periodic_texts_and_other_lengths(spark):
    draw = random.Random(2)
    rows = [(i, noise(draw, 30, "ab") + "ab" * draw.randrange(60) + noise(draw, draw.randrange(80), "ab")) for i in range(40)]
    rows += [(100, "x" * 300), (101, "x" * 49), (102, "x" * 50), (103, "y" + "x" * 120 + "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for length in (26, 50, 73):
        assert found(df, length) == plain(rows, length)
        drop_staged(spark)


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50 + i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(i, t, i, i) for i, t in rows], "doc_id bigint, text string, bucket int, kept int")
    assert found(df) == plain(rows)
    assert all(r.bucket == r.doc_id for r in sd.remove_repeats(df).collect())
    assert sd.remove_repeats(df.limit(0)).count() == 0
    drop_staged(spark)


def test_long_rows_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sd, "PART", 300)
    draw = random.Random(3)
    shared = noise(draw, 2000)
    rows = [(1, noise(draw, 500) + shared + noise(draw, 700)), (2, noise(draw, 100) + shared[300:1500]), (3, shared)]
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain(rows)
    drop_staged(spark)


def test_classes_are_classes_of_equal_strings():
    draw = random.Random(4)
    pieces = [noise(draw, draw.randrange(50, 90), "ab").encode() for _ in range(60)]
    pieces += [p[3:] + b"abcab" for p in pieces[:20] if len(p) > 60] + pieces[:5]
    size = np.array([len(p) for p in pieces])
    owner, classes = sd.string_classes(np.frombuffer(b"".join(pieces), np.uint8), size, 50)
    strings = [p[i : i + 50] for p in pieces for i in range(len(p) - 49)]
    assert owner.tolist() == [k for k, p in enumerate(pieces) for _ in range(len(p) - 49)]
    seen = {}
    for s, c in zip(strings, classes, strict=True):
        assert seen.setdefault(s, c) == c
    assert len(set(seen.values())) == len(seen)


def test_query_equals_brute_force(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = {r.doc_id: r for r in sd.op1_suffix_dedup(spark, sf_small).collect()}
    drop_staged(spark)
    assert len(got) == len(rows)
    texts = dict(rows)
    for i, kept, spans in plain(rows):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len((texts[i] or "").encode()), sum(b - a for a, b in spans), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
