import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import TEXTS, words_of

from zonalis.llm import kneser_ney as kn
from zonalis.llm.common import Words
from zonalis.session import drop_staged


class Plain:
    """The same model by dictionaries."""

    def __init__(self, texts):
        self.pairs, self.words = Counter(), Counter()
        for t in texts:
            tokens = [*words_of(t), None]
            self.words.update(tokens)
            self.pairs.update(zip(["<s>", *tokens], tokens, strict=False))
        self.follow = Counter(w for _, w in self.pairs)
        seen = Counter(self.pairs.values())
        self.d2 = kn.discounts([seen[k] for k in (1, 2, 3, 4)])
        seen = Counter(self.follow.values())
        self.d1 = kn.discounts([seen[k] for k in (1, 2, 3, 4)])
        self.all = len(self.pairs)
        self.mass = sum(self.d1[min(c, 3) - 1] for c in self.follow.values()) / self.all
        self.context, self.left = Counter(), Counter()
        for (a, _), c in self.pairs.items():
            self.context[a] += c
            self.left[a] += self.d2[min(c, 3) - 1]

    def word(self, w):
        c = self.follow[w]
        return (c - self.d1[min(c, 3) - 1] if c else 0) / self.all + self.mass / (len(self.words) + 1)

    def chance(self, before, w):
        if not self.context[before]:
            return self.word(w)
        c = self.pairs[before, w]
        direct = (c - self.d2[min(c, 3) - 1]) if c else 0
        return direct / self.context[before] + self.left[before] / self.context[before] * self.word(w)

    def score(self, text):
        tokens = [*words_of(text), None]
        return sum(math.log10(self.chance(a, b)) for a, b in zip(["<s>", *tokens], tokens, strict=False))


def test_query_equals_dictionaries(spark, sf_small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    model = Plain([t for i, t in texts.items() if not out[i]])
    n, v = sum(model.words.values()), len(model.words)
    rows = kn.op5_language_model(spark, sf_small).collect()
    drop_staged(spark)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    better = 0
    for r in rows:
        tokens = [*words_of(texts[r.doc_id]), None]
        assert r.held_out == out[r.doc_id] and r.n_tokens == len(tokens) and r.train_tokens == n
        assert r.n_known == sum(model.words[t] > 0 for t in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((model.words[t] + 1) / (n + v + 1)) for t in tokens), rel=1e-9)
        assert r.score == pytest.approx(model.score(texts[r.doc_id]), rel=1e-9)
        better += r.held_out and r.score > r.base_score
    assert better > 0.9 * sum(out.values())


def test_probabilities_sum_to_one():
    model = Plain(["a b a c", "a b", "c c c a b", "d a b a b a c d d"])
    for before in ["a", "d", None, "<s>", "unseen"]:
        whole = sum(model.chance(before, w) for w in [*model.words, "unseen"])
        assert whole == pytest.approx(1.0) or before in (None, "unseen") and whole <= 1 + 1e-9


def test_odd_texts_and_large_counts(spark):
    rows = [(i, t) for i, t in enumerate([*TEXTS, "x y " * 400])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    store = kn.train(df, side=3)
    model = Plain([t for _, t in rows])
    got = {r.doc_id: r.score for r in kn.score(df, store, ["doc_id"]).collect()}
    drop_staged(spark)
    assert got == {i: pytest.approx(model.score(t), rel=1e-9) for i, t in rows}


def test_empty_training_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    store = kn.train(df.limit(0))
    [row] = kn.score(df, store, ["doc_id"]).collect()
    assert (row.n_tokens, row.n_known, row.score) == (3, 0, 0.0)
    assert kn.score(df.limit(0), kn.train(df), ["doc_id"]).count() == 0
    drop_staged(spark)


def test_word_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"alpha beta alpha  Alpha gammaalpha", np.uint8)
    hashes = Words(data, np.array([0, 29, len(data)])).hashes()
    assert hashes[0] == hashes[2] == hashes[3] == hashes[5] and len(set(hashes.tolist())) == 3
