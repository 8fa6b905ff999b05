import re
from collections import Counter

import numpy as np
from conftest import TEXTS, WORD

from zonalis.llm import quality
from zonalis.session import drop_staged


def plain(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w, c in Counter(windows).items() if c > 1}
    inside = {i + j for i, w in enumerate(windows) if w in twice for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(inside))


def test_counts_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    got = {r.doc_id: tuple(r[c] for c in quality.COUNTS) for r in quality.statistics(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}
    assert quality.statistics(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = quality.op10_quality(spark, sf_small).collect()
    drop_staged(spark)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert tuple(r[c] for c in quality.COUNTS) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_list_finds_a_planted_conjunction():
    draw = np.random.default_rng(3)
    values = {"a": draw.random(3000), "b": draw.random(3000), "c": draw.random(3000)}
    bad = (values["a"] > 0.8) & (values["b"] < 0.3)
    rules = quality.learn(values, bad, np.arange(3000))
    hit = np.any([quality.covers(r, values) for r in rules], axis=0)
    assert (hit & bad).sum() > 0.95 * bad.sum() and (hit & ~bad).sum() <= 0.02 * bad.sum()


def test_no_rules_from_one_class_or_noise():
    draw = np.random.default_rng(4)
    values = {"a": draw.random(600)}
    assert quality.learn(values, np.zeros(600, bool), np.arange(600)) == []
    assert quality.learn(values, draw.random(600) < 0.05, np.arange(600)) == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    counts = quality.statistics(spark.read.parquet(f"{sf}/documents.parquet")).cache()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen, rest = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    judged = quality.judge(counts, quality.fit(counts, seen)).join(rest, "doc_id").toPandas()
    counts.unpersist()
    bad = judged.quality == 0
    assert (~judged.kept[bad]).mean() > 0.8 and judged.kept[~bad].mean() > 0.85
