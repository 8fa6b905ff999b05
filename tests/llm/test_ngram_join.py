import random
from collections import defaultdict

import numpy as np
from conftest import TEXTS, words_of

from zonalis.llm import ngram_join
from zonalis.llm.components import components
from zonalis.session import drop_staged


def shingles(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def reach(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def plain(texts):
    """Sizes and components by comparing all texts that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = reach(sets, linked)
    return {i: (len(sets[i]), root[i]) for i in sets}


def found(df):
    return {r[0]: (r[1], r[2]) for r in ngram_join.ngram_components(df).collect()}


def test_small_texts(spark):
    rows = dict(enumerate(TEXTS)) | {50: "A B C D E F G H", 51: "a b c d e f g h", 52: "one", 53: " One "}
    df = spark.createDataFrame([(i, t, "x") for i, t in rows.items()], "doc_id bigint, text string, component string")
    assert found(df) == plain(rows)
    assert ngram_join.ngram_components(df.limit(0)).count() == 0
    drop_staged(spark)


def edited(words, count, draw):
    words = list(words)
    for _ in range(count):
        words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
    return " ".join(words)


def family_texts(draw):
    """Families of edited copies, with links that go only through other members, and a passage in many texts."""
    texts, passage = {}, " ".join(f"p{i}" for i in range(40))
    for family in range(12):
        words = [f"w{draw.randrange(300)}" for _ in range(draw.choice([12, 60, 150]))]
        for _ in range(draw.choice([2, 5, 40])):
            texts[len(texts)] = edited(words, draw.randrange(0, 5), draw)
    for _ in range(60):
        texts[len(texts)] = " ".join([*(f"u{draw.randrange(10**6)}" for _ in range(20)), passage])
    return texts


def test_families_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)  # in blocks, too
    monkeypatch.setattr(ngram_join, "HOT", 10)
    texts = family_texts(random.Random(5))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    assert found(df) == plain(texts)
    drop_staged(spark)


def test_repeated_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long), (1, long), (1, "other words that stand here alone"), (None, long), (2, long + " x")]
    got = sorted(map(tuple, ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str)
    assert got == sorted([(1, 26, 1), (1, 26, 1), (1, 2, 1), (None, 26, None), (2, 27, 1)], key=str)
    drop_staged(spark)


def test_query_equals_brute_force(spark, sf_small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = {r[0]: (r[1], r[2]) for r in ngram_join.op3_ngram_join(spark, sf_small).collect()}
    drop_staged(spark)
    assert got == plain(texts)


def test_tree_finds_all_links():
    draw = np.random.default_rng(2)
    base = [np.sort(draw.choice(400, 60, replace=False)) for _ in range(4)]
    sets = []
    for _ in range(120):
        b = base[draw.integers(4)]
        sets.append(np.unique(np.concatenate([draw.choice(b, 52, replace=False), draw.choice(400, draw.integers(0, 9))])))
    tree = ngram_join.PrefixTree(sets)
    for s in sets:
        mask = np.zeros(400, bool)
        mask[s] = True
        shared = tree.overlaps(mask, len(s), 75)
        for t, o in zip(sets, shared, strict=True):
            true = len(np.intersect1d(s, t))
            linked = 100 * true >= 75 * (len(s) + len(t) - true)
            assert o == true if linked else o in (-1, true)


def test_bitmaps_never_exceed_the_difference():
    draw = np.random.default_rng(1)
    for _ in range(50):
        pool = draw.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = np.unique(draw.choice(pool, draw.integers(1, 200))), np.unique(draw.choice(pool, draw.integers(1, 200)))
        x, y = (np.frombuffer(ngram_join.bitmap(s), np.uint8) for s in (a, b))
        size = 8 * min(len(x), len(y))
        apart = np.bitwise_count(ngram_join.folded(x, size) ^ ngram_join.folded(y, size)).sum()
        assert apart <= len(np.setxor1d(a, b))


def test_components_of_paths_stars_and_repeats(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 300)]
    odd = [(7, 7), (None, 3), (2, None), (5, 200), (200, 5)]
    df = spark.createDataFrame(path + star + odd, "a bigint, b bigint").repartition(7)
    got = {r.id: r.component for r in components(df).collect()}
    drop_staged(spark)
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(200, 300)]}}
