import numpy as np
from test_ngram_join import reach

from zonalis.llm import vector_dedup as vd
from zonalis.session import drop_staged

SHAPE = "vec_id bigint, embedding array<float>, label int"


def plain(rows, threshold=0.98):
    good = {}
    for i, v, label in rows:
        ok = v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)
        if ok and label is not None:
            x = np.array(v, np.float32).astype(float)
            good[i] = (x / np.linalg.norm(x), label)
    pairs = [(a, b) for a in good for b in good
             if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0]) and good[a][0] @ good[b][0] >= threshold]
    root = reach([r[0] for r in rows], pairs)
    links = {r[0]: 0 for r in rows}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    return {i: (links[i], root[i], root[i] == i) for i in links}


def found(df):
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vd.near_duplicates(df).collect()}
    return out


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0),
            (7, [1.0, None], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [1.0, 0.0], None), (11, [1.0, 0.01], 0),
            (12, [1.0, 0.0, 0.0], 0), (13, [1.0, 0.0], 0), (14, [-1.0, 0.0], 0), (15, [-0.0, 1e-30], 0), (16, [0.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, 5) for r in rows], SHAPE + ", size int")
    assert found(df) == plain(rows)
    assert vd.near_duplicates(df.limit(0)).count() == 0
    drop_staged(spark)


def near_families(draw, n, dim=32):
    rows = []
    while len(rows) < n:
        base = draw.normal(size=dim)
        for _ in range(draw.integers(1, 6)):
            v = base + draw.normal(size=dim) * 0.14 * draw.random()
            rows.append((len(rows), [float(c) for c in v.astype(np.float32)], int(draw.integers(3) == 0)))
    return rows


def test_families_equal_brute_force_also_in_blocks(spark, monkeypatch):
    rows = near_families(np.random.default_rng(1), 900)
    df = spark.createDataFrame(rows, SHAPE).repartition(4)
    want = plain(rows)
    monkeypatch.setattr(vd, "SHARD", 100)
    got = found(df)
    assert sum(v[0] for v in got.values()) >= 0.98 * sum(v[0] for v in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    monkeypatch.setattr(vd, "LIMIT", 40)
    got = found(df)
    drop_staged(spark)
    assert sum(v[0] for v in got.values()) >= 0.98 * sum(v[0] for v in want.values())


def test_query_recall(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vd.op7_vectors(spark, sf_small).collect()}
    drop_staged(spark)
    want = plain(rows)
    assert set(got) == set(want) and sum(v[0] for v in got.values()) >= 0.98 * sum(v[0] for v in want.values())


def test_low_recall_is_noticed(spark):
    rows = near_families(np.random.default_rng(2), 300)
    nodes = vd.valid_vectors(spark.createDataFrame(rows, SHAPE), "vec_id", "embedding", "label").withColumnRenamed("id", "rep")
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert vd.audited_recall(nodes, none, 0.5) < 0.1


def test_pruning_keeps_spread_neighbours():
    x = vd.unit([np.array(v, "<f8").tobytes() for v in ([1, 0], [1, 0.1], [1, 0.11], [1, -0.3])])
    assert vd.robust_prune(np.array([1, 2, 3]), x, 0) == [1, 3]
