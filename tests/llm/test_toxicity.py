import numpy as np
import pytest
from conftest import TEXTS

from zonalis.llm import toxicity as tox
from zonalis.session import drop_staged


def test_ordinal_fit_recovers_order():
    draw = np.random.default_rng(0)
    x = draw.random((4000, 3)) < 0.4
    logit = x @ np.array([2.0, 1.0, -1.0]) + draw.logistic(size=4000)
    grades = (logit > 0.5).astype(int) + (logit > 2.5)
    row, col = np.nonzero(x)
    weights, thresholds = tox.fit_ordinal(row, col, grades, 3, 2)
    assert weights == pytest.approx([2.0, 1.0, -1.0], abs=0.25)
    assert thresholds == pytest.approx([0.5, 2.5], abs=0.2)


def held(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = tox.fit(docs, labels.where("doc_id % 2 = 0"))
    return tox.score(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), model), model


def test_held_out_accuracy(spark):
    scored, model = held(spark)
    rows = scored.withColumn("bad", tox.toxic()).select("toxic", "bad", "toxicity.expected", "toxicity.at_least").toPandas()
    drop_staged(spark)
    # labels of this table are noisy: about a fifth of the toxic ones carry nothing toxic
    assert rows.bad[rows.toxic == 1].mean() > 0.72 and rows.bad[rows.toxic == 0].mean() < 0.02
    assert (np.diff(model.thresholds) > 0).all()
    chance = np.stack(rows.at_least)
    assert np.allclose(chance.sum(axis=1), rows.expected) and (np.diff(chance, axis=1) <= 0).all()


def test_odd_rows_and_no_labels(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, words string")
    labels = spark.createDataFrame([(0, None), (None, 1), (1, 0), (1, 0)], "doc_id bigint, toxic int")
    model = tox.fit(df, labels)
    rows = tox.score(df, model).orderBy("doc_id").collect()
    assert [r.words for r in rows] == ["x"] * len(TEXTS) and not any(r.toxicity.at_least[0] > 0.5 for r in rows)
    assert tox.score(df.limit(0), model).count() == 0
    assert tox.fit(df, labels.limit(0)).thresholds[0] > 0
    drop_staged(spark)


def test_given_grades_are_kept():
    assert tox.severity(np.array([0, 1, 2, 3]), np.zeros(4)).tolist() == [0, 1, 2, 3]
    assert tox.severity(np.array([0, 1, 1, 1]), np.array([0, 1, 2, 9])).tolist() == [0, 1, 1, 2]


def test_repeated_ids_do_not_unbound_the_sample(spark):
    docs = spark.createDataFrame([(min(i, 4), f"text number {i}") for i in range(300)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id bigint, toxic int")
    got = [tox.labelled_sample(d, labels, "doc_id", "text", "toxic", 5).collect() for d in (docs, docs.orderBy("text"))]
    drop_staged(spark)
    assert len(got[0]) == 5 and set(got[0]) == set(got[1])
