import numpy as np
from conftest import TEXTS

from zonalis.llm import language as lid
from zonalis.session import drop_staged


def test_documents_with_hidden_and_wrong_declarations(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) > 40")
    hidden = docs.selectExpr("doc_id", "text", "lang", "source",
                             "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 50 = 1 THEN 'de' ELSE lang END AS said")
    rows = lid.identify(hidden, declaration="said", host="source").select("doc_id", "lang", "language").toPandas()
    drop_staged(spark)
    right = rows.lang == rows.language
    assert right[rows.doc_id % 5 == 0].mean() > 0.97 and right[rows.doc_id % 50 == 1].mean() > 0.95


def test_pages(spark, sf_small):
    rows = lid.pages_language(spark, sf_small).toPandas()
    drop_staged(spark)
    assert len(rows) == spark.read.parquet(f"{sf_small}/pages.parquet").count()
    assert (rows.markup == rows.language).mean() > 0.9 and rows.host.notna().all()


def test_odd_rows(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, "the cat and the dog of the house", "EN-us", "h", "kept") for i in range(30)]
    rows += [(200 + i, "der hund und die katze von dem haus", "de", "h", "kept") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, said string, host string, language string")
    got = {r.doc_id: r for r in lid.identify(df, declaration="said", host="host").collect()}
    drop_staged(spark)
    assert len(got) == len(rows)
    assert got[0].language == got[1].language == "und" and got[100].language == "en" and got[200].language == "de"
    assert all(abs(sum(r.posteriors) - 1) < 1e-9 for r in got.values())
    assert lid.identify(df.limit(0), declaration="said").count() == 0
    assert {r.language for r in lid.identify(df).collect()} == {"und"}
    drop_staged(spark)


def test_host_prior_decides_where_text_does_not(spark):
    rows = [(i, "der hund und die katze", "de", "german.example") for i in range(60)]
    rows += [(100 + i, "the cat and the dog", "en", "english.example") for i in range(60)]
    rows += [(300, "okay", None, "german.example"), (301, "okay", None, "english.example")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, said string, host string")
    got = {r.doc_id: r for r in lid.identify(df, declaration="said", host="host", languages=["de", "en"]).collect()}
    drop_staged(spark)
    assert got[300].posteriors[0] > got[301].posteriors[0] and got[300].posteriors[1] < got[301].posteriors[1]


def test_trigram_sums_stay_within_rows():
    data = np.frombuffer(b"abcdeXYZ", np.uint8)
    assert lid._telling(data, np.array([0, 5, 8])).tolist() == [True, True, True, False, False, True]
    digits = np.frombuffer(b"ab1cd ef", np.uint8)
    assert lid._telling(digits, np.array([0, 8])).tolist() == [False, False, False, True, True, True]
    assert len(lid.trigrams(data)) == 6


def test_every_declared_language_is_a_candidate(spark):
    rng = np.random.default_rng(5)
    names = [f"{a}{b}" for a in "abcdefgh" for b in "klmnopqrs"]  # 72, two of them with a single row
    rows = []
    for i, name in enumerate(names):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(30)]
        for j in range(1 if i < 2 else 6):
            rows.append((len(rows), " ".join(rng.choice(words, 40)), name, "h", None if j == 5 else name))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, host string, said string")
    got = lid.identify(df, declaration="said", host="host").collect()
    kept = {r.doc_id for r in lid.keep_known(df, declaration="said", host="host").collect()}
    drop_staged(spark)
    assert [r.doc_id for r in got if r.language != r.lang] == [] and len(got) == len(rows) == len(kept)
    assert {len(r.posteriors) for r in got} == {73}


def test_a_declared_und_is_no_language(spark):
    rows = [(1, "the cat and the dog of the house", "und")]
    rows += [(2 + i, "the cat and the dog of the house", "en") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, said string")
    got = lid.identify(df, declaration="said").collect()
    drop_staged(spark)
    assert {r.language for r in got} == {"en"} and {len(r.posteriors) for r in got} == {2}
