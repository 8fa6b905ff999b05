import corpus_pipeline as cp
import numpy as np
import public_tokenizers
from test_ngram_join import plain as plain_groups
from test_packing import check
from test_suffix_dedup import plain as plain_cut
from tokenizers import Tokenizer

from zonalis.llm import language, toxicity
from zonalis.session import drop_staged


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_equal_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    known = cp.known_language(spark, docs, sf_small)
    judged = {r.doc_id: r.kept for r in language.op8_language(spark, sf_small).collect()}
    assert known.columns == docs.columns
    assert rows_of(known) == sorted((tuple(r) for r in docs.collect() if judged[r.doc_id]), key=str)

    clean = cp.not_toxic(spark, known, sf_small)
    model = toxicity.fit(known, spark.read.parquet(f"{sf_small}/labels.parquet"))
    left = []
    for r in known.collect():
        raw = np.frombuffer(r.text.encode(), np.uint8)
        if model.at_least(model.logits(raw, np.array([0, len(raw)])))[0, 0] < 0.3:
            left.append(tuple(r))
    assert rows_of(clean) == sorted(left, key=str)

    single = cp.one_of_each_group(spark, clean, sf_small)
    groups = plain_groups({r[0]: r[1] for r in left})
    want = [r for r in left if groups[r[0]][1] == r[0]]
    assert rows_of(single) == sorted(want, key=str)

    cut = cp.without_repeats(spark, single, sf_small)
    texts = {i: kept.decode(errors="ignore") for i, kept, _ in plain_cut([(r[0], r[1]) for r in want])}
    assert cut.columns == docs.columns
    got = {r.doc_id: r for r in cut.collect()}
    assert {i: r.text for i, r in got.items()} == texts
    assert all(r.n_chars == len(r.text) for r in got.values())

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    check(cp.run(spark, sf_small).collect(), texts, tokenizer)
    drop_staged(spark)


def test_odd_documents_and_empty_table(spark, sf_small):
    long = "the thing and the other thing of this and that is here for all to see in the house by the river " * 3
    shape = "doc_id bigint, text string, lang string, source string, n_chars bigint, language string, kept int"
    rows = [(1, long, "en", "a", 1, "x", 1), (2, long, None, None, None, "y", 2), (None, long, "en", "a", 3, "z", 3),
            (3, None, "en", "a", 0, None, None), (4, "", None, "b", 0, "w", 4), (1, long, "en", "a", 1, "x", 1)]
    rows += [(100 + i, f"some text {i} of its own and the way in it is that for all", "en", "a", 5, "q", 5) for i in range(8)]
    docs = spark.createDataFrame(rows, shape)
    for name, step in cp.STAGES[:-1]:
        kept = step(spark, docs, sf_small)
        assert kept.columns == docs.columns, name
        assert step(spark, docs.limit(0), sf_small).count() == 0
    ids = [r.doc_id for r in cp.known_language(spark, docs, sf_small).collect()]
    assert 3 not in ids and 4 not in ids and ids.count(1) == 2 and None in ids
    ids = [r.doc_id for r in cp.one_of_each_group(spark, docs, sf_small).collect()]
    assert 2 not in ids and ids.count(1) == 2 and None in ids and 3 in ids and 4 in ids
    drop_staged(spark)


def test_other_columns_keep_values_and_types(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    own = {"kept": "doc_id % 2 = 0", "removed": "doc_id + 1", "a.b": "source", "language": "lang", "c1": "n_chars", "__toxicity": "doc_id"}
    wide = docs.selectExpr("*", *[f"{e} AS `{n}`" for n, e in own.items()])
    for name, step in cp.STAGES[:-1]:
        kept = step(spark, wide, sf_small)
        assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in wide.schema], name
        rows = kept.collect()
        assert rows and {r.doc_id for r in rows} == {r.doc_id for r in step(spark, docs, sf_small).collect()}
        for r in rows:
            assert (r["kept"], r["removed"], r["a.b"], r["language"], r["__toxicity"]) == (
                r.doc_id % 2 == 0, r.doc_id + 1, r.source, r.lang, r.doc_id), name
    drop_staged(spark)


def test_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["language", "toxicity", "ngram_join", "suffix_dedup", "packing"]
