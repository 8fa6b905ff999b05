import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from zonalis.llm import alignment, bpe, sentencepieces

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def groups_of(left, right):
    """Components of overlapping tokens and the overlaps, by comparing all with all; lengths given."""
    spans = []
    for side in (left, right):
        ends = np.cumsum(side).tolist()
        spans.append([(e - n, e) for e, n in zip(ends, side, strict=True)])
    links = [(i, j) for i, (a, b) in enumerate(spans[0]) for j, (c, d) in enumerate(spans[1]) if a < d and c < b]
    parent = {("l", i): ("l", i) for i in range(len(left))} | {("r", j): ("r", j) for j in range(len(right))}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in links:
        parent[root(("r", j))] = root(("l", i))
    found = {}
    for node in parent:
        found.setdefault(root(node), []).append(node)
    shown = [([i for s, i in g if s == "l"], [j for s, j in g if s == "r"]) for g in found.values()]
    return sorted(shown), links


CUTS = st.lists(st.integers(1, 4), max_size=12)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(CUTS, CUTS), min_size=1, max_size=5))
def test_groups_and_links_equal_brute_force(texts):
    lefts, rights = [], []
    for a, b in texts:  # both sides tile the same bytes
        short, long = sorted((a, b), key=sum)
        short = short + [1] * (sum(long) - sum(short))
        lefts.append(np.array(short, np.int64))
        rights.append(np.array(long, np.int64))
    first = [np.cumsum([0, *map(len, s)]) for s in (lefts, rights)]
    aligned = alignment.Alignment(np.concatenate(lefts), np.concatenate(rights), *first)
    ids = [np.arange(len(x)) for x in (np.concatenate(lefts), np.concatenate(rights))]
    printed = alignment.printed_ids(200)
    codes = np.sort(np.concatenate(aligned.codes(*ids, 1000))).tolist()
    wanted = []
    for t, text in enumerate(aligned.shown(*ids, printed)):
        groups, links = groups_of(lefts[t].tolist(), rights[t].tolist())
        a, b = first[0][t], first[1][t]
        wanted += [(i + a) * 1000 + j + b for i, j in links]
        assert text == ";".join(f"{','.join(str(i + a) for i in g)}|{','.join(str(j + b) for j in h)}" for g, h in groups)
        assert len(groups) == np.diff(aligned.group_first)[t]
        assert len(links) == np.diff(aligned.left_first)[t] + np.diff(aligned.inner_first)[t]
    assert codes == sorted(wanted)


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 65537])
def test_doubling_reaches_the_end_of_long_chains(n):
    assert (alignment.jump(np.minimum(np.arange(n) + 1, n - 1)) == n - 1).all()


def brute(texts):
    """The contract for a list of texts."""
    a_side, b_side = Tokenizer.from_file(JSON), SentencePieceProcessor(model_file=MODEL)
    a_side.encode_special_tokens = True
    back = {c: i for i, c in enumerate(bpe.byte_characters())}
    found, counts = [], Counter()
    for text in texts:
        text = text or ""
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        a_bytes = [bytes(back[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:-1], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()
                   for i in b for p in [b_side.id_to_piece(i)]]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
            found.append(None)
            continue
        groups, links = groups_of([len(x) for x in a_bytes], [len(x) for x in b_bytes])
        links = [(a[i], b[j]) for i, j in links]
        counts.update(links)
        shown = ";".join(f"{','.join(str(a[i]) for i in g)}|{','.join(str(b[j]) for j in h)}" for g, h in groups)
        found.append((len(a), len(b), len(groups), links, shown))
    most = Counter()
    for (_, right), n in counts.items():
        most[right] = max(most[right], n)
    rows = []
    for one in found:
        if one is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links, shown = one
            rows.append((n_a, n_b, groups, len(links), sum(counts[x] == most[x[1]] for x in links),
                         sum(counts[x] for x in links), hashlib.sha256(shown.encode()).hexdigest()))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
ODD = [" two  spaces ", "\n\nline", "<|endoftext|> <s>", "a▁b", "tokenization isn't trivial", "漢字 \U0001f600", "same", "same"]


def align(df):
    return alignment.align(df, bpe.from_json(JSON), sentencepieces.read_model(MODEL))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(alignment, "PIECE", 40)
    texts = [t for t in TEXTS if len(t or "") < 1000] + ODD + ["word " * 300]
    df = spark.createDataFrame([(i, t, "mine", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, key string, `a.b` int")
    rows = align(df.repartition(3)).orderBy("doc_id").collect()
    got = [(*(r[c] for c in COLUMNS), hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "") for r in rows]
    assert got == brute(texts)
    assert align(df.limit(0)).count() == 0
    nulls = align(df.selectExpr("cast(null AS bigint) AS doc_id", "text").where("text = 'same'")).collect()
    assert [(r.doc_id, r.n_best) for r in nulls] == [(None, rows[texts.index("same")].n_links)] * 2


def test_query(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").collect()
    short = [r for r in docs if len(r.text or "") <= 1500]
    rows = {r.doc_id: r for r in alignment.op13_alignment(spark, sf_small).collect()}
    assert sorted(rows) == [r.doc_id for r in docs] and len(short) > 90
    for doc, want in zip(short, brute([r.text for r in short]), strict=True):
        got = rows[doc.doc_id]
        assert (got.n_a, got.n_b, got.n_groups, got.n_links, got.groups_sha256) == (*want[:4], want[6])


def test_query_counts(spark, tmp_path):
    texts = ["the cat sat", "The cats sat on the mat.", None, "", "the cat", "bleed thonwh ereathe"] * 3
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    rows = alignment.op13_alignment(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in [*COLUMNS, "groups_sha256"]) for r in rows] == brute(texts)
