"""Documents to training windows: each stage works on all that the one before it kept.

1. language: documents whose language is unknown go.
2. toxicity: documents above the severity threshold go; learned from the labels of those that stay.
3. ngram_join: of each group of near duplicates the document with the smallest id stays.
4. suffix_dedup: passages of 50 bytes or more that an earlier document has are cut out of the text;
   bytes of a character that was cut through go with it, and ``n_chars`` is counted anew.
5. packing: the ids of all documents in windows.

Documents without an id belong to no group and stay; so do all rows of an id that stays, which do not
cut each other. All stages but the last return the columns that they get, under whatever names: a
stage sees columns that it does not use by their places.
"""

import functools
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm import bpe, language, ngram_join, packing, suffix_dedup, toxicity
from zonalis.llm.common import table
from zonalis.session import stage


#: Columns that stages use by name.
USED = ("doc_id", "text", "lang", "source", "n_chars")


def on_places(step):
    """The step with other columns named by their places, so that no name clashes with its own."""

    @functools.wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [n if n in USED else f"extra_{i}" for i, n in enumerate(docs.columns)]
        return step(spark, docs.toDF(*names), sf_dir).select(*names).toDF(*docs.columns)

    return run


@on_places
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, declaration="lang", host="source")


@on_places
def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, out="__toxicity")
    return scored.where(~toxicity.toxic("__toxicity")).select(*docs.columns)


@on_places
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = ngram_join.ngram_components(docs)
    gone = groups.where("component_id != doc_id").select("doc_id").distinct()
    return docs.join(stage(gone, "near-duplicates").hint("merge"), "doc_id", "left_anti").select(*docs.columns)


@on_places
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    @F.arrow_udf("string")
    def characters(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([x.as_py().decode(errors="ignore") for x in batch], pa.string())

    cut = suffix_dedup.remove_repeats(docs).withColumn("text", characters("kept"))
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, bpe.from_json(public_tokenizers.path("byte_bpe_50k.json")))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


STAGES = [
    ("language", known_language),
    ("toxicity", not_toxic),
    ("ngram_join", one_of_each_group),
    ("suffix_dedup", without_repeats),
    ("packing", packed),
]

#: No stage but the near-duplicate and passage rules has an SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
