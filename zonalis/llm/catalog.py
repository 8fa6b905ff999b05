"""Queries of the corpus operators with their SQL counterparts."""

from zonalis.llm import (
    alignment,
    bpe,
    chat,
    kneser_ney,
    language,
    ngram_join,
    packing,
    quality,
    repair,
    sentencepieces,
    suffix_dedup,
    toxicity,
    vector_dedup,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_chat": chat.op2_chat,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_language_model": kneser_ney.op5_language_model,
    "op6_bpe": bpe.op6_bpe,
    "op7_vectors": vector_dedup.op7_vectors,
    "op8_language": language.op8_language,
    "op9_packing": packing.op9_packing,
    "op10_quality": quality.op10_quality,
    "op11_sentencepiece": sentencepieces.op11_sentencepiece,
    "op12_repair": repair.op12_repair,
    "op13_alignment": alignment.op13_alignment,
    "pages_language": language.pages_language,
}
ORACLE = {
    "op1_suffix_dedup": suffix_dedup.OP1_SQL,
    "op2_chat": chat.OP2_SQL,
    "op3_ngram_join": ngram_join.OP3_SQL,
    "op7_vectors": vector_dedup.OP7_SQL,
    "op12_repair": repair.OP12_SQL,
}
