"""The registered queries of this package: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from inflecta.llm import bpe, counts, decontam, jaccard, langid, linededup, nearvec, packing, quality, repair, spelling, sql, toxicity, urlfilter
from inflecta.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.predictions(docs, toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic"))


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """The production model: fitted on the labelled rows of the tables outside the held-out fold."""
    return quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document."""
    return quality.predictions(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that are later copies of repeated runs, deleted."""
    return linededup.digests(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of each page's url."""
    return urlfilter.verdicts(table(spark, sf_dir, "pages"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of each document."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in each document."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of each document under links of 5-word shingle sets with similarity 0.75 or more."""
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of each vector under cosine 0.93 or more within its label."""
    return nearvec.classes(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of each document before and after personal data is masked by edits."""
    return counts.counts_after_masking(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document."""
    return langid.predictions(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of each long word of the documents, some occurrences of which lose a letter."""
    return spelling.grouped(spelling.vocabulary(spelling.damaged(spelling.occurrences(table(spark, sf_dir, "documents")))))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of each conversation after its rows are damaged."""
    return repair.reports(repair.damaged(table(spark, sf_dir, "conversations")), present="present")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each piece of each document in sequences of 1024 tokens."""
    return packing.packed(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_decontamination": op6_decontamination,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_best_fit_packing": op13_best_fit_packing,
}
ORACLES: dict[str, str] = {
    "op11_spelling_variants": sql.SPELLINGS,
    "op12_conversation_repair": sql.CONVERSATIONS,
}
