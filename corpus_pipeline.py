"""The corpus pipeline: documents in, kept, cut and tokenized documents out.

Each stage takes (spark, docs, sf_dir) and all that the stage before it kept. All but the last return the columns of
``documents``; further columns of the input, whatever their names, end at the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inflecta.llm import bpe, decontam, jaccard, linededup, quality
from inflecta.llm.common import Scratch, table
from inflecta.llm.entries import RANKS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No SQL: the classifier, the joins of shingle sets and the tokenizer are beyond it; tests hold it against brute force.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from their labels outside the held-out fold."""
    docs = docs.select(*COLUMNS)
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality")
    return quality.scored(docs, model, score="_score").where(F.col("_score") >= 0.3).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; none goes, one of which nothing is left is empty."""
    done = linededup.deduplicated(docs.select(*COLUMNS))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: that of the least id, once. Documents without an id are not told apart and stay."""
    docs = docs.select(*COLUMNS)
    first = jaccard.classes(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id")).distinct()
    kept = docs.join(first, docs["doc_id"].eqNullSafe(first["_id"]), "left_semi")
    return kept.withColumn("_h", F.xxhash64("text")).dropDuplicates(["doc_id", "_h"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    found = decontam.matched(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), matches="_matches")
    return found.where(F.size("_matches") == 0).select(*COLUMNS)


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the count of these."""
    encoded = bpe.encode(docs.select(*COLUMNS), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return encoded.select(*COLUMNS, "token_ids", F.size("token_ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokenization),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read by the next."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.save(stage(spark, docs, sf_dir), str(number))
        if number:
            scratch.drop(str(number - 1))
    return STAGES[-1][1](spark, docs, sf_dir)
