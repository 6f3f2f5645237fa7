"""Entries for the spellings of the 1990 reform.

Working tables: ``verbs`` (verb, h_aspire, rectification_1990, rectification_1990_variante) and
``rows`` (verb, voice, mood, tense, personne, conjugaison), see ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inflecta.functions.text import REFORM_FROM, REFORM_TO, has_reform_spelling, reform_spelling, reverse_alternatives


def with_reform_flags(verbs: DataFrame, letters: str = REFORM_FROM, replacements: str = REFORM_TO) -> DataFrame:
    """Add whether a verb has a reformed spelling, and that spelling."""
    verb = F.col("verb")
    return verbs.withColumn("rectification_1990", has_reform_spelling(verb, letters)).withColumn(
        "rectification_1990_variante", reform_spelling(verb, letters, replacements)
    )


def reform_twins(verbs: DataFrame) -> DataFrame:
    """(verb, original) of the entries to add.

    A genuine entry of the same name is kept instead of the twin; of several originals with one
    reformed spelling the first in string order counts.
    """
    twins = (
        verbs.where(has_reform_spelling(F.col("verb")))
        .groupBy(reform_spelling(F.col("verb")).alias("twin"))
        .agg(F.min("verb").alias("original"))
        .select(F.col("twin").alias("verb"), "original")
    )
    return twins.join(verbs.select("verb"), "verb", "left_anti")


def with_reform_twins(verbs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add a twin for every verb the reform respells; its finite alternatives come in reverse order."""
    twins = reform_twins(verbs)
    new_verbs = (
        verbs.withColumnRenamed("verb", "original")
        .join(twins, "original")
        .withColumn("rectification_1990", F.lit(True))
        .withColumn("rectification_1990_variante", F.col("original"))
        .select(verbs.columns)
    )
    packed = (F.col("mood") != "participe") & F.col("conjugaison").contains(";")
    new_rows = (
        rows.withColumnRenamed("verb", "original")
        .join(twins, "original")
        .withColumn("conjugaison", F.when(packed, reverse_alternatives(F.col("conjugaison"))).otherwise(F.col("conjugaison")))
        .select(rows.columns)
    )
    return verbs.unionByName(new_verbs), rows.unionByName(new_rows)
