"""Merging of identical person forms, coverage, and latest-row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inflecta.dims import PERSON_ORDER, rank_of

MERGED = ["personne", "conjugaison"]


def merged_pairs(persons: Column) -> Column:
    """Merge persons of one tense that share a form.

    ``persons`` is an array of (person, form) in person order; the result is an array of
    (personne, conjugaison), one per distinct form, in order of first use.
    """
    forms = F.array_distinct(F.transform(persons, lambda p: p["form"]))

    def key_of(form: Column) -> Column:
        same = F.filter(persons, lambda p: p["form"] == form)
        return F.array_join(F.transform(same, lambda p: p["person"]), ";")

    return F.transform(forms, lambda f: F.struct(key_of(f).alias("personne"), f.alias("conjugaison")))


def merge_identical(
    forms: DataFrame,
    keys: Sequence[str],
    person: str = "person",
    form: str = "form",
    rank: Column | None = None,
) -> DataFrame:
    """One row per distinct form of a tense, its key naming all persons that share the form.

    Among repeats of a person the row of highest ``rank`` wins, by default the smallest form (``merge_smallest``).
    With a rank each person has one aggregate slot, so partial aggregation runs before the single shuffle and
    a group never holds more than thirteen forms, however many input rows repeat a person.
    """
    if rank is None:
        return merge_smallest(forms, keys, person, form)
    value = F.col(form)

    def slot(p: str) -> Column:
        return F.max_by(value, F.when(F.col(person) == p, rank)).alias(p)

    wide = forms.groupBy(*keys).agg(*[slot(p) for p in PERSON_ORDER])
    persons = F.filter(
        F.array(*[F.struct(F.lit(p).alias("person"), F.col(p).alias("form")) for p in PERSON_ORDER]),
        lambda p: p["form"].isNotNull(),
    )
    return (
        wide.select(*keys, F.explode(merged_pairs(persons)).alias("m"))
        .select(*keys, "m.personne", "m.conjugaison")
    )


def merge_smallest(forms: DataFrame, keys: Sequence[str], person: str = "person", form: str = "form") -> DataFrame:
    """``merge_identical`` where the smallest form of a person counts, by sets of persons as bits of a number.

    The persons of each form are gathered by a hash aggregation of numbers, combined before the shuffle, so no strings
    are sorted by the rows of the input. Of the forms of one set of persons only the smallest can count, which bounds
    a tense by the number of sets. Then a form keeps the persons that no smaller form of its tense has.
    """
    ordinal = rank_of(PERSON_ORDER, F.col(person))
    named = forms.where(F.col(form).isNotNull() & ordinal.isNotNull()).select(*keys, F.col(form).alias("conjugaison"), ordinal.alias("_ordinal"))
    masked = named.groupBy(*keys, "conjugaison").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("_ordinal"))).alias("_mask"))
    least = Window.partitionBy(*keys, "_mask").orderBy("conjugaison")
    masked = masked.withColumn("_place", F.row_number().over(least)).where("_place = 1").drop("_place")
    smaller = Window.partitionBy(*keys).orderBy("conjugaison").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.bit_or("_mask").over(smaller), F.lit(0))
    own = masked.withColumn("_own", F.col("_mask").bitwiseAND(F.bitwise_not(taken))).where("_own <> 0")
    persons = [F.when(F.col("_own").bitwiseAND(1 << i) != 0, p) for i, p in enumerate(PERSON_ORDER)]
    return own.select(*keys, F.concat_ws(";", *persons).alias("personne"), "conjugaison")


def persons_covered(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sorted atomic persons covered by the merged keys of each group."""
    parts = merged.select(*keys, F.explode(F.split("personne", ";")).alias("person"))
    return parts.groupBy(*keys).agg(F.array_sort(F.collect_set("person")).alias("persons"))


def latest_per_key(rows: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row of each key that is last in ``order``; a partial aggregate, so hot keys stay cheap."""
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*").select(*rows.columns)
