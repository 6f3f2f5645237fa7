"""Queries over the star: lookups, pattern searches, comparisons and statistics.

Every function takes a ``Star`` (or one of its tables) and returns a DataFrame. A verb is given by
its infinitive, as a string or as a column expression such as a scalar subquery.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inflecta.dims import (
    AUXILIARY_OF_VOICE,
    COMPARISON_TENSES,
    PERSON_PRONOUNS,
    VOICE_OF_AUXILIARY,
    array_of,
    covers,
    first_person_rank,
    literal_map,
    rank_of,
)
from inflecta.functions.text import drop_last, like

AVOIR, ETRE, PRONO = "voix_active_avoir", "voix_active_etre", "voix_prono"


@dataclass(frozen=True)
class Star:
    """The three published tables."""

    verbes: DataFrame
    conjugaisons: DataFrame
    participes: DataFrame

    def register(self) -> None:
        """Make the tables visible to ``spark.sql``."""
        self.verbes.createOrReplaceTempView("verbes")
        self.conjugaisons.createOrReplaceTempView("conjugaisons")
        self.participes.createOrReplaceTempView("participes")


def _verb(star: Star, infinitif: str | Column) -> DataFrame:
    wanted = F.lit(infinitif) if isinstance(infinitif, str) else infinitif
    return star.verbes.where(F.col("infinitif") == wanted)


def _rows_of_verb(star: Star, facts: DataFrame, infinitif: str | Column) -> DataFrame:
    """Fact rows of one verb.

    An infinitive is unique, so the verb side is one row: broadcasting it is safe at any scale. On a
    written star the join stands on the scan, which is sorted by verb.
    """
    one = F.broadcast(_verb(star, infinitif).select(F.col("id").alias("verbe_id")))
    return facts.join(one, "verbe_id", "left_semi")


def _where(facts: DataFrame, voice=None, mood=None, tense=None) -> DataFrame:
    for column, value in (("voix", voice), ("mode", mood), ("temps", tense)):
        if value is not None:
            facts = facts.where(F.col(column) == value)
    return facts


def _verbs_where(star: Star, condition: Column, rows: Column, mood=None, tense=None) -> DataFrame:
    """Verbs that satisfy an aggregate ``condition`` over their fact rows: one pass, one shuffle.

    ``rows`` tells which fact rows the condition looks at; only these are read and shuffled.
    """
    facts = _where(star.conjugaisons, mood=mood, tense=tense).where(rows)
    ids = facts.groupBy(F.col("verbe_id").alias("id")).agg(condition.alias("hit")).where("hit").select("id")
    return star.verbes.join(ids, "id", "left_semi")


def _top(df: DataFrame, limit: int | None, *order) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def _by_person() -> list[Column]:
    return [first_person_rank(F.col("personne")).asc_nulls_first(), F.col("personne")]


# Lookups of one verb


def forms_of_verb(star: Star, infinitif) -> DataFrame:
    """Q1: all finite forms of a verb."""
    rows = _rows_of_verb(star, star.conjugaisons, infinitif)
    named = rows.join(F.broadcast(_verb(star, infinitif)), F.col("verbe_id") == F.col("id"))
    return (
        named.orderBy("voix", "mode", "temps", *_by_person())
        .select("infinitif", "voix", "mode", "temps", "personne", "conjugaison")
    )


def tense_of_verb(star: Star, infinitif, voice: str, mood: str, tense: str) -> DataFrame:
    """Q2, Q24, Q28: one tense of a verb."""
    facts = _where(star.conjugaisons, voice, mood, tense)
    return _rows_of_verb(star, facts, infinitif).orderBy(*_by_person()).select("personne", "conjugaison")


def participles_of_verb(star: Star, infinitif, voice: str | None = None) -> DataFrame:
    """Q3, Q25, Q29: participles of a verb, of all voices or one."""
    facts = _where(star.participes, voice)
    columns = ["voix", "forme", "participe"] if voice is None else ["forme", "participe"]
    return _rows_of_verb(star, facts, infinitif).orderBy("voix", "forme").select(*columns)


def form_of_verb(star: Star, infinitif, voice: str, mood: str, tense: str, person: str) -> DataFrame:
    """Q27: the form of one person."""
    facts = _where(star.conjugaisons, voice, mood, tense).where(covers(F.col("personne"), person))
    return _rows_of_verb(star, facts, infinitif).select("conjugaison")


def verb_metadata(star: Star, infinitif) -> DataFrame:
    """Q26: the dimension row of a verb."""
    return _verb(star, infinitif).select(
        "id", "infinitif", "h_aspire", "rectification_1990", "rectification_1990_variante"
    )


def active_and_pronominal(star: Star, infinitif, mood: str = "indicatif", tense: str = "present") -> DataFrame:
    """Q11: active and pronominal forms of one tense, one below the other."""

    def side(voice: str, label: str) -> DataFrame:
        facts = _where(star.conjugaisons, voice, mood, tense)
        return _rows_of_verb(star, facts, infinitif).select(F.lit(label).alias("form"), "personne", "conjugaison")

    both = side(AVOIR, "active").unionByName(side(PRONO, "pronominal"))
    return both.orderBy("personne", "form", "conjugaison")


def person_across_tenses(star: Star, infinitif, voice: str, mood: str, person: str) -> DataFrame:
    """Q21: one person in every tense of a mood."""
    facts = _where(star.conjugaisons, voice, mood).where(covers(F.col("personne"), person))
    order = rank_of(COMPARISON_TENSES, F.col("temps")).asc_nulls_first()
    return _rows_of_verb(star, facts, infinitif).orderBy(order, "temps", "personne").select("temps", "conjugaison")


def conjugation_table(star: Star, infinitif, voice: str = AVOIR, mood: str = "indicatif", tense: str = "present") -> DataFrame:
    """Q22, Q33: one tense with pronouns instead of person keys, one line per merged key."""
    pronouns = literal_map(PERSON_PRONOUNS)
    parts = F.transform(F.split("personne", ";"), lambda p: F.coalesce(pronouns[p], p))
    return tense_of_verb(star, infinitif, voice, mood, tense).select(
        F.array_join(F.array_distinct(parts), ", ").alias("pronoun"), "conjugaison"
    )


# Verb lists


def h_aspire_verbs(star: Star) -> DataFrame:
    """Q4: verbs with an aspirated h."""
    return star.verbes.where("h_aspire").select("infinitif").orderBy("infinitif")


def _reformed(star: Star) -> DataFrame:
    return star.verbes.where(F.col("rectification_1990") & F.col("rectification_1990_variante").isNotNull())


def reform_variants(star: Star, unique: bool = False) -> DataFrame:
    """Q5, Q25, Q31: spelling pairs; with ``unique`` each pair once, in string order."""
    rows = _reformed(star)
    if unique:
        rows = rows.where(F.col("infinitif") < F.col("rectification_1990_variante"))
    return rows.select("infinitif", "rectification_1990_variante").orderBy("infinitif")


def both_spellings(star: Star, spellings: list[str]) -> DataFrame:
    """Q6: dimension rows of given spellings."""
    rows = star.verbes.where(F.col("infinitif").isin(*spellings))
    return rows.select("infinitif", F.col("rectification_1990_variante").alias("alternate_spelling")).orderBy("infinitif")


def reform_pair_count(star: Star) -> DataFrame:
    """Q7: number of pairs, by integer division."""
    return _reformed(star).agg(F.expr("count(*) div 2").alias("reformed_verb_pairs"))


def verbs_with_voice(star: Star, voice: str, limit: int | None = 20) -> DataFrame:
    """Q8, Q10: verbs that have forms in a voice."""
    verbs = _verbs_where(star, F.lit(True), F.col("voix") == voice)
    return _top(verbs.select("infinitif"), limit, "infinitif")


def verbs_with_auxiliary(star: Star, auxiliary: str) -> DataFrame:
    """Q32: verbs of an auxiliary given by name."""
    voice = VOICE_OF_AUXILIARY.get(auxiliary.lower())
    if voice is None:
        raise ValueError(f"unknown auxiliary: {auxiliary}")
    return verbs_with_voice(star, voice, limit=None)


def verbs_with_both_auxiliaries(star: Star, limit: int | None = 20) -> DataFrame:
    """Q9: verbs that take either auxiliary."""
    both = F.bool_or(F.col("voix") == AVOIR) & F.bool_or(F.col("voix") == ETRE)
    return _top(_verbs_where(star, both, F.col("voix").isin(AVOIR, ETRE)).select("infinitif"), limit, "infinitif")


def verbs_ending_in(star: Star, suffix: str = "er", limit: int | None = 20) -> DataFrame:
    """Q12: infinitives with a suffix."""
    return _top(star.verbes.where(F.col("infinitif").endswith(suffix)).select("infinitif"), limit, "infinitif")


def verbs_with_form_ending(
    star: Star, person: str = "1s", mood: str = "indicatif", tense: str = "present", suffix: str = "ais", limit: int | None = 20
) -> DataFrame:
    """Q13: verbs whose form of a person ends in a suffix."""
    ends = covers(F.col("personne"), person) & F.col("conjugaison").endswith(suffix)
    return _top(_verbs_where(star, F.lit(True), ends, mood, tense).select("infinitif"), limit, "infinitif")


def impersonal_verbs(
    star: Star, mood: str = "indicatif", tense: str = "present", limit: int | None = 20
) -> DataFrame:
    """Q20: verbs with a third person singular and no first."""
    third, first = covers(F.col("personne"), "3sm"), covers(F.col("personne"), "1s")
    return _top(_verbs_where(star, F.bool_or(third) & ~F.bool_or(first), third | first, mood, tense).select("infinitif"), limit, "infinitif")


def _person_forms(star: Star, mood: str, tense: str, person_a: str, person_b: str) -> DataFrame:
    """Forms of two persons side by side per verb and voice.

    Replaces a self join by one pass. A person key occurs once per tense and an alias names two
    persons, so each set holds at most two forms.
    """
    def forms(person: str) -> Column:
        return F.collect_set(F.when(covers(F.col("personne"), person), F.col("conjugaison")))

    named = covers(F.col("personne"), person_a) | covers(F.col("personne"), person_b)
    facts = _where(star.conjugaisons, mood=mood, tense=tense).where(named)
    return facts.groupBy("verbe_id", "voix").agg(forms(person_a).alias("a"), forms(person_b).alias("b"))


def stem_changing_verbs(star: Star, suffix: str = "er", limit: int | None = 20) -> DataFrame:
    """Q14: verbs whose first person singular and plural differ in stem."""
    pairs = (
        _person_forms(star, "indicatif", "present", "1s", "1p")
        .select("verbe_id", F.explode("a").alias("first_singular"), "b")
        .select("verbe_id", "first_singular", F.explode("b").alias("first_plural"))
        .where(drop_last(F.col("first_singular"), 2) != drop_last(F.col("first_plural"), 3))
        .distinct()
    )
    verbs = star.verbes.where(F.col("infinitif").endswith(suffix)).select(F.col("id").alias("verbe_id"), "infinitif")
    found = pairs.join(verbs, "verbe_id").select("infinitif", "first_singular", "first_plural")
    return _top(found, limit, "infinitif", "first_singular", "first_plural")


def verbs_with_equal_persons(
    star: Star, person_a: str = "1s", person_b: str = "3sm", mood: str = "indicatif", tense: str = "present", limit: int | None = 20
) -> DataFrame:
    """Q19: verbs where two persons share a form in some voice."""
    same = _person_forms(star, mood, tense, person_a, person_b).where(F.arrays_overlap("a", "b"))
    ids = same.select(F.col("verbe_id").alias("id")).distinct()
    return _top(star.verbes.join(ids, "id", "left_semi").select("infinitif"), limit, "infinitif")


def verbs_with_pattern(
    star: Star, pattern: str, mood: str = "indicatif", tense: str = "present", person: str = "1s", limit: int | None = 10, ci: bool = False
) -> DataFrame:
    """Q30: verbs and forms where the form of a person matches a LIKE pattern."""
    facts = _where(star.conjugaisons, mood=mood, tense=tense).where(
        covers(F.col("personne"), person) & like(F.col("conjugaison"), pattern, ci)
    )
    pairs = facts.select(F.col("verbe_id").alias("id"), "conjugaison").distinct()
    found = pairs.join(star.verbes.select("id", "infinitif"), "id").select("infinitif", "conjugaison")
    return _top(found, limit, "infinitif", "conjugaison")


def search_forms(star: Star, substring: str, limit: int | None = 20) -> DataFrame:
    """Q23: forms that contain a text, in a total order."""
    facts = star.conjugaisons.where(F.col("conjugaison").contains(substring))
    columns = ["infinitif", "voix", "mode", "temps", "personne", "conjugaison"]
    found = facts.join(star.verbes.select(F.col("id").alias("verbe_id"), "infinitif"), "verbe_id").select(*columns)
    return _top(found, limit, *columns)


# Statistics


def verb_count(star: Star) -> DataFrame:
    """Q15."""
    return star.verbes.agg(F.count("*").alias("total_verbs"))


def forms_per_mood(star: Star) -> DataFrame:
    """Q16."""
    counts = star.conjugaisons.groupBy("mode").agg(F.count("*").alias("conjugation_count"))
    return counts.orderBy(F.desc("conjugation_count"), "mode")


def verbs_per_auxiliary(star: Star) -> DataFrame:
    """Q17: distinct verbs per voice, labelled by auxiliary; a voice without label keeps NULL."""
    counts = star.conjugaisons.groupBy("voix").agg(F.count_distinct("verbe_id").alias("verb_count"))
    label = literal_map(AUXILIARY_OF_VOICE)[F.col("voix")].alias("auxiliary_type")
    return counts.select(label, "verb_count").orderBy(F.desc("verb_count"), F.asc_nulls_first("auxiliary_type"))


def commonest_forms(
    star: Star, mood: str = "indicatif", tense: str = "present", person: str = "1s", limit: int | None = 20
) -> DataFrame:
    """Q18: forms of a person by frequency."""
    facts = _where(star.conjugaisons, mood=mood, tense=tense).where(covers(F.col("personne"), person))
    counts = facts.groupBy("conjugaison").agg(F.count("*").alias("frequency"))
    return _top(counts, limit, F.desc("frequency"), "conjugaison")
