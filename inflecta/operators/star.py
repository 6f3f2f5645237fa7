"""The published star: one dimension and two fact tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inflecta import dims
from inflecta.operators.numbering import number_rows
from inflecta.plans.lookups import Star
from inflecta.session import get_text, put_text, remove

VERBES = ["id", "infinitif", "h_aspire", "rectification_1990", "rectification_1990_variante"]
CONJUGAISONS_KEY = ["verbe_id", "voix", "mode", "temps", "personne"]
PARTICIPES_KEY = ["verbe_id", "voix", "forme"]


def build_verbes(verbs: DataFrame) -> DataFrame:
    """The dimension, ids 1…N in order of the infinitive."""
    flags = [F.coalesce(F.col(name), F.lit(False)).alias(name) for name in ("h_aspire", "rectification_1990")]
    rows = verbs.select(F.col("verb").alias("infinitif"), *flags, "rectification_1990_variante")
    return number_rows(rows, ["infinitif"], "id").select(*VERBES)


def _with_ids(rows: DataFrame, verbes: DataFrame) -> DataFrame:
    ids = verbes.select(F.col("id").alias("verbe_id"), F.col("infinitif").alias("verb"))
    return rows.join(ids, "verb")


def build_conjugaisons(rows: DataFrame, verbes: DataFrame) -> DataFrame:
    """Finite forms with text, from long rows."""
    finite = rows.where(F.col("mood").isin(dims.FINITE_MOODS) & (F.col("conjugaison") != "") & F.col("personne").isNotNull())
    return _with_ids(finite, verbes).select(
        "verbe_id", F.col("voice").alias("voix"), F.col("mood").alias("mode"), F.col("tense").alias("temps"), "personne", "conjugaison"
    )


def build_participes(rows: DataFrame, verbes: DataFrame) -> DataFrame:
    """Participles, from long rows; a present participle needs text."""
    text = F.col("conjugaison").isNotNull() & ((F.col("conjugaison") != "") | (F.col("tense") == "passe"))
    participles = rows.where((F.col("mood") == "participe") & text)
    return _with_ids(participles, verbes).select(
        "verbe_id", F.col("voice").alias("voix"), F.concat_ws("_", "tense", "personne").alias("forme"), F.col("conjugaison").alias("participe")
    )


def build_star(verbs: DataFrame, rows: DataFrame) -> Star:
    """The three tables from verbs and long rows."""
    verbes = build_verbes(verbs)
    return Star(verbes, build_conjugaisons(rows, verbes), build_participes(rows, verbes))


class StarRefused(ValueError):
    """A star that breaks its constraints; ``violations`` is the path of the table that says where."""

    def __init__(self, violations: str):
        super().__init__(f"the star breaks its constraints: see {violations}")
        self.violations = violations


def _open(spark: SparkSession, folder: str) -> Star:
    return Star(*[spark.read.parquet(f"{folder}/{name}") for name in ("verbes", "conjugaisons", "participes")])


def _stage(star: Star, folder: str) -> None:
    """Write the tables, facts sorted by verb; fact rows get a unique, not a dense, id.

    Files hold ranges of verbs and row groups are sorted by verb, so a lookup of one verb reads few of them.
    """
    star.verbes.write.parquet(f"{folder}/verbes")
    for name, facts in (("conjugaisons", star.conjugaisons), ("participes", star.participes)):
        order = ["verbe_id", *[c for c in ("voix", "mode", "temps", "personne", "forme") if c in facts.columns]]
        clustered = facts.repartitionByRange("verbe_id").sortWithinPartitions(*order)
        numbered = clustered.select(F.monotonically_increasing_id().alias("id"), *facts.columns)
        numbered.write.parquet(f"{folder}/{name}")


def write_star(star: Star, path: str) -> None:
    """Write the tables as a new build below ``path``, check it, and make it the one that ``read_star`` opens.

    A build that breaks a constraint is removed and refused (``StarRefused``, its violations are written to
    ``path/refused``); the one before stays. Otherwise one rename of a small file switches to the new build.
    The build before it is kept for readers that have it open, older ones are removed.
    """
    spark = star.verbes.sparkSession
    build = f"build-{uuid.uuid4().hex}"
    _stage(star, f"{path}/{build}")
    broken = violations(_open(spark, f"{path}/{build}"))
    broken.write.mode("overwrite").parquet(f"{path}/refused")
    if not spark.read.parquet(f"{path}/refused").isEmpty():
        remove(spark, f"{path}/{build}")
        raise StarRefused(f"{path}/refused")
    builds = _builds(spark, path)
    put_text(spark, f"{path}/{_CURRENT}", "\n".join([build, *builds[:1]]))
    for old in builds[1:]:
        remove(spark, f"{path}/{old}")


#: The file that names the current build and the one before it.
_CURRENT = "CURRENT"


def _builds(spark: SparkSession, path: str) -> list[str]:
    return get_text(spark, f"{path}/{_CURRENT}").split()


def read_star(spark: SparkSession, path: str) -> Star:
    """Open the current build of a written star; ``Star.register`` makes its tables visible to SQL."""
    builds = _builds(spark, path)
    if not builds:
        raise FileNotFoundError(f"no star was written to {path}")
    return _open(spark, f"{path}/{builds[0]}")


def violations(star: Star) -> DataFrame:
    """(relation, rule, key, n) of what breaks a constraint; no rows for a sound star.

    Unique: infinitives and ids of verbs, the keys of both fact tables. Reference: the verb of each fact.
    """

    def listed(rows: DataFrame, relation: str, rule: str, keys: list[str], n: str = "n") -> DataFrame:
        parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
        return rows.select(F.lit(relation).alias("relation"), F.lit(rule).alias("rule"), F.concat_ws("|", *parts).alias("key"), F.col(n).alias("n"))

    found = [listed(repeated_keys(star.verbes, [key]), "verbes", f"unique {key}", [key]) for key in ("id", "infinitif")]
    for relation, facts, keys in (("conjugaisons", star.conjugaisons, CONJUGAISONS_KEY), ("participes", star.participes, PARTICIPES_KEY)):
        found.append(listed(repeated_keys(facts, keys), relation, "unique key", keys))
        lost = orphans(facts, star.verbes).groupBy("verbe_id").agg(F.count("*").alias("n"))
        found.append(listed(lost, relation, "reference", ["verbe_id"]))
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    return every


def repeated_keys(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: empty when the key is unique."""
    return facts.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(facts: DataFrame, verbes: DataFrame) -> DataFrame:
    """Fact rows whose verb is not in the dimension: empty when the reference holds."""
    return facts.join(verbes.select(F.col("id").alias("verbe_id")), "verbe_id", "left_anti")


def dangling_variants(verbes: DataFrame) -> DataFrame:
    """Verbs whose reform variant is not an entry, such as one renamed by homonym merging."""
    named = verbes.where(F.col("rectification_1990_variante").isNotNull())
    names = verbes.select(F.col("infinitif").alias("rectification_1990_variante"))
    return named.join(names, "rectification_1990_variante", "left_anti").select("infinitif", "rectification_1990_variante")
