"""The star over ``part`` (dimension) and ``lineitem`` (facts), in Spark and in SQL.

The mapping expressions are one text used by both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table
from inflecta.dims import array_of, rank_of
from inflecta.operators.merging import merge_identical
from inflecta.plans.lookups import Star

INFINITIF = (
    "replace(p_name,' ','') || CAST(p_partkey AS VARCHAR(20)) || "
    "CASE p_size % 3 WHEN 0 THEN 'er' WHEN 1 THEN 'ir' ELSE 'oître' END"
)
VARIANTE = "CASE WHEN p_size % 3 = 2 THEN replace(p_name,' ','') || CAST(p_partkey AS VARCHAR(20)) || 'oitre' END"
VERBES_SQL = f"""SELECT p_partkey AS id, {INFINITIF} AS infinitif, p_name LIKE 'h%' AS h_aspire,
  p_size % 3 = 2 AS rectification_1990, {VARIANTE} AS rectification_1990_variante FROM part"""

VOIX = (
    "CASE WHEN l_returnflag = 'A' AND l_partkey % 5 <> 0 THEN 'voix_active_avoir' "
    "WHEN l_returnflag = 'N' AND l_partkey % 3 = 0 THEN 'voix_active_etre' "
    "WHEN l_returnflag = 'R' AND l_partkey % 2 = 0 THEN 'voix_prono' ELSE 'voix_passive' END"
)
MODE = "CASE l_linestatus WHEN 'F' THEN 'indicatif' ELSE 'subjonctif' END"
TEMPS = "CASE l_suppkey % 3 WHEN 0 THEN 'present' WHEN 1 THEN 'imparfait' ELSE 'passe_simple' END"
PERSONNE = (
    "CASE l_linenumber WHEN 1 THEN '1sm' WHEN 2 THEN '1sf' WHEN 3 THEN '3sm' WHEN 4 THEN '3sf' "
    "WHEN 5 THEN '1pm' WHEN 6 THEN '1pf' ELSE '3sn' END"
)
CONJUGAISON = (
    "CASE CAST(l_quantity AS INT) % 5 WHEN 0 THEN 'fais' WHEN 1 THEN 'parle' WHEN 2 THEN 'allons' "
    "WHEN 3 THEN 'a;b' ELSE 'aient' END"
)
FORME = "CASE l_linenumber % 4 WHEN 0 THEN 'passe_sm' WHEN 1 THEN 'passe_sf' WHEN 2 THEN 'passe_pm' ELSE 'passe_pf' END"
PARTICIPE = "CASE WHEN l_discount < 0.05 THEN 'allé' ELSE 'parlé' END"
PERSON_ORD = (
    "CASE personne WHEN '1sm' THEN 0 WHEN '1sf' THEN 1 WHEN '3sm' THEN 4 WHEN '3sf' THEN 5 "
    "WHEN '3sn' THEN 6 WHEN '1pm' THEN 7 ELSE 8 END"
)
KEYS = ["verbe_id", "voix", "mode", "temps"]

STAR_SQL = f"""verbes AS ({VERBES_SQL}),
atomic AS (SELECT l_partkey AS verbe_id, {VOIX} AS voix, {MODE} AS mode, {TEMPS} AS temps,
  {PERSONNE} AS personne, min({CONJUGAISON}) AS conjugaison FROM lineitem GROUP BY 1,2,3,4,5),
conjugaisons AS (SELECT verbe_id, voix, mode, temps, string_agg(personne, ';' ORDER BY {PERSON_ORD}) AS personne,
  conjugaison FROM atomic GROUP BY verbe_id, voix, mode, temps, conjugaison),
participes AS (SELECT l_partkey AS verbe_id, {VOIX} AS voix, {FORME} AS forme, min({PARTICIPE}) AS participe
  FROM lineitem GROUP BY 1,2,3)"""


def with_star(sql: str, ctes: str = "") -> str:
    """SQL text over the star tables, with further CTEs if given."""
    return f"WITH {STAR_SQL}{',' + ctes if ctes else ''}\n{sql}"


def verbes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id",
        f"{INFINITIF} AS infinitif",
        "p_name LIKE 'h%' AS h_aspire",
        "p_size % 3 = 2 AS rectification_1990",
        f"{VARIANTE} AS rectification_1990_variante",
    )


def atomic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: person and form before any merging."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey AS verbe_id",
        f"{VOIX} AS voix",
        f"{MODE} AS mode",
        f"{TEMPS} AS temps",
        f"{PERSONNE} AS person",
        f"{CONJUGAISON} AS form",
    )


def conjugaisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_identical(atomic_lines(spark, sf_dir), KEYS)


def smallest(values: list[str], column: str) -> Column:
    """The smallest of the few ``values`` a column has, by its number: Spark sorts all rows to aggregate strings."""
    ordered = sorted(values)
    return F.get(array_of(ordered), F.min(rank_of(ordered, F.col(column)))).alias(column)


def participes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey AS verbe_id", f"{VOIX} AS voix", f"{FORME} AS forme", f"{PARTICIPE} AS participe"
    )
    return lines.groupBy("verbe_id", "voix", "forme").agg(smallest(["allé", "parlé"], "participe"))


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(verbes(spark, sf_dir), conjugaisons(spark, sf_dir), participes(spark, sf_dir))


def star_of_last_verb(spark: SparkSession, sf_dir: str) -> tuple[Star, Column]:
    """The whole star, and the last verb in string order, to be looked up in it."""
    whole = star(spark, sf_dir)
    return whole, whole.verbes.agg(F.max("infinitif")).scalar()
