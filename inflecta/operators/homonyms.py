"""Merging of homonyms: entries ``x_1``, ``x_2``, … whose voices are equal or contained in another's.

Members of a base name are taken in key order. A member contained in a cluster is absorbed, one
that contains a cluster replaces it, and the first such cluster counts; any other member opens a
cluster. A single cluster gets the base name, several are renumbered from 1.

One exact way gives the clusters of groups of any size:

* A member contained in an earlier one changes nothing, so equal members are reduced to the first
  before anything is grouped. (No cluster is ever contained in a later cluster.)
* A member has at most five voices, so at most 31 smaller members can be contained in it; links
  between members are found by joining on these restrictions and are linear in number.
* Only linked members bear on each other. Connected parts of the links are labelled first, in a
  logarithmic number of joins; then each part is decided in key order, parts spread over tasks. The
  number of jobs does not follow the length of a chain of claims. A part is held by one task as its
  links, at most 31 for each member. Members without a link open a cluster of their own.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inflecta.functions.text import base_name
from inflecta.operators.components import connected_parts
from inflecta.operators.numbering import number_rows
from inflecta.session import durable

_VOICES_TYPE = "array<struct<voice:string,digest:string>>"


def voice_contents(rows: DataFrame) -> DataFrame:
    """(verb, voice, digest): equal digests mean equal content. A voice has a fixed small number of parts."""
    rows = rows.where(F.col("voice").isNotNull())
    parts = [
        F.collect_set("mood"),
        F.collect_set(F.when(F.col("tense").isNotNull(), F.struct("mood", "tense"))),
        F.collect_set(F.when(F.col("conjugaison").isNotNull(), F.struct("mood", "tense", "personne", "conjugaison"))),
    ]
    content = F.to_json(F.struct(*[F.array_sort(part).alias(f"p{i}") for i, part in enumerate(parts)]))
    return rows.groupBy("verb", "voice").agg(F.sha2(content, 256).alias("digest"))


def members_of(verbs: DataFrame, rows: DataFrame) -> DataFrame:
    """(base, verb, voices) of the suffixed entries; ``voices`` is sorted by voice."""
    suffixed = verbs.select("verb", base_name(F.col("verb")).alias("base")).where("base IS NOT NULL")
    own_rows = rows.where(base_name(F.col("verb")).isNotNull())
    voices = voice_contents(own_rows).groupBy("verb").agg(F.array_sort(F.collect_set(F.struct("voice", "digest"))).alias("voices"))
    none = F.array().cast(_VOICES_TYPE)
    return suffixed.join(voices, "verb", "left").select("base", "verb", F.coalesce("voices", none).alias("voices"))


def containment_links(distinct: DataFrame) -> DataFrame:
    """(base, inner, outer): ``inner``'s voices are a proper part of ``outer``'s."""
    masks = F.sequence(F.lit(0), F.pow(F.lit(2), F.size("voices")).cast("int") - 2)
    parts = F.transform(
        masks, lambda m: F.filter(F.col("voices"), lambda v, i: m.bitwiseAND(F.pow(F.lit(2), i).cast("int")) != 0)
    )
    smaller = distinct.where(F.size("voices") > 0).select("base", F.col("verb").alias("outer"), F.explode(parts).alias("voices"))
    return smaller.join(distinct.withColumnRenamed("verb", "inner"), ["base", "voices"]).select("base", "inner", "outer")


def _decide(part: pa.Table) -> pa.Table:
    """(base, slot, verb): who holds each slot of a part in the end; a slot is named after the member that opened it."""
    rows = part.to_pydict()
    linked, within = defaultdict(list), set()
    for inner, outer in zip(rows["inner"], rows["outer"], strict=True):
        linked[inner].append(outer)
        linked[outer].append(inner)
        within.add((inner, outer))
    held: dict[str, str] = {}  # holder: its slot
    for verb in sorted(linked):
        claimed = [(held[other], other) for other in linked[verb] if other in held]
        if not claimed:
            held[verb] = verb
            continue
        slot, holder = min(claimed)
        if (verb, holder) not in within:  # contains the holder and replaces it
            del held[holder]
            held[verb] = slot
    base = rows["base"][0]
    return pa.table({"base": pa.array([base] * len(held)), "slot": pa.array(list(held.values())), "verb": pa.array(list(held))})


def _clusters(distinct: DataFrame) -> DataFrame:
    """(base, number, verb): the clusters of each base name, in the order in which they were opened."""
    links = durable(containment_links(distinct))
    parts = connected_parts(links.select(F.col("inner").alias("a"), F.col("outer").alias("b")))
    own_part = links.join(parts.select(F.col("node").alias("inner"), "part"), "inner")
    held = own_part.groupBy("base", "part").applyInArrow(_decide, "base string, slot string, verb string")
    lone = distinct.select("base", "verb").join(parts.select(F.col("node").alias("verb")), "verb", "left_anti")
    slots = held.unionByName(lone.select("base", F.col("verb").alias("slot"), "verb"))
    return number_rows(slots, ["slot"], "number", within=["base"]).select("base", "number", "verb")


def homonym_names(verbs: DataFrame, members: DataFrame) -> DataFrame:
    """(verb, name): the entries that are kept and the names they get.

    A merged name replaces an entry that already had it.
    """
    distinct = durable(members.groupBy("base", "voices").agg(F.min("verb").alias("verb"), F.count("*").alias("copies")))
    sizes = distinct.groupBy("base").agg(F.sum("copies").alias("members"))
    sized = distinct.join(sizes, "base")
    lone = sized.where("members = 1").select("base", "verb", F.col("verb").alias("name"))
    clusters = _clusters(durable(sized.where("members > 1").select("base", "verb", "voices")))
    counts = clusters.groupBy("base").agg(F.count("*").alias("clusters"))
    numbered = F.when(F.col("clusters") == 1, F.col("base")).otherwise(F.concat_ws("_", "base", F.col("number").cast("string")))
    merged = clusters.join(counts, "base").select("base", "verb", numbered.alias("name"))
    plain = verbs.select(F.lit(None).cast("string").alias("base"), "verb", F.col("verb").alias("name")).where(
        base_name(F.col("verb")).isNull()
    )
    # Base names are taken in string order and a later one overwrites; a name that several bases
    # give comes from bases that are prefixes of each other, so the longest is the last.
    rank = F.coalesce(F.length("base"), F.lit(-1))
    named = lone.unionByName(merged).unionByName(plain)
    return named.groupBy("name").agg(F.max_by("verb", rank).alias("verb")).select("verb", "name")


def merge_homonyms(verbs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verbs and long rows with homonyms merged; the kept member's flags count."""
    names = durable(homonym_names(verbs, members_of(verbs, rows)))

    def renamed(df: DataFrame) -> DataFrame:
        return df.join(names, "verb").withColumn("verb", F.col("name")).select(df.columns)

    return renamed(verbs), renamed(rows)
