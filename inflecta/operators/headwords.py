"""The headword list: listing items to numbered (verb, id) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inflecta.dims import ENTRY_ID_PREFIX
from inflecta.functions.html import page_nodes
from inflecta.functions.text import canonical_headword, last_segment
from inflecta.operators.numbering import number_rows
from inflecta.session import durable

# Where a listing page has its items.
LISTING = ["div#colGaucheResultat", "ul.listColGauche"]


def listing_items(pages: DataFrame, within: list[str] = LISTING, html: str = "html") -> DataFrame:
    """Items (href, display) of lists that lie within all of ``within``; items without a link are dropped."""
    keys = [c for c in pages.columns if c != html]
    inside = F.filter(
        page_nodes(html, "items")["items"],
        lambda i: i["href"].isNotNull() & (F.size(F.array_intersect(i["within"], F.array(*[F.lit(w) for w in within]))) == len(within)),
    )
    rows = pages.select(*keys, F.explode(inside).alias("i"))
    return rows.select(*keys, "i.href", F.col("i.text").alias("display"))


def search_hits(items: DataFrame) -> DataFrame:
    """(letter, canonical, verb_id, display) of listing items (letter, href, display)."""
    return items.select(
        "letter", canonical_headword(F.col("display")).alias("canonical"), last_segment(F.col("href")).alias("verb_id"), "display"
    )


def headword_list(hits: DataFrame, exclude: DataFrame, remap: DataFrame, id_prefix: str = ENTRY_ID_PREFIX) -> DataFrame:
    """(letter, rank_verb, verb, verb_id).

    Exclusion comes first, then the id filter, then forced ids, then numbering: a verb without a
    usable hit is never remapped. A verb with several hits gets one numbered line per hit, by id.
    """
    usable = hits.join(exclude.select(F.col("verb").alias("canonical")), "canonical", "left_anti").where(
        F.col("verb_id").startswith(id_prefix)
    )
    # Hits come from the tokeniser, the dearest step: it runs once for the three uses below.
    usable = durable(usable.select("letter", "canonical", "verb_id"))
    groups = usable.groupBy("letter", "canonical").agg(F.count("*").alias("hits"), F.min("verb_id").alias("only_id"))
    forced = remap.select(F.col("verb").alias("canonical"), F.col("verb_id").alias("forced_id"))
    groups = groups.join(forced, "canonical", "left")
    single = groups.where("hits = 1 OR forced_id IS NOT NULL").select(
        "letter", F.col("canonical").alias("rank_verb"), F.col("canonical").alias("verb"), F.coalesce("forced_id", "only_id").alias("verb_id")
    )
    several = groups.where("hits > 1 AND forced_id IS NULL").select("letter", "canonical")
    homonyms = usable.join(several, ["letter", "canonical"], "left_semi").select("letter", "canonical", "verb_id")
    numbered = number_rows(homonyms, ["verb_id"], "number", within=["letter", "canonical"]).select(
        "letter",
        F.col("canonical").alias("rank_verb"),
        F.concat_ws("_", "canonical", F.col("number").cast("string")).alias("verb"),
        "verb_id",
    )
    return single.unionByName(numbered)


def pending(headwords: DataFrame, store: DataFrame, ignore_store: bool = False) -> DataFrame:
    """Headwords not stored yet."""
    return headwords if ignore_store else headwords.join(store.select("verb"), "verb", "left_anti")
