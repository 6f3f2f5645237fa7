"""Review of the data: units, automatic classification, the audit log and its reports.

Data comes as ``verbs`` and long rows (see ``documents``), pages as a table with a ``verb`` column,
and the log as records (verb, voice, mood, tense, status, auditor, ts, flags, note), one per unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inflecta import dims
from inflecta.functions.html import page_nodes
from inflecta.functions.text import REFORM_FROM, key_filter, strip
from inflecta.operators.merging import latest_per_key

UNIT = ["verb", "voice", "mood", "tense"]
OK, FLAGGED, SKIPPED = "ok", "flagged", "skipped"


def in_review_order() -> list[Column]:
    """Sort columns of units."""
    return [
        F.col("verb"),
        dims.rank_of(dims.VOICE_ORDER, F.col("voice")),
        dims.rank_of(dims.MOOD_ORDER, F.col("mood")),
        dims.rank_of(dims.TENSE_ORDER, F.col("tense")),
    ]


def _with_unit_tense(rows: DataFrame) -> DataFrame:
    """Rows of units: a participle is one unit, a finite unit needs a known tense."""
    tense = F.when(F.col("mood") == "participe", F.lit("participe")).when(F.col("tense").isin(dims.TENSE_ORDER), F.col("tense"))
    known = F.col("voice").isin(dims.VOICE_ORDER) & F.col("mood").isin(dims.MOOD_ORDER)
    return rows.where(known).withColumn("tense", tense).where("tense IS NOT NULL")


def units(rows: DataFrame) -> DataFrame:
    """Distinct units, empty tenses included."""
    return _with_unit_tense(rows).select(*UNIT).distinct()


def unit_facts(rows: DataFrame) -> DataFrame:
    """One row per unit with what its classification needs: one aggregation, map-side combined."""
    key, value = F.col("personne"), F.col("conjugaison")
    blank = key.isNotNull() & (strip(value) == "")
    return _with_unit_tense(rows).groupBy(*UNIT).agg(
        F.count("personne").alias("forms"),
        F.coalesce(F.bool_or(value.contains(";")), F.lit(False)).alias("alternatives"),
        F.min_by(key, F.when(blank, F.struct(dims.first_person_rank(key), key))).alias("blank_key"),
        # Merged keys of a tense are few: each atomic person is in one of them.
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split(key, ";"))))).alias("persons"),
    )


def page_availability(verbs: DataFrame, pages: DataFrame) -> DataFrame:
    """Verbs with ``page_verb``, the verb whose page serves: the own one, else the reform variant's."""
    names = pages.select("verb").distinct()
    own = names.select("verb", F.col("verb").alias("own"))
    other = names.select(F.col("verb").alias("rectification_1990_variante"), F.col("verb").alias("other"))
    # Only verbs with a variant take part in the second join: NULL is no key.
    varied = verbs.where(F.col("rectification_1990_variante").isNotNull()).select("verb", "rectification_1990_variante").distinct()
    variants = varied.join(other, "rectification_1990_variante").select("verb", "rectification_1990_variante", "other")
    match = F.col("v.verb").eqNullSafe(F.col("o.verb")) & F.col("v.rectification_1990_variante").eqNullSafe(F.col("o.rectification_1990_variante"))
    found = verbs.join(own, "verb", "left").alias("v").join(variants.alias("o"), match, "left")
    return found.select(*[F.col(f"v.{c}") for c in verbs.columns], F.coalesce("own", "other").alias("page_verb"))


def is_generated_twin() -> Column:
    """A verb without reformed letters whose variant has them."""
    letters = f"[{REFORM_FROM}]"
    variant = F.col("rectification_1990_variante")
    return F.coalesce(variant.rlike(letters) & ~F.col("verb").rlike(letters), F.lit(False))


def _missing(expected: list[str]) -> Column:
    return F.size(F.array_except(dims.array_of(expected), F.col("persons"))) > 0


def classify_units(verbs: DataFrame, rows: DataFrame, pages: DataFrame, log: DataFrame) -> DataFrame:
    """Units with ``reason``, why a person has to look at them; an empty reason means OK."""
    return classify_facts(verbs, unit_facts(rows), pages, log)


def classify_facts(verbs: DataFrame, facts: DataFrame, pages: DataFrame, log: DataFrame) -> DataFrame:
    """``classify_units`` of ``unit_facts``; save these if the units are needed too."""
    status = page_availability(verbs, pages).select("verb", is_generated_twin().alias("twin"), F.col("page_verb").isNotNull().alias("has_page"))
    audited = log.select(*UNIT, F.lit(True).alias("audited")).distinct()
    facts = facts.join(status, "verb", "left").join(audited, UNIT, "left")
    finite_missing = F.when(F.array_contains("persons", "3sn"), _missing(dims.NEUTRAL_PERSONS)).otherwise(_missing(dims.FULL_PERSONS))
    # The reasons, in the order in which they are tested.
    reason = (
        F.when(F.col("audited").isNotNull(), "already audited")
        .when(F.col("twin"), "reform variant entry")
        .when(~F.coalesce("has_page", F.lit(False)), "no cached HTML")
        .when(F.col("mood") == "participe", "participe (complex gender)")
        .when(F.col("forms") == 0, "empty tense (defective verb)")
        .when(F.col("alternatives"), "alternative forms present")
        .when(F.col("blank_key").isNotNull(), F.concat(F.lit("empty form value for "), F.col("blank_key")))
        .when((F.col("mood") == "imperatif") & _missing(dims.IMPERATIVE_PERSONS), "missing imperative persons")
        .when((F.col("mood") != "imperatif") & finite_missing, "missing person keys")
        .otherwise("")
    )
    return facts.select(*UNIT, reason.alias("reason"))


def new_records(units_: DataFrame, status: str, auditor: str, ts: Column | None = None, flags: Column | None = None, note: str = "") -> DataFrame:
    """Log records for units, all of one outcome; ``flags`` is an array of (person, note)."""
    none = F.array().cast("array<struct<person:string,note:string>>")
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return units_.select(
        *UNIT,
        F.lit(status).alias("status"),
        F.lit(auditor).alias("auditor"),
        (now if ts is None else ts).alias("ts"),
        (none if flags is None else flags).alias("flags"),
        F.lit(note).alias("note"),
    )


def recorded(log: DataFrame, new: DataFrame) -> DataFrame:
    """The log with new outcomes replacing those of the same unit."""
    aged = log.withColumn("age", F.lit(0)).unionByName(new.withColumn("age", F.lit(1)))
    return latest_per_key(aged, UNIT, "age", "ts").select(log.columns)


def latest_records(log: DataFrame, *order: str) -> DataFrame:
    """The last record of each unit."""
    return latest_per_key(log, UNIT, *order)


def auto_audit(classified: DataFrame, log: DataFrame, auditor: str = "auto", ts: Column | None = None) -> DataFrame:
    """The log with an OK record for every unit without a reason; no record is overwritten."""
    return log.unionByName(new_records(classified.where("reason = ''"), OK, auditor, ts).select(log.columns))


def reason_histogram(classified: DataFrame) -> DataFrame:
    """Units left for a person, by reason, most frequent first."""
    open_units = classified.where("reason NOT IN ('', 'already audited')")
    return open_units.groupBy("reason").agg(F.count("*").alias("units")).orderBy(F.desc("units"), "reason")


def progress(units_: DataFrame, log: DataFrame) -> DataFrame:
    """One row: units, records by status, percent audited (0 without units), units left."""
    both = units_.select(F.lit(None).cast("string").alias("status")).unionByName(log.select("status"))
    by_status = [F.count_if(F.col("status") == s).alias(s) for s in (OK, FLAGGED, SKIPPED)]
    counts = both.agg(F.count_if(F.col("status").isNull()).alias("total"), F.count("status").alias("audited"), *by_status)
    percent = F.coalesce(F.try_divide(F.col("audited") * 100.0, F.col("total")), F.lit(0.0))
    return counts.select("*", percent.alias("percent"), (F.col("total") - F.col("audited")).alias("remaining"))


def review_view(units_: DataFrame, log: DataFrame, status: str | None = None, voice: str | None = None) -> DataFrame:
    """Units filtered by status (``unaudited``, ok, flagged, skipped) and voice."""
    view = units_ if voice is None else units_.where(F.col("voice") == voice)
    if status == "unaudited":
        return view.join(log.select(*UNIT), UNIT, "left_anti")
    if status is not None:
        return view.join(log.where(F.col("status") == status).select(*UNIT), UNIT, "left_semi")
    return view


def search_units(units_: DataFrame, prefix: str) -> DataFrame:
    """Units of verbs with a prefix, ignoring case; the prefix is trimmed and an empty one finds nothing."""
    wanted = prefix.strip().lower()
    return units_.where(F.lower("verb").startswith(wanted)) if wanted else units_.where("false")


def participle_keys(rows: DataFrame) -> DataFrame:
    """(verb, voice, key, value): the keys by which participle forms are flagged."""
    mark = F.when(F.col("tense") == "passe", ".").otherwise("_")
    key = F.when(F.col("personne").isNull(), F.col("tense")).otherwise(F.concat("tense", mark, "personne"))
    known = rows.where((F.col("mood") == "participe") & F.col("conjugaison").isNotNull())
    return known.select("verb", "voice", key.alias("key"), F.col("conjugaison").alias("value"))


def evidence(units_: DataFrame, verbs: DataFrame, pages: DataFrame) -> DataFrame:
    """Units with ``block``, the part of the source page that states them; NULL if there is none.

    Only pages that a unit wants are parsed: a filter of fixed size (``text.key_filter``) leaves out the others where
    they are read, so no page is shuffled or joined. Each page's blocks are cut out on its own row. These are joined
    by a shuffle: Spark estimates them by the size of the compressed input and would broadcast them through the driver.
    """
    served = page_availability(verbs, pages).select("verb", "page_verb")
    unit = ["voice", "mood", "tense"]
    wanted = units_.join(served, "verb").select("verb", "page_verb", *unit).distinct().withColumn("key", F.concat_ws("|", *unit))
    wanted_pages = pages.select(F.col("verb").alias("page_verb"), "html").where(key_filter(wanted, "page_verb")(F.col("page_verb")))
    parsed = wanted_pages.withColumn("nodes", page_nodes("html", "blocks", "headings"))
    parsed = parsed.withColumn("divs", F.filter("nodes.blocks", lambda b: b["tag"] == "div"))

    def first_with_id(div_id: str) -> Column:
        return F.get(F.filter("divs", lambda b: b["id"] == div_id), 0)["ord"]

    # A voice block by its own id, else the generic active one.
    voice_blocks = F.array(
        *[
            F.struct(
                F.lit(voice).alias("voice"),
                F.coalesce(first_with_id(div_id), first_with_id("voix_active") if voice.startswith("voix_active") else F.lit(None)).alias("ord"),
            )
            for voice, div_id, _ in dims.VOICES
        ]
    )

    def moods_of_voice(v: Column) -> Column:
        inside = F.filter("divs", lambda b: F.array_contains(b["anc"], v["ord"]) & F.array_contains(b["classes"], "time"))
        return F.array(
            *[
                F.struct(
                    v["voice"].alias("voice"),
                    F.lit(mood).alias("mood"),
                    F.get(F.filter(inside, lambda b: b["id"].endswith(f"_{suffix}")), 0)["ord"].alias("ord"),
                )
                for mood, suffix in dims.MOODS
            ]
        )

    def part(m: Column, tense: Column, node: Column) -> Column:
        key = F.concat_ws("|", m["voice"], m["mood"], tense)
        return F.struct(key.alias("key"), node["start"].alias("start"), node["end"].alias("end"))

    def grids(m: Column) -> Column:
        found = F.filter("divs", lambda b: F.array_contains(b["anc"], m["ord"]) & F.array_contains(b["classes"], "grid"))
        return F.transform(F.slice(found, 1, 1), lambda b: part(m, F.lit("participe"), b))

    tense_of = dims.literal_map(dims.TENSE_OF_TITLE)

    def tenses(m: Column) -> Column:
        found = F.filter("nodes.headings", lambda n: F.array_contains(n["anc"], m["ord"]))
        return F.transform(found, lambda n: part(m, tense_of[_title(n)], n))

    def _title(n: Column) -> Column:
        return F.lower(strip(F.get(F.filter(n["headings"], lambda h: h["relation"]), 0)["text"]))

    parsed = parsed.withColumn("voice_blocks", F.filter(voice_blocks, lambda v: v["ord"].isNotNull()))
    parsed = parsed.withColumn("moods", F.filter(F.flatten(F.transform("voice_blocks", moods_of_voice)), lambda m: m["ord"].isNotNull()))
    parsed = parsed.withColumn(
        "parts",
        F.concat(
            F.flatten(F.transform(F.filter("moods", lambda m: m["mood"] == "participe"), grids)),
            F.flatten(F.transform(F.filter("moods", lambda m: m["mood"] != "participe"), tenses)),
        ),
    )

    # The first part of a key counts.
    firsts = F.filter("parts", lambda p, i: ~F.exists(F.slice("parts", 1, i), lambda o: o["key"] == p["key"]))
    cut = F.transform(
        firsts, lambda p: F.struct(p["key"].alias("key"), F.substring(F.col("html"), p["start"] + 1, p["end"] - p["start"]).alias("block"))
    )
    blocks = parsed.select("page_verb", F.explode(cut).alias("c")).select("page_verb", "c.key", "c.block")
    return wanted.join(blocks.hint("merge"), ["page_verb", "key"], "left").select("verb", "page_verb", *unit, "block")
