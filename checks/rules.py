"""Registered checks of readers, text rules, joins and aggregations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.pages import PAGE_TENSE, conjugation_pages, stated
from checks.registry import new_folder, query, table, written
from checks.star import CONJUGAISON, KEYS, MODE, PERSONNE, TEMPS, VOIX, atomic_lines, conjugaisons, star, verbes, with_star
from inflecta.functions import text as t
from inflecta.operators import audit, extract, headwords, merging, reform
from inflecta.operators.documents import invalid_records
from inflecta.operators import star as st
from inflecta.operators.numbering import number_rows
from inflecta.plans import lookups
from inflecta.session import durable
from inflecta.sources import files, sinks

# Readers

LINES_SQL = """lines AS (SELECT doc_id * 1000000 + i AS line_no, v AS value FROM
  (SELECT doc_id, unnest(string_split(text, chr(10))) AS v, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))"""
# Spark and SQL agree on ASCII whitespace; the documents have no other.
TRIMMED = "trim(value, ' ' || chr(9) || chr(13) || chr(10))"


def document_lines(spark, sf):
    parts = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "value"))
    return parts.select((F.col("doc_id") * 1000000 + F.col("i") + 1).alias("line_no"), "value")


def over_lines(sql: str) -> str:
    return f"WITH {LINES_SQL} {sql}"


FIRST = f"trim(string_split({TRIMMED}, ':')[1])"
REST = f"trim(substr({TRIMMED}, strpos({TRIMMED}, ':') + 1))"


@query("s1_page_scan", "SELECT CAST(page_id AS VARCHAR) AS verb, md5(html) AS html FROM pages WHERE page_id % 5 <> 0")
def _s1(spark, sf):
    name = F.concat(F.lit("/pages/x/"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 5 == 0, ".txt").otherwise(".html"))
    found = files.parse_page_files(table(spark, sf, "pages").select(name.alias("path"), F.encode("html", "UTF-8").alias("content")))
    return found.select("verb", F.md5("html").alias("html"))


@query(
    "s2_headword_lines",
    over_lines(f"SELECT {FIRST} AS verb, CASE WHEN strpos({TRIMMED}, ':') > 0 THEN {REST} END AS verb_id FROM lines WHERE {TRIMMED} <> ''"),
)
def _s2(spark, sf):
    return files.parse_headwords(document_lines(spark, sf))


@query(
    "s3_exclusion_lines",
    over_lines(f"SELECT DISTINCT {FIRST} AS verb FROM lines WHERE {TRIMMED} <> '' AND {TRIMMED} NOT LIKE '#%' AND {FIRST} <> ''"),
)
def _s3(spark, sf):
    return files.parse_exclusions(document_lines(spark, sf))


# A remap line for each line of a document, whole: a colon after its first word; some with stars, some comments.
REMAP_LINE = (
    "CASE WHEN line_no % 7 = 0 THEN '# ' ELSE '' END || substr(value, 1, instr(value || ' ', ' ') - 1) || ':' || substr(value, instr(value || ' ', ' ')) "
    "|| CASE WHEN line_no % 2 = 0 THEN '**' ELSE '' END"
)


@query(
    "s4_remap_lines",
    f"WITH {LINES_SQL.replace('lines AS', 'plain AS', 1)}, lines AS (SELECT line_no, {REMAP_LINE} AS value FROM plain) "
    f"SELECT {FIRST} AS verb, arg_max(rtrim({REST}, '*'), line_no) AS verb_id FROM lines "
    f"WHERE {TRIMMED} NOT LIKE '#%' AND {FIRST} <> '' AND rtrim({REST}, '*') <> '' GROUP BY 1",
)
def _s4(spark, sf):
    return files.parse_remaps(document_lines(spark, sf).selectExpr("line_no", f"{REMAP_LINE} AS value"))


@query("s11_line_counts", over_lines(f"SELECT count(*) AS lines, count_if({TRIMMED} <> '')::BIGINT AS with_text FROM lines"))
def _s11(spark, sf):
    return files.count_lines(document_lines(spark, sf))


ITEMS_SQL = r"""items AS (SELECT page_id, regexp_extract(url, '^https?://[^/]*/([a-z]*)', 1) AS letter,
  unnest(regexp_extract_all(nav, '<li><a href="([^"]*)">([^<]*)</a>', 1)) AS href,
  unnest(regexp_extract_all(nav, '<li><a href="([^"]*)">([^<]*)</a>', 2)) AS display
  FROM (SELECT *, regexp_extract(html, '<nav>.*?</nav>', 0, 's') AS nav FROM pages)),
hits AS (SELECT letter, trim(replace(replace(trim(string_split(display, ',')[1]), ' (s'')', ''), ' (se)', '')) AS canonical,
  string_split(href, '/')[-1] AS verb_id, display FROM items)"""


def listing(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "^https?://[^/]*/([a-z]*)", 1).alias("letter"), "html")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return headwords.listing_items(pages.repartition(tasks, "page_id"), ["nav", "ul"])


@query("s5_u1_listing_items", f"WITH {ITEMS_SQL} SELECT page_id, letter, href, display FROM items")
def _s5(spark, sf):
    return listing(spark, sf)


@query("x20_x21_headwords_of_items", f"WITH {ITEMS_SQL} SELECT letter, canonical, verb_id, display FROM hits")
def _x20(spark, sf):
    return headwords.search_hits(listing(spark, sf))


WORDS_SQL = r"""words AS (SELECT DISTINCT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w FROM benchmark),
usable AS (SELECT * FROM hits WHERE canonical NOT IN (SELECT w FROM words WHERE length(w) IN (2, 3)) AND verb_id <> ''),
numbered AS (SELECT *, row_number() OVER (PARTITION BY letter, canonical ORDER BY verb_id) AS n,
  count(*) OVER (PARTITION BY letter, canonical) AS hits FROM usable),
forced AS (SELECT w FROM words WHERE length(w) = 4),
list AS (SELECT DISTINCT letter, canonical AS rank_verb, canonical AS verb, 'A8' || canonical AS verb_id FROM usable WHERE canonical IN (SELECT w FROM forced)
  UNION ALL SELECT letter, canonical, CASE WHEN hits = 1 THEN canonical ELSE canonical || '_' || n END, verb_id FROM numbered WHERE canonical NOT IN (SELECT w FROM forced))"""


def listed_headwords(spark, sf, id_prefix=""):
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", "[ \n]")).alias("verb")).distinct()
    exclude = words.where(F.length("verb").isin(2, 3))
    remap = words.where(F.length("verb") == 4).select("verb", F.concat(F.lit("A8"), "verb").alias("verb_id"))
    hits = headwords.search_hits(listing(spark, sf)).where("verb_id <> ''")
    return headwords.headword_list(hits, exclude, remap, id_prefix)


@query("p7_w1_j6_j7_headword_list", f"WITH {ITEMS_SQL}, {WORDS_SQL} SELECT * FROM list")
def _p7(spark, sf):
    return listed_headwords(spark, sf)


# The id filter on: a verb none of whose hits has the prefix is not listed, and a forced id does not bring it back.
PREFIXED_SQL = WORDS_SQL.replace("AND verb_id <> '')", "AND verb_id LIKE 't%')")


@query("t18_x21_headword_list_of_ids", f"WITH {ITEMS_SQL}, {PREFIXED_SQL} SELECT * FROM list")
def _t18(spark, sf):
    return listed_headwords(spark, sf, "t")


@query("k5_headword_lines", f"WITH {ITEMS_SQL}, {WORDS_SQL} SELECT verb || ':' || verb_id AS value FROM list")
def _k5(spark, sf):
    return sinks.headword_lines(listed_headwords(spark, sf))


# Search responses: every conversation turn is one response with two candidates.
CANDIDATES_SQL = """candidates AS (
  SELECT CAST(conv_id AS VARCHAR) AS verb, 0 AS pos, CASE role WHEN 'user' THEN 'v. tr.' ELSE 'v. Défectif' END AS nature,
    CASE WHEN length(text) % 3 = 0 THEN role ELSE conv_id || ' (se)' END AS label, '/c/' || turn || '/A' || turn AS url, turn FROM conversations
  UNION ALL SELECT CAST(conv_id AS VARCHAR), 1, 'n. m.', CAST(conv_id AS VARCHAR), '/n/' || turn, turn FROM conversations)"""


def candidates(spark, sf):
    turns = table(spark, sf, "conversations")
    verb, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    first = F.struct(
        F.when(F.col("role") == "user", "v. tr.").otherwise("v. Défectif").alias("nature"),
        F.when(F.length("text") % 3 == 0, F.col("role")).otherwise(F.concat(verb, F.lit(" (se)"))).alias("label"),
        F.concat(F.lit("/c/"), turn, F.lit("/A"), turn).alias("url"),
    )
    second = F.struct(F.lit("n. m.").alias("nature"), verb.alias("label"), F.concat(F.lit("/n/"), turn).alias("url"))
    responses = turns.select(verb.alias("verb"), "turn", F.to_json(F.struct(F.array(first, second).alias("result"))).alias("response"))
    parsed = files.search_candidates(responses.select("verb", "response"))
    return parsed.withColumn("turn", F.regexp_extract("url", r"^/./(\d+)", 1).cast("int")).withColumn("pos", F.col("turn") * 2 + F.col("pos")).drop("turn")


@query("s6_search_candidates", f"WITH {CANDIDATES_SQL} SELECT verb, turn * 2 + pos AS pos, nature, label, url FROM candidates")
def _s6(spark, sf):
    return candidates(spark, sf)


@query(
    "w3_resolved_entries",
    f"WITH {CANDIDATES_SQL} SELECT verb, string_split(arg_min(url, (nature LIKE '%fectif')::INT * 1000000 + turn * 2 + pos), '/')[-1] AS verb_id "
    "FROM candidates WHERE nature LIKE '%v.%' AND replace(label, ' (se)', '') = verb GROUP BY verb",
)
def _w3(spark, sf):
    return files.resolve_entries(candidates(spark, sf))


@query("s8_document_members", "SELECT CAST(event_id AS VARCHAR) AS verb, replace(props, ' ', '') AS entry FROM events")
def _s8(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("verb"), "props")
    store = events.select("verb", F.concat(F.lit('{"'), "verb", F.lit('":'), "props", F.lit("}")).alias("data"))
    return files.parse_document(sinks.document_lines(store).select(F.col("line").alias("value")))


# Text rules


@query(
    "x17_reform_spelling",
    with_star("SELECT infinitif, infinitif LIKE '%î%' OR infinitif LIKE '%û%' AS respelled, CASE WHEN infinitif LIKE '%î%' OR infinitif LIKE '%û%' "
              "THEN translate(infinitif, 'îû', 'iu') END AS spelling FROM verbes"),
)
def _x17(spark, sf):
    verb = F.col("infinitif")
    return verbes(spark, sf).select(verb, t.has_reform_spelling(verb).alias("respelled"), t.reform_spelling(verb).alias("spelling"))


@query(
    "x17_respelled_words",
    "SELECT w AS word, translate(w, 'ê', 'e') AS spelling, count(*) AS n FROM (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w FROM documents) "
    "WHERE w LIKE '%ê%' GROUP BY 1, 2",
)
def _x17_words(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split("text", "[ \n]")).alias("word"))
    spelled = words.select("word", t.reform_spelling(F.col("word"), "ê", "e").alias("spelling")).where("spelling IS NOT NULL")
    return spelled.groupBy("word", "spelling").agg(F.count("*").alias("n"))


@query(
    "x11_x18_alternatives",
    with_star("SELECT verbe_id, voix, mode, temps, personne, replace(conjugaison, 'a;b', 'b;a') AS reversed, replace(replace(conjugaison, ';', ','), ',', ';') AS packed FROM conjugaisons"),
)
def _x18(spark, sf):
    form = F.col("conjugaison")
    return conjugaisons(spark, sf).select(
        *KEYS, "personne", t.reverse_alternatives(form).alias("reversed"), t.pack_alternatives(F.translate(form, ";", ",")).alias("packed")
    )


@query("x19_apostrophes", "SELECT doc_id, replace(replace(text, '''', '’'), '’', '''') AS text FROM documents")
def _x19(spark, sf):
    return table(spark, sf, "documents").select("doc_id", t.plain_apostrophe(F.translate("text", "'", "’")).alias("text"))


@query("h7_squeezed_text", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def _h7(spark, sf):
    return table(spark, sf, "documents").select("doc_id", t.squeeze(F.col("text")).alias("text"))


ARTICLE = "regexp_extract(html, '<article>(.*?)</article>', 1, 's')"


@query(
    "h7_h9_article_text",
    "SELECT page_id, words AS text, words LIKE '%the%' AS has_the FROM (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace("
    + f"regexp_replace({ARTICLE}, '<[^>]*>', '', 'g')"
    + r", '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&quot;', chr(34)), '&amp;', '&'), '[\s' || chr(160) || ']+', ' ', 'g')) AS words FROM pages WHERE html LIKE '%<article>%')",
)
def _article(spark, sf):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = table(spark, sf, "pages").select("page_id", "html").repartition(tasks, "page_id")
    nodes = pages.withColumn("nodes", extract.page_nodes("html", "text", "blocks"))
    article = F.get(F.filter("nodes.blocks", lambda b: b["tag"] == "article"), 0)
    blocks = nodes.select("page_id", F.col("nodes.text").alias("all_text"), article.alias("b")).where("b IS NOT NULL")
    text = t.squeeze(F.substring("all_text", F.col("b.text_start") + 1, F.col("b.text_end") - F.col("b.text_start")))
    return blocks.select("page_id", text.alias("text")).withColumn("has_the", F.col("text").contains("the"))


@query(
    "x22_base_names",
    "SELECT key, CASE WHEN regexp_matches(key, '_[0-9]+$') THEN regexp_replace(key, '_[0-9]+$', '') END AS base FROM "
    "(SELECT replace(p_name, ' ', '_') || CASE WHEN p_size % 2 = 0 THEN '_' || p_partkey ELSE '' END AS key FROM part)",
)
def _x22(spark, sf):
    parts = table(spark, sf, "part")
    key = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("_"), F.col("p_partkey").cast("string"))).otherwise(""))
    return parts.select(key.alias("key")).withColumn("base", t.base_name(F.col("key")))


LABEL = " ".join(f"WHEN '{p}' THEN '{label}'" for p, label in [("1sm", "je (m)"), ("1sf", "je (f)"), ("3sm", "il"), ("3sf", "elle"), ("3sn", "on"), ("1pm", "nous (m)"), ("1pf", "nous (f)")])


@query(
    "x25_x30_person_labels",
    with_star(
        "SELECT verbe_id, voix, mode, temps, personne, string_agg(label, ', ' ORDER BY i) AS label FROM (SELECT verbe_id, voix, mode, temps, personne, "
        f"generate_subscripts(string_split(personne, ';'), 1) AS i, CASE unnest(string_split(personne, ';')) {LABEL} END AS label FROM conjugaisons) GROUP BY ALL".replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4, 5")
    ),
)
def _x30(spark, sf):
    return conjugaisons(spark, sf).select(*KEYS, "personne", t.person_label(F.col("personne")).alias("label"))


@query("x26_like_ignoring_case", "SELECT doc_id FROM documents WHERE translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') LIKE 'le%on%'")
def _x26(spark, sf):
    return table(spark, sf, "documents").where(t.like(F.col("text"), "Le%ON%", ci=True)).select("doc_id")


@query(
    "x27_stems",
    with_star("SELECT infinitif, substr(infinitif, 1, greatest(length(infinitif) - 2, 0)) AS stem, substr(substr(infinitif, 1, 2), 1, 0) AS nothing FROM verbes"),
)
def _x27(spark, sf):
    verb = F.col("infinitif")
    return verbes(spark, sf).select(verb, t.drop_last(verb, 2).alias("stem"), t.drop_last(verb.substr(1, 2), 3).alias("nothing"))


@query(
    "x29_unit_keys",
    with_star("SELECT DISTINCT infinitif || '|' || voix || '|' || mode || '|' || temps AS key FROM conjugaisons JOIN verbes ON id = verbe_id"),
)
def _x29(spark, sf):
    s = star(spark, sf)
    units = s.conjugaisons.select(*KEYS).distinct().join(s.verbes.select(F.col("id").alias("verbe_id"), "infinitif"), "verbe_id")
    return units.select(t.unit_key(*[F.col(c) for c in ("infinitif", "voix", "mode", "temps")]).alias("key"))


# Merging and aggregation


@query("a1_merged_persons", with_star("SELECT verbe_id, voix, mode, temps, personne, conjugaison FROM conjugaisons"))
def _a1(spark, sf):
    return conjugaisons(spark, sf)


@query(
    "a2_persons_covered",
    with_star("SELECT verbe_id, voix, mode, temps, string_agg(personne, ',' ORDER BY personne) AS persons FROM atomic GROUP BY 1, 2, 3, 4"),
)
def _a2(spark, sf):
    covered = merging.persons_covered(conjugaisons(spark, sf), KEYS)
    return covered.withColumn("persons", F.array_join("persons", ","))


@query("a7_verb_ids", with_star("SELECT infinitif, row_number() OVER (ORDER BY infinitif) AS id FROM verbes"))
def _a7(spark, sf):
    return number_rows(verbes(spark, sf).select("infinitif"), ["infinitif"], "id")


LATEST = "SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, max(ts) AS ts FROM events GROUP BY 1, 2"


@query("a8_w2_latest_rows", LATEST)
def _a8(spark, sf):
    return merging.latest_per_key(table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], "ts", "event_id")


@query("a11_distinct_forms", with_star("SELECT DISTINCT conjugaison, voix FROM conjugaisons"))
def _a11(spark, sf):
    return conjugaisons(spark, sf).select("conjugaison", "voix").distinct()


@query(
    "k1_upserted_store",
    "SELECT CAST(user_id AS VARCHAR) AS verb, coalesce(max(props) FILTER (event_type = 'purchase'), max(props) FILTER (event_type = 'view')) AS data "
    "FROM events WHERE event_type IN ('purchase', 'view') GROUP BY 1",
)
def _k1(spark, sf):
    events = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("verb"), F.col("props").alias("data"), "event_type")
    return sinks.upsert_store(events.where("event_type = 'view'"), events.where("event_type = 'purchase'"))


# A store of all views by user, then the purchases of one user put into it: only that user's bucket has new files.
LAST_USER = "(SELECT CAST(max(user_id) AS VARCHAR) FROM events WHERE event_type = 'purchase')"


@query(
    "k1_written_buckets",
    "SELECT verb, coalesce(bought, viewed) AS data, substr(md5(verb), 1, 2) = substr(md5(last), 1, 2) AS rewritten FROM ("
    f"SELECT CAST(user_id AS VARCHAR) AS verb, max(props) FILTER (event_type = 'view') AS viewed, {LAST_USER} AS last, "
    f"max(props) FILTER (event_type = 'purchase' AND CAST(user_id AS VARCHAR) = {LAST_USER}) AS bought FROM events GROUP BY 1) "
    "WHERE viewed IS NOT NULL OR bought IS NOT NULL",
)
def _k1_buckets(spark, sf):
    events = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("verb"), "user_id", F.col("props").alias("data"), "event_type")
    path = f"{new_folder(spark)}/store"

    def with_files():
        return spark.read.schema(files.STORE_TYPE).parquet(path).select("verb", "data", F.col("_metadata.file_path").alias("file"))

    sinks.write_store(sinks.upsert_store(events.where("false"), events.where("event_type = 'view'")), path)
    before = durable(with_files().select("verb", F.col("file").alias("old")))
    bought = events.where("event_type = 'purchase'")
    sinks.upsert_into(spark, path, bought.where(F.col("user_id") == bought.agg(F.max("user_id")).scalar()))
    rewritten = ~F.coalesce(F.col("file") == F.col("old"), F.lit(False))
    return with_files().join(before, "verb", "left").select("verb", "data", rewritten.alias("rewritten"))


@query("s7_stored_records", "SELECT CAST(user_id AS VARCHAR) AS verb, max(props) AS data FROM events GROUP BY 1")
def _s7(spark, sf):
    events = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("verb"), F.col("props").alias("data"))
    return files.read_store(spark, f"{written(sinks.upsert_store(events.where('false'), events))}/store")


@query("s10_star_in_sql", with_star("SELECT voix, mode, count(DISTINCT infinitif) AS verbs FROM conjugaisons JOIN verbes ON id = verbe_id GROUP BY 1, 2"))
def _s10(spark, sf):
    path = new_folder(spark)
    st.write_star(star(spark, sf), path)
    st.read_star(spark, path).register()
    return spark.sql("SELECT voix, mode, count(DISTINCT infinitif) AS verbs FROM conjugaisons JOIN verbes ON verbes.id = verbe_id GROUP BY 1, 2")


@query("k4_written_star", with_star("SELECT mode, count(*) AS conjugation_count FROM conjugaisons GROUP BY mode"))
def _k4(spark, sf):
    path = new_folder(spark)
    st.write_star(star(spark, sf), path)
    return lookups.forms_per_mood(st.read_star(spark, path))


# A star whose forms are not merged and whose verbs are not all there is refused, and the one before it stays.
@query(
    "k4_refused_star",
    with_star(
        "SELECT 'conjugaisons' AS relation, 'unique key' AS rule, concat_ws('|', verbe_id, voix, mode, temps, personne) AS key, count(*) AS n FROM raw GROUP BY verbe_id, voix, mode, temps, personne HAVING count(*) > 1 "
        "UNION ALL SELECT 'conjugaisons', 'reference', CAST(verbe_id AS VARCHAR), count(*) FROM raw WHERE verbe_id NOT IN (SELECT id FROM verbes WHERE NOT rectification_1990) GROUP BY verbe_id "
        "UNION ALL SELECT 'participes', 'reference', CAST(verbe_id AS VARCHAR), count(*) FROM participes WHERE verbe_id NOT IN (SELECT id FROM verbes WHERE NOT rectification_1990) GROUP BY verbe_id "
        "UNION ALL SELECT 'the star before', 'kept', mode, count(*) FROM conjugaisons GROUP BY mode",
        f"raw AS (SELECT DISTINCT l_partkey AS verbe_id, {VOIX} AS voix, {MODE} AS mode, {TEMPS} AS temps, {PERSONNE} AS personne, {CONJUGAISON} AS conjugaison FROM lineitem)",
    ),
)
def _k4_refused(spark, sf):
    path, whole = new_folder(spark), star(spark, sf)
    st.write_star(whole, path)
    raw = atomic_lines(spark, sf).distinct().select(*KEYS, F.col("person").alias("personne"), F.col("form").alias("conjugaison"))
    try:
        st.write_star(lookups.Star(whole.verbes.where("NOT rectification_1990"), raw, whole.participes), path)
    except st.StarRefused as refused:
        found = spark.read.parquet(refused.violations)
    kept = lookups.forms_per_mood(st.read_star(spark, path))
    return found.unionByName(kept.select(F.lit("the star before").alias("relation"), F.lit("kept").alias("rule"), F.col("mode").alias("key"), F.col("conjugation_count").alias("n")))


# Joins


@query("j5_pending", "SELECT doc_id AS verb FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _j5(spark, sf):
    return headwords.pending(
        table(spark, sf, "documents").select(F.col("doc_id").alias("verb")), table(spark, sf, "labels").select(F.col("doc_id").alias("verb"))
    )


TWINS = """twins AS (SELECT infinitif, h_aspire, rectification_1990, rectification_1990_variante FROM verbes UNION ALL
  SELECT rectification_1990_variante, h_aspire, true, infinitif FROM verbes WHERE rectification_1990)"""


def twinned(spark, sf):
    """Verbs with their reform twins, and the twinned long rows."""
    s = star(spark, sf)
    verbs = s.verbes.select(F.col("infinitif").alias("verb"), "h_aspire", "rectification_1990", "rectification_1990_variante")
    named = s.conjugaisons.join(s.verbes.select(F.col("id").alias("verbe_id"), F.col("infinitif").alias("verb")), "verbe_id")
    rows = named.select("verb", F.col("voix").alias("voice"), F.col("mode").alias("mood"), F.col("temps").alias("tense"), "personne", "conjugaison")
    return reform.with_reform_twins(verbs, rows)


@query("o5_reform_twins", with_star("SELECT infinitif AS verb, h_aspire, rectification_1990, rectification_1990_variante FROM twins", TWINS))
def _o5(spark, sf):
    return twinned(spark, sf)[0]


@query(
    "o5_forms_of_twins",
    with_star(
        "SELECT infinitif AS verb, voix AS voice, mode AS mood, temps AS tense, personne, conjugaison FROM conjugaisons JOIN verbes ON id = verbe_id UNION ALL "
        "SELECT rectification_1990_variante, voix, mode, temps, personne, replace(conjugaison, 'a;b', 'b;a') FROM conjugaisons JOIN verbes ON id = verbe_id WHERE rectification_1990"
    ),
)
def _o5_rows(spark, sf):
    return twinned(spark, sf)[1]


@query(
    "j11_pairs_of_twins",
    with_star("SELECT infinitif, rectification_1990_variante FROM twins WHERE rectification_1990 AND infinitif < rectification_1990_variante", TWINS),
)
def _j11(spark, sf):
    names = twinned(spark, sf)[0].withColumnRenamed("verb", "infinitif")
    return lookups.reform_variants(lookups.Star(names, None, None), unique=True)


@query("v11_repeated_keys", with_star("SELECT verbe_id, voix, conjugaison, count(*) AS n FROM conjugaisons GROUP BY 1, 2, 3 HAVING count(*) > 1"))
def _v11(spark, sf):
    return st.repeated_keys(conjugaisons(spark, sf), ["verbe_id", "voix", "conjugaison"])


@query("v11_unique_keys", with_star("SELECT verbe_id, voix, mode, temps, personne, count(*) AS n FROM conjugaisons GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1"))
def _v11_none(spark, sf):
    return st.repeated_keys(conjugaisons(spark, sf), st.CONJUGAISONS_KEY)


@query(
    "v12_orphans",
    with_star("SELECT verbe_id, voix, mode, temps, personne, conjugaison FROM conjugaisons WHERE verbe_id NOT IN (SELECT id FROM verbes WHERE rectification_1990)"),
)
def _v12(spark, sf):
    s = star(spark, sf)
    return st.orphans(s.conjugaisons, s.verbes.where("rectification_1990")).select(*KEYS, "personne", "conjugaison")


@query("t12_dangling_variants", with_star("SELECT infinitif, rectification_1990_variante FROM verbes WHERE rectification_1990"))
def _t12(spark, sf):
    return st.dangling_variants(verbes(spark, sf))


@query("v14_invalid_records", "SELECT doc_id AS verb FROM documents WHERE NOT json_valid(text)")
def _v14(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("verb"), F.col("text").alias("data"))
    return invalid_records(docs).select("verb")


# Pages


@query("k8_shrunk_pages", stated("SELECT infinitif AS verb, true AS same FROM verbes WHERE id IN (SELECT verbe_id FROM voices)"))
def _k8(spark, sf):
    pages = conjugation_pages(spark, sf)
    whole = pages.select("verb", "verb_id", F.struct("html").alias("kept"), "html")
    before, after = len('<!DOCTYPE html><html><body><div id="menu"></div>'), len("</body></html>")
    shrunk = extract.shrunk_pages(whole.select("verb_id", "html", F.col("kept.html").alias("verb")))
    cut = F.substring("verb", F.lit(before + 1), F.length("verb") - before - after)
    name = F.regexp_extract("html", '^<div id="A9P([0-9]+)"', 1).cast("long").alias("id")
    return shrunk.select(name, (F.col("html") == cut).alias("same")).join(verbes(spark, sf).select("id", F.col("infinitif").alias("verb")), "id").select("verb", "same")


@query(
    "h10_h11_evidence",
    stated(
        "SELECT infinitif AS verb, infinitif AS page_verb, voix AS voice, mood, tense, starts FROM ("
        "SELECT DISTINCT verbe_id, voix, mode AS mood, TENSE AS tense, '<div class=\"tense\"><h4 class=\"relation\">' AS starts FROM cells UNION ALL "
        "SELECT verbe_id, voix, 'imperatif', 'present', '<div class=\"tense\"><h4 class=\"relation\">' FROM voices UNION ALL "
        "SELECT verbe_id, voix, 'participe', 'participe', '<div class=\"grid\">' FROM voices) JOIN verbes ON id = verbe_id".replace(
            "TENSE AS", "CASE title WHEN 'présent' THEN 'present' WHEN 'imparfait' THEN 'imparfait' ELSE 'passe_compose' END AS"
        )
    ),
)
def _h10(spark, sf):
    names = verbes(spark, sf).select("id", F.col("infinitif").alias("verb"))
    lines = table(spark, sf, "lineitem").selectExpr("l_partkey AS id", f"{VOIX} AS voice", f"{MODE} AS mood", f"{PAGE_TENSE} AS title").distinct()
    tense = F.when(F.col("title") == "présent", "present").when(F.col("title") == "imparfait", "imparfait").otherwise("passe_compose")
    finite = lines.select("id", "voice", "mood", tense.alias("tense"))
    voices = lines.select("id", "voice").distinct()
    parts = (
        finite.unionByName(voices.select("*", F.lit("imperatif").alias("mood"), F.lit("present").alias("tense")))
        .unionByName(voices.select("*", F.lit("participe").alias("mood"), F.lit("participe").alias("tense")))
        .join(names, "id")
        .select("verb", "voice", "mood", "tense")
    )
    pages = conjugation_pages(spark, sf)
    verbs = names.select("verb", F.lit(None).cast("string").alias("rectification_1990_variante"))
    rows = audit.evidence(parts, verbs, pages)
    return rows.select("verb", "page_verb", "voice", "mood", "tense", F.regexp_extract("block", '^<div class="(grid">|tense"><h4 class="relation">)', 0).alias("starts"))
