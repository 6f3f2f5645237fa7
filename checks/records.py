"""Registered checks of documents, homonyms, the star build and the audit over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.registry import query, table
from checks.rules import TWINS, twinned
from checks.star import VOIX, conjugaisons, participes, smallest, star, verbes, with_star
from inflecta.operators import audit as a
from inflecta.operators import documents as d
from inflecta.operators import homonyms as h
from inflecta.operators import star as st
from inflecta.operators.numbering import number_rows
from inflecta.session import durable
from inflecta.sources import files, sinks

# Documents: the star as nested entries, and back.


def document_parts(spark, sf):
    """Verbs and long rows of the star."""
    s = star(spark, sf)
    names = s.verbes.select(F.col("id").alias("verbe_id"), F.col("infinitif").alias("verb"))
    finite = s.conjugaisons.join(names, "verbe_id").select(
        "verb", F.col("voix").alias("voice"), F.col("mode").alias("mood"), F.col("temps").alias("tense"), "personne", "conjugaison"
    )
    simple = d.rows_of_participles(s.participes.withColumnRenamed("voix", "voice").join(names, "verbe_id"))
    verbs = s.verbes.select(F.col("infinitif").alias("verb"), "h_aspire", "rectification_1990", "rectification_1990_variante")
    return verbs, finite.unionByName(simple)


def entries_sql(indent: int = 0) -> str:
    """SQL for the text of nested entries: string aggregation level by level."""

    def obj(members: str, depth: int) -> str:
        if not indent:
            return f"'{{' || {members} || '}}'"
        inner = f"chr(10) || repeat(' ', {indent * (depth + 1)})"
        outer = f"chr(10) || repeat(' ', {indent * depth})"
        return f"'{{' || {inner} || {members} || {outer} || '}}'"

    def agg(member: str, depth: int, order: str) -> str:
        comma = "','" if not indent else f"',' || chr(10) || repeat(' ', {indent * (depth + 1)})"
        return obj(f"string_agg({member}, {comma} ORDER BY {order})", depth)

    colon = ":" if not indent else ": "
    comma2 = "','" if not indent else f"',' || chr(10) || repeat(' ', {indent})"
    comma3 = "','" if not indent else f"',' || chr(10) || repeat(' ', {indent * 3})"
    person = "CASE split_part(personne, ';', 1) WHEN '1sm' THEN 0 WHEN '1sf' THEN 1 WHEN '3sm' THEN 4 WHEN '3sf' THEN 5 WHEN '3sn' THEN 6 WHEN '1pm' THEN 7 ELSE 8 END"
    return with_star(
        "SELECT infinitif AS verb, "
        + obj(
            f"""'"rectification_1990"{colon}' || rectification_1990 || {comma2} || '"rectification_1990_variante"{colon}' ||
            coalesce('"' || rectification_1990_variante || '"', 'null') || {comma2} || '"h_aspire"{colon}' || h_aspire || coalesce({comma2} || voices, '')""",
            0,
        )
        + " AS entry FROM verbes LEFT JOIN bodies ON id = verbe_id",
        f"""tense_texts AS (SELECT verbe_id, voix, mode, temps, {agg(f"'" + '"' + f"' || personne || '" + '"' + f"{colon}" + '"' + "' || conjugaison || '" + '"' + "'", 3, person)} AS body FROM conjugaisons GROUP BY 1, 2, 3, 4),
mood_texts AS (SELECT verbe_id, voix, mode, {agg(f"'" + '"' + f"' || temps || '" + '"' + f"{colon}' || body", 2, "CASE temps WHEN 'present' THEN 0 WHEN 'imparfait' THEN 1 ELSE 2 END")} AS body FROM tense_texts GROUP BY 1, 2, 3),
past_texts AS (SELECT verbe_id, voix, {agg(f"'" + '"' + f"' || substr(forme, 7) || '" + '"' + f"{colon}" + '"' + "' || participe || '" + '"' + "'", 3, "CASE forme WHEN 'passe_sm' THEN 0 WHEN 'passe_sf' THEN 1 WHEN 'passe_pm' THEN 2 ELSE 3 END")} AS body FROM participes GROUP BY 1, 2),
all_moods AS (SELECT * FROM mood_texts UNION ALL SELECT verbe_id, voix, 'participe', {obj(f"'" + '"present"' + colon + f"null' || {comma3} || '" + '"passe"' + colon + "' || body", 2)} FROM past_texts),
voice_texts AS (SELECT verbe_id, voix, {agg(f"'" + '"' + f"' || mode || '" + '"' + f"{colon}' || body", 1, "CASE mode WHEN 'participe' THEN 0 WHEN 'indicatif' THEN 1 ELSE 2 END")} AS body FROM all_moods GROUP BY 1, 2),
bodies AS (SELECT verbe_id, string_agg('"' || voix || '"{colon}' || body, {comma2} ORDER BY CASE voix WHEN 'voix_active_avoir' THEN 0 WHEN 'voix_active_etre' THEN 1 WHEN 'voix_passive' THEN 2 ELSE 3 END) AS voices FROM voice_texts GROUP BY 1)""",
    )


@query("p3_k2_nested_entries", entries_sql())
def _p3(spark, sf):
    return d.nested_entries(*document_parts(spark, sf))


@query("k3_indented_entries", entries_sql(4))
def _k3(spark, sf):
    return d.nested_entries(*document_parts(spark, sf), indent=4)


def parsed(spark, sf):
    store = d.store_records(d.nested_entries(*document_parts(spark, sf)))
    return d.parsed_entries(d.entries_of_store(store))


# Tenses without a form are stated too: an imperative of some verbs, and the present participle that no verb has here.
@query("p2_long_rows_of_entries", with_star(
    "SELECT infinitif AS verb, voix AS voice, mode AS mood, temps AS tense, personne, conjugaison FROM conjugaisons JOIN verbes ON id = verbe_id UNION ALL "
    "SELECT infinitif, voix, 'participe', 'passe', substr(forme, 7), participe FROM participes JOIN verbes ON id = verbe_id UNION ALL "
    "SELECT DISTINCT infinitif, voix, 'participe', 'present', NULL, NULL FROM participes JOIN verbes ON id = verbe_id UNION ALL "
    "SELECT infinitif, 'voix_prono', 'imperatif', 'present', NULL, NULL FROM verbes WHERE rectification_1990"
))
def _p2(spark, sf):
    verbs, rows = document_parts(spark, sf)
    empty = verbs.where("rectification_1990").selectExpr(
        "verb", "'voix_prono' AS voice", "'imperatif' AS mood", "'present' AS tense", "CAST(NULL AS STRING) AS personne", "CAST(NULL AS STRING) AS conjugaison"
    )
    store = d.store_records(d.nested_entries(verbs, rows.unionByName(empty)))
    return d.rows_of_entries(d.parsed_entries(d.entries_of_store(store)))


@query("k2_document_lines", f"""SELECT verb, CASE WHEN verb = min(verb) OVER () THEN '{{' ELSE '' END || '"' || verb || '":' || entry
    || CASE WHEN verb = max(verb) OVER () THEN '}}' ELSE ',' END AS line FROM ({entries_sql()})""")
def _k2(spark, sf):
    return sinks.document_lines(durable(d.store_records(d.nested_entries(*document_parts(spark, sf)))))


@query("p4_verbes", with_star("SELECT row_number() OVER (ORDER BY infinitif) AS id, infinitif, h_aspire, rectification_1990, rectification_1990_variante FROM verbes"))
def _p4(spark, sf):
    return st.build_verbes(d.verbs_of_entries(parsed(spark, sf)))


RENUMBERED = "ids AS (SELECT id AS old_id, row_number() OVER (ORDER BY infinitif) AS new_id FROM verbes)"


@query("p5_conjugaisons", with_star("SELECT new_id AS verbe_id, voix, mode, temps, personne, conjugaison FROM conjugaisons JOIN ids ON old_id = verbe_id", RENUMBERED))
def _p5(spark, sf):
    verbs, rows = document_parts(spark, sf)
    return st.build_conjugaisons(rows, st.build_verbes(verbs))


@query("p6_participes", with_star("SELECT new_id AS verbe_id, voix, forme, participe FROM participes JOIN ids ON old_id = verbe_id", RENUMBERED))
def _p6(spark, sf):
    verbs, rows = document_parts(spark, sf)
    return st.build_participes(rows, st.build_verbes(verbs))


@query("x31_participle_keys", with_star("SELECT infinitif AS verb, voix AS voice, 'passe.' || substr(forme, 7) AS key, participe AS value FROM participes JOIN verbes ON id = verbe_id"))
def _x31(spark, sf):
    return a.participle_keys(document_parts(spark, sf)[1])


# Homonyms: parts of one name are homonyms, their voices the smallest form per voice.

MEMBERS_SQL = """contents AS (SELECT verbe_id, voix, min(conjugaison) AS form FROM conjugaisons GROUP BY 1, 2),
keys AS (SELECT p_partkey, replace(p_name, ' ', '') AS base, replace(p_name, ' ', '') || '_' || row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS key FROM part),
members AS (SELECT base, key, coalesce(list(voix || '=' || form ORDER BY voix) FILTER (voix IS NOT NULL), []) AS voices,
  row_number() OVER (PARTITION BY base ORDER BY key) AS rn, count(*) OVER (PARTITION BY base) AS n
  FROM keys LEFT JOIN contents ON verbe_id = p_partkey GROUP BY base, key)"""


def homonym_parts(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("")).alias("base"))
    numbered = number_rows(parts, ["p_partkey"], "n", within=["base"])
    keys = numbered.select("p_partkey", F.concat_ws("_", "base", F.col("n").cast("string")).alias("verb"))
    contents = conjugaisons(spark, sf).groupBy("verbe_id", F.col("voix").alias("voice")).agg(F.min("conjugaison").alias("conjugaison"))
    rows = contents.join(keys.select(F.col("p_partkey").alias("verbe_id"), "verb"), "verbe_id").select(
        "verb", "voice", F.lit("indicatif").alias("mood"), F.lit("present").alias("tense"), F.lit("1sm").alias("personne"), "conjugaison"
    )
    return keys.select("verb"), rows


FOLD_SQL = "WITH RECURSIVE " + with_star("", MEMBERS_SQL).removeprefix("WITH ").rstrip() + """,
fold AS (SELECT base, 0::BIGINT AS rn, []::STRUCT(key VARCHAR, voices VARCHAR[])[] AS clusters FROM members WHERE rn = 1
  UNION ALL SELECT base, rn, CASE WHEN pos IS NULL OR pos = 0 THEN list_append(clusters, m) WHEN list_has_all(clusters[pos].voices, m.voices) THEN clusters
    ELSE list_concat(list_append(clusters[1:pos - 1], m), clusters[pos + 1:]) END
  FROM (SELECT f.base, s.rn, f.clusters, struct_pack(key := s.key, voices := s.voices) AS m,
    list_position([list_has_all(c.voices, s.voices) OR list_has_all(s.voices, c.voices) FOR c IN f.clusters], true) AS pos
    FROM fold f JOIN members s ON s.base = f.base AND s.rn = f.rn + 1)),
final AS (SELECT f.base, f.clusters, m.n FROM fold f JOIN members m ON m.base = f.base AND m.rn = m.n AND f.rn = m.n)
SELECT clusters[i].key AS verb, CASE WHEN n = 1 THEN clusters[i].key WHEN len(clusters) = 1 THEN base ELSE base || '_' || i END AS name
FROM (SELECT *, unnest(range(1, len(clusters) + 1)) AS i FROM final)"""


@query("a5_w5_o6_merged_homonyms", FOLD_SQL)
def _a5(spark, sf):
    verbs, rows = homonym_parts(spark, sf)
    return h.homonym_names(verbs, h.members_of(verbs, rows))


@query(
    "x23_x24_contained_entries",
    with_star(
        "SELECT DISTINCT x.base, x.key AS inner_key, y.key AS outer_key FROM firsts x JOIN firsts y ON x.base = y.base AND x.key <> y.key AND list_has_all(y.voices, x.voices)",
        MEMBERS_SQL + ", firsts AS (SELECT base, voices, min(key) AS key FROM members GROUP BY 1, 2)",
    ),
)
def _x24(spark, sf):
    verbs, rows = homonym_parts(spark, sf)
    distinct = h.members_of(verbs, rows).groupBy("base", "voices").agg(F.min("verb").alias("verb"))
    return h.containment_links(distinct).select("base", F.col("inner").alias("inner_key"), F.col("outer").alias("outer_key"))


# Audit: one present tense per verb, voice and mood, all pronouns.

PRONOUN_PERSONS = {1: "1sm;1sf", 2: "2sm;2sf", 3: "3sm;3sf", 4: "3sn", 5: "1pm;1pf", 6: "2pm;2pf", 7: "3pm;3pf"}
NUMBERED = " ".join(f"WHEN {n} THEN '{p}'" for n, p in PRONOUN_PERSONS.items())
AUDIT_FORM = "CASE WHEN l_tax = 0.0 AND l_discount = 0.0 THEN 'a;b' WHEN l_tax = 0.08 AND l_discount = 0.0 THEN ' ' ELSE 'parle' END"
AUDIT_MOOD = "CASE l_linestatus WHEN 'F' THEN 'indicatif' ELSE 'imperatif' END"
AUDIT_SQL = f"""audit_rows AS (SELECT infinitif AS verb, {VOIX} AS voice, {AUDIT_MOOD} AS mood, 'present' AS tense,
  CASE l_linenumber {NUMBERED} END AS personne, min({AUDIT_FORM}) AS conjugaison FROM lineitem JOIN verbes ON id = l_partkey GROUP BY ALL
  UNION ALL SELECT rectification_1990_variante, 'voix_passive', 'indicatif', 'present', '1sm', 'x' FROM verbes WHERE rectification_1990
  UNION ALL SELECT infinitif, 'voix_prono', 'subjonctif', 'imparfait', NULL, NULL FROM verbes WHERE rectification_1990
  UNION ALL SELECT infinitif, voix, 'participe', 'participe', substr(forme, 7), participe FROM participes JOIN verbes ON id = verbe_id),
audit_pages AS (SELECT DISTINCT infinitif AS verb FROM lineitem JOIN verbes ON id = l_partkey WHERE l_tax = 0.03 AND l_discount <> 0.03),
audit_log AS (SELECT infinitif AS verb, {VOIX} AS voice, {AUDIT_MOOD} AS mood, 'present' AS tense,
  CASE min(l_linenumber) WHEN 1 THEN 'flagged' WHEN 2 THEN 'skipped' ELSE 'ok' END AS status, 'me' AS auditor, CAST(max(l_orderkey) AS VARCHAR) AS ts,
  string_agg(DISTINCT l_linenumber::VARCHAR, '; ' ORDER BY l_linenumber::VARCHAR) AS flagged_persons, 'n' || min(l_linenumber) AS note
  FROM lineitem JOIN verbes ON id = l_partkey WHERE l_tax = 0.05 AND l_discount = 0.1 GROUP BY 1, 2, 3),
facts AS (SELECT verb, voice, mood, tense, bool_or(conjugaison LIKE '%;%') AS alternatives, min(CASE WHEN trim(conjugaison) = '' THEN
    CASE split_part(personne, ';', 1) WHEN '1sm' THEN 0 WHEN '2sm' THEN 2 WHEN '3sm' THEN 4 WHEN '3sn' THEN 6 WHEN '1pm' THEN 7 WHEN '2pm' THEN 9 ELSE 11 END END) AS blank,
  string_agg(personne, ';') AS persons, count(personne) AS forms FROM audit_rows GROUP BY 1, 2, 3, 4),
status AS (SELECT infinitif AS verb, coalesce(rectification_1990_variante LIKE '%î%' AND infinitif NOT LIKE '%î%', false) AS twin,
  infinitif IN (SELECT verb FROM audit_pages) OR coalesce(rectification_1990_variante IN (SELECT verb FROM audit_pages), false) AS has_page FROM twins),
classified AS (SELECT f.verb, f.voice, f.mood, f.tense, CASE WHEN l.verb IS NOT NULL THEN 'already audited' WHEN twin THEN 'reform variant entry' WHEN NOT has_page THEN 'no cached HTML'
  WHEN f.mood = 'participe' THEN 'participe (complex gender)' WHEN forms = 0 THEN 'empty tense (defective verb)' WHEN alternatives THEN 'alternative forms present'
  WHEN blank IS NOT NULL THEN 'empty form value for ' || CASE blank WHEN 0 THEN '1sm;1sf' WHEN 2 THEN '2sm;2sf' WHEN 4 THEN '3sm;3sf' WHEN 6 THEN '3sn' WHEN 7 THEN '1pm;1pf' WHEN 9 THEN '2pm;2pf' ELSE '3pm;3pf' END
  WHEN f.mood = 'imperatif' AND NOT list_has_all(string_split(persons, ';'), ['2sm','1pm','2pm']) THEN 'missing imperative persons'
  WHEN f.mood <> 'imperatif' AND NOT list_has_all(string_split(persons, ';'), CASE WHEN persons LIKE '%3sn%' THEN ['1pm','2pm','3pm'] ELSE ['1sm','2sm','3sm','1pm','2pm','3pm'] END) THEN 'missing person keys'
  ELSE '' END AS reason FROM facts f JOIN status s ON s.verb = f.verb LEFT JOIN audit_log l ON l.verb = f.verb AND l.voice = f.voice AND l.mood = f.mood AND l.tense = f.tense)"""
AUDIT = f"{TWINS}, {AUDIT_SQL}"


def over_audit(sql: str) -> str:
    return with_star(sql, AUDIT)


def audit_tables(spark, sf):
    """Verbs with twins, long rows, page names and log records."""
    s = star(spark, sf)
    names = s.verbes.select(F.col("id"), F.col("infinitif").alias("verb"))
    raw = table(spark, sf, "lineitem")
    person = F.create_map(*[F.lit(x) for pair in PRONOUN_PERSONS.items() for x in pair])[F.col("l_linenumber")]
    keyed = raw.select(
        F.col("l_partkey").alias("id"), F.expr(VOIX).alias("voice"), F.expr(AUDIT_MOOD).alias("mood"), F.lit("present").alias("tense"),
        person.alias("personne"), F.expr(AUDIT_FORM).alias("form"), "l_tax", "l_discount", "l_linenumber", "l_orderkey",
    )
    forms = keyed.groupBy("id", "voice", "mood", "tense", "personne").agg(smallest([" ", "a;b", "parle"], "form").alias("conjugaison")).join(names, "id").select(*d.COLUMNS)
    verbs, _ = twinned(spark, sf)
    respelled = s.verbes.where("rectification_1990").select(
        F.col("rectification_1990_variante").alias("verb"), F.lit("voix_passive").alias("voice"), F.lit("indicatif").alias("mood"),
        F.lit("present").alias("tense"), F.lit("1sm").alias("personne"), F.lit("x").alias("conjugaison"),
    )
    none = F.lit(None).cast("string")
    empty = s.verbes.where("rectification_1990").select(
        F.col("infinitif").alias("verb"), F.lit("voix_prono").alias("voice"), F.lit("subjonctif").alias("mood"), F.lit("imparfait").alias("tense"),
        none.alias("personne"), none.alias("conjugaison"),
    )
    respelled = respelled.unionByName(empty)
    simple = d.rows_of_participles(s.participes.withColumnRenamed("voix", "voice").join(names, F.col("id") == F.col("verbe_id")))
    pages = raw.where("l_tax = 0.03 AND l_discount <> 0.03").select(F.col("l_partkey").alias("id")).distinct().join(names, "id").select("verb")
    first = F.min("l_linenumber")
    flags = F.transform(F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))), lambda n: F.struct(n.alias("person"), F.lit("").alias("note")))
    log = (
        keyed.where("l_tax = 0.05 AND l_discount = 0.1")
        .groupBy("id", "voice", "mood", "tense")
        .agg(
            F.when(first == 1, a.FLAGGED).when(first == 2, a.SKIPPED).otherwise(a.OK).alias("status"), F.lit("me").alias("auditor"),
            F.max("l_orderkey").cast("string").alias("ts"), flags.alias("flags"), F.concat(F.lit("n"), first.cast("string")).alias("note"),
        )
        .join(names, "id")
        .select(*a.UNIT, "status", "auditor", "ts", "flags", "note")
    )
    return verbs, forms.unionByName(respelled).unionByName(simple), pages, log


def classified(spark, sf):
    return a.classify_units(*audit_tables(spark, sf))


@query("v1_units", over_audit("SELECT DISTINCT verb, voice, mood, tense FROM audit_rows"))
def _v1(spark, sf):
    return a.units(audit_tables(spark, sf)[1])


@query("j8_v5_page_availability", over_audit("SELECT verb, has_page, twin FROM status"))
def _v5(spark, sf):
    verbs, _, pages, _ = audit_tables(spark, sf)
    return a.page_availability(verbs, pages).select("verb", F.col("page_verb").isNotNull().alias("has_page"), a.is_generated_twin().alias("twin"))


@query("v2_v8_classified_units", over_audit("SELECT * FROM classified"))
def _v8(spark, sf):
    return classified(spark, sf)


@query("a10_reason_histogram", over_audit("SELECT reason, count(*) AS units FROM classified WHERE reason NOT IN ('', 'already audited') GROUP BY 1"))
def _a10(spark, sf):
    return a.reason_histogram(classified(spark, sf))


@query(
    "v9_a9_progress_after_audit",
    over_audit(
        "SELECT total, audited, ok, flagged, skipped, audited * 100.0::DOUBLE / total AS percent, total - audited AS remaining FROM (SELECT (SELECT count(*) FROM facts) AS total, "
        "(SELECT count(*) FROM audit_log) + n AS audited, n + (SELECT count(*) FROM audit_log WHERE status = 'ok') AS ok, (SELECT count(*) FROM audit_log WHERE status = 'flagged') AS flagged, "
        "(SELECT count(*) FROM audit_log WHERE status = 'skipped') AS skipped FROM (SELECT count(*) AS n FROM classified WHERE reason = ''))"
    ),
)
def _v9(spark, sf):
    verbs, rows, pages, log = audit_tables(spark, sf)
    facts = durable(a.unit_facts(rows))
    after = a.auto_audit(a.classify_facts(verbs, facts, pages, log), log, ts=F.lit("now"))
    return a.progress(facts.select(*a.UNIT), after)


@query("v10_j9_unaudited_passive", over_audit("SELECT verb, voice, mood, tense FROM facts WHERE voice = 'voix_passive' AND (verb, voice, mood, tense) NOT IN (SELECT (verb, voice, mood, tense) FROM audit_log)"
       .replace("(verb, voice, mood, tense) NOT IN (SELECT (verb, voice, mood, tense) FROM audit_log)",
                "NOT EXISTS (SELECT 1 FROM audit_log l WHERE l.verb = facts.verb AND l.voice = facts.voice AND l.mood = facts.mood AND l.tense = facts.tense)")))
def _v10(spark, sf):
    _, rows, _, log = audit_tables(spark, sf)
    return a.review_view(a.units(rows), log, "unaudited", "voix_passive")


@query("v10_flagged_of_prefix", over_audit("SELECT verb, voice, mood, tense FROM audit_log WHERE status = 'flagged' AND verb LIKE 's%'"))
def _v10_flagged(spark, sf):
    _, rows, _, log = audit_tables(spark, sf)
    return a.search_units(a.review_view(a.units(rows), log, "flagged"), " S")


@query(
    "v13_recorded_outcomes",
    over_audit("SELECT verb, voice, mood, tense, CASE WHEN status = 'flagged' THEN 'ok' ELSE status END AS status, CASE WHEN status = 'flagged' THEN 'you' ELSE auditor END AS auditor, "
        "CASE WHEN status = 'flagged' THEN 'later' ELSE ts END AS ts, CASE WHEN status = 'flagged' THEN '' ELSE flagged_persons END AS flagged_persons, "
        "CASE WHEN status = 'flagged' THEN '' ELSE note END AS note FROM audit_log"),
)
def _v13(spark, sf):
    log = audit_tables(spark, sf)[3]
    done = a.new_records(log.where("status = 'flagged'"), a.OK, "you", F.lit("later"))
    return a.recorded(log, done).select(*a.UNIT, "status", "auditor", "ts", F.array_join("flags.person", "; ").alias("flagged_persons"), "note")


@query(
    "k7_flagged_report",
    over_audit("SELECT verb, voice, mood, tense, flagged_persons, note, auditor, ts AS timestamp FROM audit_log WHERE status = 'flagged'"),
)
def _k7(spark, sf):
    return sinks.flagged_report(audit_tables(spark, sf)[3])


@query(
    "k6_s9_log_lines",
    over_audit(
        """SELECT verb || '|' || voice || '|' || mood || '|' || tense AS key, '{"verb":"' || verb || '","voice":"' || voice || '","mood":"' || mood || '","tense":"' || tense || '","status":"' || status
        || '","auditor":"me","ts":"' || ts || '","flags":[{"person":"' || replace(flagged_persons, '; ', '"},{"person":"') || '"}],"note":"' || note || '"}' AS value FROM audit_log"""
    ),
)
def _k6(spark, sf):
    written = sinks.log_lines(audit_tables(spark, sf)[3])
    # Read the written lines back and write them again: nothing may change.
    return sinks.log_lines(files.parse_log(written.select("value")))
