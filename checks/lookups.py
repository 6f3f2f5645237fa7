"""Registered queries over the star."""

from __future__ import annotations

from checks.registry import query
from checks.star import star, star_of_last_verb, with_star
from inflecta.plans import lookups as q

HAS = "list_has_any(string_split({c}, ';'), {p})"
P1S, P1P, P3SM = "['1sm','1sf']", "['1pm','1pf']", "['3sm']"


def has(persons: str, column: str = "personne") -> str:
    return HAS.format(c=column, p=persons)


# The looked-up verb is the last one in string order, so that it exists at every scale.
ONE = "(SELECT max(infinitif) FROM verbes)"
OF_ONE = f"FROM conjugaisons c JOIN verbes v ON c.verbe_id = v.id WHERE v.infinitif = {ONE}"
PRESENT = "c.mode = 'indicatif' AND c.temps = 'present'"


@query("q01_forms_of_verb", with_star(f"SELECT infinitif, voix, mode, temps, personne, conjugaison {OF_ONE}"))
def _q01(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.forms_of_verb(s, verb)


@query("q02_tense_of_verb", with_star(f"SELECT personne, conjugaison {OF_ONE} AND c.voix = 'voix_passive' AND {PRESENT}"))
def _q02(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.tense_of_verb(s, verb, "voix_passive", "indicatif", "present")


@query(
    "q03_participles_of_verb",
    with_star(f"SELECT voix, forme, participe FROM participes p JOIN verbes v ON p.verbe_id = v.id WHERE v.infinitif = {ONE}"),
)
def _q03(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.participles_of_verb(s, verb)


@query("q04_h_aspire_verbs", with_star("SELECT infinitif FROM verbes WHERE h_aspire"))
def _q04(spark, sf):
    return q.h_aspire_verbs(star(spark, sf))


@query(
    "q05_reform_variants",
    with_star("SELECT infinitif, rectification_1990_variante FROM verbes WHERE rectification_1990 AND rectification_1990_variante IS NOT NULL"),
)
def _q05(spark, sf):
    return q.reform_variants(star(spark, sf))


@query(
    "q06_both_spellings",
    with_star(
        "SELECT infinitif, rectification_1990_variante AS alternate_spelling FROM verbes "
        "WHERE infinitif IN ('largering0ir','smallring0oître','coldwidget0er','redwidget1ir','hotbolt1er','smallwidget1ir')"
    ),
)
def _q06(spark, sf):
    spellings = ["largering0ir", "smallring0oître", "coldwidget0er", "redwidget1ir", "hotbolt1er", "smallwidget1ir"]
    return q.both_spellings(star(spark, sf), spellings)


@query(
    "q07_reform_pair_count",
    with_star("SELECT count(*) // 2 AS reformed_verb_pairs FROM verbes WHERE rectification_1990 AND rectification_1990_variante IS NOT NULL"),
)
def _q07(spark, sf):
    return q.reform_pair_count(star(spark, sf))


def with_voice_sql(voice: str, limit: str = "LIMIT 20") -> str:
    return with_star(
        f"SELECT DISTINCT infinitif FROM verbes v JOIN conjugaisons c ON v.id = c.verbe_id WHERE c.voix = '{voice}' ORDER BY infinitif {limit}"
    )


@query("q08_verbs_with_etre", with_voice_sql("voix_active_etre"))
def _q08(spark, sf):
    return q.verbs_with_voice(star(spark, sf), q.ETRE)


@query(
    "q09_verbs_with_both_auxiliaries",
    with_star(
        "SELECT infinitif FROM verbes v WHERE EXISTS (SELECT 1 FROM conjugaisons c WHERE c.verbe_id = v.id AND c.voix = 'voix_active_avoir') "
        "AND EXISTS (SELECT 1 FROM conjugaisons c WHERE c.verbe_id = v.id AND c.voix = 'voix_active_etre') ORDER BY infinitif LIMIT 20"
    ),
)
def _q09(spark, sf):
    return q.verbs_with_both_auxiliaries(star(spark, sf))


@query("q10_pronominal_verbs", with_voice_sql("voix_prono"))
def _q10(spark, sf):
    return q.verbs_with_voice(star(spark, sf), q.PRONO)


@query(
    "q11_active_and_pronominal",
    with_star(
        f"SELECT 'active' AS form, personne, conjugaison {OF_ONE} AND voix = 'voix_active_avoir' AND {PRESENT} UNION ALL "
        f"SELECT 'pronominal' AS form, personne, conjugaison {OF_ONE} AND voix = 'voix_prono' AND {PRESENT}"
    ),
)
def _q11(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.active_and_pronominal(s, verb)


@query("q12_verbs_ending_in", with_star("SELECT infinitif FROM verbes WHERE infinitif LIKE '%er' ORDER BY infinitif LIMIT 20"))
def _q12(spark, sf):
    return q.verbs_ending_in(star(spark, sf), "er")


@query(
    "q13_verbs_with_form_ending",
    with_star(
        f"SELECT DISTINCT infinitif FROM verbes v JOIN conjugaisons c ON v.id = c.verbe_id WHERE {has(P1S, 'c.personne')} AND {PRESENT} "
        "AND c.conjugaison LIKE '%ais' ORDER BY infinitif LIMIT 20"
    ),
)
def _q13(spark, sf):
    return q.verbs_with_form_ending(star(spark, sf))


PAIR = "FROM verbes v JOIN conjugaisons c1 ON v.id = c1.verbe_id JOIN conjugaisons c2 ON v.id = c2.verbe_id AND c1.voix = c2.voix"
PAIR_PRESENT = "c1.mode = 'indicatif' AND c1.temps = 'present' AND c2.mode = 'indicatif' AND c2.temps = 'present'"


@query(
    "q14_stem_changing_verbs",
    with_star(
        f"SELECT DISTINCT infinitif, c1.conjugaison AS first_singular, c2.conjugaison AS first_plural {PAIR} "
        f"WHERE {PAIR_PRESENT} AND {has(P1S, 'c1.personne')} AND {has(P1P, 'c2.personne')} AND infinitif LIKE '%er' "
        "AND substr(c1.conjugaison, 1, greatest(length(c1.conjugaison) - 2, 0)) <> substr(c2.conjugaison, 1, greatest(length(c2.conjugaison) - 3, 0)) "
        "ORDER BY infinitif, first_singular, first_plural LIMIT 20"
    ),
)
def _q14(spark, sf):
    return q.stem_changing_verbs(star(spark, sf))


@query("q15_verb_count", with_star("SELECT count(*) AS total_verbs FROM verbes"))
def _q15(spark, sf):
    return q.verb_count(star(spark, sf))


@query("q16_forms_per_mood", with_star("SELECT mode, count(*) AS conjugation_count FROM conjugaisons GROUP BY mode"))
def _q16(spark, sf):
    return q.forms_per_mood(star(spark, sf))


@query(
    "q17_verbs_per_auxiliary",
    with_star(
        "SELECT CASE WHEN voix = 'voix_active_avoir' THEN 'avoir' WHEN voix = 'voix_active_etre' THEN 'être' "
        "WHEN voix = 'voix_prono' THEN 'pronominal' END AS auxiliary_type, count(DISTINCT verbe_id) AS verb_count FROM conjugaisons GROUP BY voix"
    ),
)
def _q17(spark, sf):
    return q.verbs_per_auxiliary(star(spark, sf))


@query(
    "q18_commonest_forms",
    with_star(
        f"SELECT conjugaison, count(*) AS frequency FROM conjugaisons c WHERE {PRESENT} AND {has(P1S)} "
        "GROUP BY conjugaison ORDER BY frequency DESC, conjugaison LIMIT 20"
    ),
)
def _q18(spark, sf):
    return q.commonest_forms(star(spark, sf))


@query(
    "q19_verbs_with_equal_persons",
    with_star(
        f"SELECT DISTINCT infinitif {PAIR} WHERE {PAIR_PRESENT} AND {has(P1S, 'c1.personne')} AND {has(P3SM, 'c2.personne')} "
        "AND c1.conjugaison = c2.conjugaison ORDER BY infinitif LIMIT 20"
    ),
)
def _q19(spark, sf):
    return q.verbs_with_equal_persons(star(spark, sf))


@query(
    "q20_impersonal_verbs",
    with_star(
        f"SELECT infinitif FROM verbes v WHERE EXISTS (SELECT 1 FROM conjugaisons c WHERE c.verbe_id = v.id AND {has(P3SM)} AND {PRESENT}) "
        f"AND NOT EXISTS (SELECT 1 FROM conjugaisons c WHERE c.verbe_id = v.id AND {has(P1S)} AND {PRESENT}) ORDER BY infinitif LIMIT 20"
    ),
)
def _q20(spark, sf):
    return q.impersonal_verbs(star(spark, sf))


@query(
    "q21_person_across_tenses",
    with_star(f"SELECT temps, conjugaison {OF_ONE} AND voix = 'voix_passive' AND mode = 'subjonctif' AND {has(P1S)}"),
)
def _q21(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.person_across_tenses(s, verb, "voix_passive", "subjonctif", "1s")


# string_agg over the person order; a repeated pronoun always directly follows its twin there.
TABLE_CTE = """labelled AS (SELECT c.verbe_id, c.voix, c.mode, c.temps, c.conjugaison,
  u.p, u.i, CASE u.p WHEN '1sm' THEN 'je' WHEN '1sf' THEN 'je' WHEN '3sm' THEN 'il' WHEN '3sf' THEN 'elle'
  WHEN '3sn' THEN 'on' ELSE 'nous' END AS pronoun
  FROM (SELECT *, string_split(personne, ';') AS parts FROM conjugaisons) c,
  LATERAL (SELECT unnest(c.parts) AS p, generate_subscripts(c.parts, 1) AS i) u),
tables AS (SELECT verbe_id, voix, mode, temps, conjugaison, string_agg(pronoun, ', ' ORDER BY i) AS pronoun FROM
  (SELECT verbe_id, voix, mode, temps, conjugaison, pronoun, min(i) AS i FROM labelled GROUP BY ALL) GROUP BY ALL)"""


@query(
    "q22_conjugation_table",
    with_star(
        f"SELECT pronoun, conjugaison FROM tables t JOIN verbes v ON t.verbe_id = v.id WHERE v.infinitif = {ONE} "
        "AND voix = 'voix_passive' AND mode = 'indicatif' AND temps = 'present'",
        TABLE_CTE,
    ),
)
def _q22(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.conjugation_table(s, verb, "voix_passive", "indicatif", "present")


@query(
    "q23_search_forms",
    with_star(
        "SELECT infinitif, voix, mode, temps, personne, conjugaison FROM conjugaisons c JOIN verbes v ON c.verbe_id = v.id "
        "WHERE conjugaison LIKE '%all%' ORDER BY ALL LIMIT 20"
    ),
)
def _q23(spark, sf):
    return q.search_forms(star(spark, sf), "all")


@query("q24_tense_of_active_verb", with_star(f"SELECT personne, conjugaison {OF_ONE} AND voix = 'voix_active_avoir' AND {PRESENT}"))
def _q24(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.tense_of_verb(s, verb, q.AVOIR, "indicatif", "present")


@query(
    "q25_reform_list",
    with_star("SELECT infinitif, rectification_1990_variante FROM verbes WHERE rectification_1990"),
)
def _q25(spark, sf):
    return q.reform_variants(star(spark, sf))


@query("q26_verb_metadata", with_star(f"SELECT id, infinitif, h_aspire, rectification_1990, rectification_1990_variante FROM verbes WHERE infinitif = {ONE}"))
def _q26(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.verb_metadata(s, verb)


@query(
    "q27_form_of_verb",
    with_star(f"SELECT DISTINCT conjugaison {OF_ONE} AND voix = 'voix_passive' AND mode = 'indicatif' AND temps = 'present' AND {has("['3sm','3sf','3sn']")}"),
)
def _q27(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    forms = [q.form_of_verb(s, verb, "voix_passive", "indicatif", "present", p) for p in ("3sm", "3sf", "3sn")]
    return forms[0].unionByName(forms[1]).unionByName(forms[2]).distinct()


@query("q28_tense_conjugations", with_star(f"SELECT personne, conjugaison {OF_ONE} AND voix = 'voix_active_avoir' AND mode = 'indicatif' AND temps = 'imparfait'"))
def _q28(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.tense_of_verb(s, verb, "voix_active_avoir", "indicatif", "imparfait")


@query(
    "q29_participles_of_voice",
    with_star(
        f"SELECT forme, participe FROM participes p JOIN verbes v ON p.verbe_id = v.id WHERE v.infinitif = {ONE} AND voix = 'voix_passive'"
    ),
)
def _q29(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.participles_of_verb(s, verb, "voix_passive")


@query(
    "q30_verbs_with_pattern",
    with_star(
        f"SELECT DISTINCT infinitif, conjugaison FROM verbes v JOIN conjugaisons c ON v.id = c.verbe_id WHERE conjugaison LIKE '%a%s' AND {PRESENT} "
        f"AND {has(P1S)} ORDER BY infinitif, conjugaison LIMIT 10"
    ),
)
def _q30(spark, sf):
    return q.verbs_with_pattern(star(spark, sf), "%a%s")


@query(
    "q31_unique_reform_pairs",
    with_star(
        "SELECT least(infinitif, rectification_1990_variante) AS infinitif, greatest(infinitif, rectification_1990_variante) AS rectification_1990_variante "
        "FROM verbes WHERE rectification_1990 AND rectification_1990_variante IS NOT NULL"
    ),
)
def _q31(spark, sf):
    # Each spelling is an entry that names the other, as twins do; a pair is listed once.
    whole = star(spark, sf)
    twins = whole.verbes.where("rectification_1990_variante IS NOT NULL").selectExpr(
        "id", "rectification_1990_variante AS infinitif", "h_aspire", "rectification_1990", "infinitif AS rectification_1990_variante"
    )
    return q.reform_variants(q.Star(whole.verbes.unionByName(twins), whole.conjugaisons, whole.participes), unique=True)


@query("q32_verbs_by_auxiliary", with_voice_sql("voix_active_etre", ""))
def _q32(spark, sf):
    return q.verbs_with_auxiliary(star(spark, sf), "être")


@query(
    "q33_conjugation_table_rows",
    with_star(
        f"SELECT pronoun, conjugaison FROM tables t JOIN verbes v ON t.verbe_id = v.id WHERE v.infinitif = {ONE} "
        "AND voix = 'voix_active_avoir' AND mode = 'indicatif' AND temps = 'present'",
        TABLE_CTE,
    ),
)
def _q33(spark, sf):
    s, verb = star_of_last_verb(spark, sf)
    return q.conjugation_table(s, verb)
