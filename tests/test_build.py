import json

from inflecta.plans import lookups as q
from inflecta.plans.build import parse_pages, publish, with_entry_ids
from inflecta.sources.files import pages_of_headwords
from tests.pages import line, mood, page, reform, tense, voice

PAGES = "verb string, verb_id string, html string"


def entry(*lines, voice_id="voix_active_avoir"):
    return page("A9X", voice(voice_id, mood("active_ind", tense("Présent", *lines))))


def test_build_twice(spark, rows, tmp_path):
    first = [
        ("dîner_1", "A9X", entry(line("dîne", "je "))),
        ("dîner_2", "A9X", entry(line("dîne", "je "))),
        ("naître", "A9X", entry(line("naît" + reform("nait"), "il, elle "), voice_id="voix_active_être")),
        ("bad", "A9X", "<p>"),
        ("malformed", "A9X", "<![foo[bar]]>"),
        ("missing", "A9X", None),
        ("empty", "A9X", '<div id="A9X"></div>'),
    ]
    store = parse_pages(spark.createDataFrame(first, PAGES), str(tmp_path / "one"))
    assert [r[0] for r in rows(store, "verb")] == ["diner_1", "diner_2", "dîner_1", "dîner_2", "naitre", "naître"]
    rejected = spark.read.parquet(str(tmp_path / "one" / "rejected"))
    assert rows(rejected, "verb", "reject") == [
        ("bad", "no root block"), ("empty", "no conjugation data"), ("malformed", "malformed page"), ("missing", "no page"),
    ]
    more = [("naitre", "A9X", entry(line("genuine", "je "))), ("naître", "A9X", entry(line("never parsed", "je ")))]
    store = parse_pages(spark.createDataFrame(more, PAGES), str(tmp_path / "two"), store)
    star = publish(spark, store, str(tmp_path / "two"))
    assert [r[0] for r in rows(star.verbes, "infinitif")] == ["diner", "dîner", "naitre", "naître"]
    assert rows(star.conjugaisons, "personne", "conjugaison") == [
        ("1sm;1sf", "dîne"), ("1sm;1sf", "dîne"), ("1sm;1sf", "genuine"), ("3sm;3sf", "naît;nait"),
    ]
    assert q.form_of_verb(star, "naître", "voix_active_etre", "indicatif", "present", "3sf").first()[0] == "naît;nait"
    assert q.conjugation_table(star, "dîner").collect() == [("je", "dîne")]
    text = "".join(p.read_text() for p in sorted((tmp_path / "two" / "document").glob("part-*")))
    document = json.loads(text)
    assert list(document) == sorted(document)
    assert document["dîner"]["rectification_1990_variante"] == "diner_1"
    assert document["naître"]["voix_active_etre"]["indicatif"]["present"] == {"3sm;3sf": "naît;nait"}


def test_headwords_without_page_or_id(spark, rows):
    headwords = spark.createDataFrame([("a", "1"), ("b", None), ("c", None)], "verb string, verb_id string")
    pages = spark.createDataFrame([("a", "<p>")], "verb string, html string")
    assert rows(pages_of_headwords(pages, headwords)) == [("a", "1", "<p>"), ("b", None, None), ("c", None, None)]
    candidates = spark.createDataFrame([("b", 0, "v.", "b", "/x/A9B")], "verb string, pos int, nature string, label string, url string")
    assert rows(with_entry_ids(headwords, candidates)) == [("a", "1"), ("b", "A9B"), ("c", None)]
