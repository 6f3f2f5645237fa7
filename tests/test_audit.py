import pytest
from pyspark.sql import functions as F

from inflecta.dims import FULL_PERSONS, NEUTRAL_PERSONS
from inflecta.operators import audit as a
from inflecta.operators import documents as d
from inflecta.sources import files, sinks
from tests.pages import line, mood, page, tense, voice

LONG = ", ".join(f"{c} string" for c in d.COLUMNS)
VERBS = "verb string, h_aspire boolean, rectification_1990 boolean, rectification_1990_variante string"
ALL = ";".join(FULL_PERSONS)


@pytest.fixture(scope="module")
def data(spark):
    v, i = "voix_active_avoir", "indicatif"
    rows = spark.createDataFrame(
        [
            ("full", v, i, "present", ALL, "x"),
            ("full", v, i, "imparfait", "1sm;1sf", "x"),
            ("full", v, i, "passe_simple", None, None),
            ("full", v, i, "futur_simple", ALL, "x;y"),
            ("full", v, i, "passe_compose", "1sm", " "),
            ("full", v, i, "passe_compose", "1sf", ""),
            ("full", v, "imperatif", "present", "2sm;2sf;1pm;1pf;2pm;2pf", "x"),
            ("full", v, "imperatif", "passe", "2sm", "x"),
            ("full", v, "participe", "present", None, "x"),
            ("full", v, "participe", "passe", "sm", "x"),
            ("full", "voix_passive", i, "present", ";".join(NEUTRAL_PERSONS), "x"),
            ("nopage", v, i, "present", ALL, "x"),
            ("naitre", v, i, "present", ALL, "x"),
            ("naître", v, i, "present", ALL, "x"),
            ("reme", v, i, "present", ALL, "x"),
        ],
        LONG,
    ).cache()
    verbs = spark.createDataFrame(
        [("full", False, False, None), ("nopage", False, False, None), ("naître", False, True, "naitre"), ("naitre", False, True, "naître"), ("reme", False, True, "full")],
        VERBS,
    )
    pages = spark.createDataFrame([("full",), ("naître",)], "verb string")
    log = spark.createDataFrame(
        [("naître", v, i, "present", "flagged", "me", "2024-01-01T00:00:00+00:00", [("1sm", ""), ("2sm", "n")], "look"), ("gone", v, i, "present", "skipped", "me", "t", [], "")],
        files.LOG_TYPE,
    ).cache()
    return rows, verbs, pages, log


def test_classification(data, rows):
    long, verbs, pages, log = data
    classified = a.classify_units(verbs, long, pages, log)
    got = {(r.verb, r.voice[5:], r.mood, r.tense): r.reason for r in classified.collect()}
    assert got == {
        ("full", "active_avoir", "indicatif", "present"): "",
        ("full", "active_avoir", "indicatif", "imparfait"): "missing person keys",
        ("full", "active_avoir", "indicatif", "passe_simple"): "empty tense (defective verb)",
        ("full", "active_avoir", "indicatif", "futur_simple"): "alternative forms present",
        ("full", "active_avoir", "indicatif", "passe_compose"): "empty form value for 1sm",
        ("full", "active_avoir", "imperatif", "present"): "",
        ("full", "active_avoir", "imperatif", "passe"): "missing imperative persons",
        ("full", "active_avoir", "participe", "participe"): "participe (complex gender)",
        ("full", "passive", "indicatif", "present"): "",
        ("nopage", "active_avoir", "indicatif", "present"): "no cached HTML",
        ("naitre", "active_avoir", "indicatif", "present"): "reform variant entry",
        ("naître", "active_avoir", "indicatif", "present"): "already audited",
        ("reme", "active_avoir", "indicatif", "present"): "",
    }
    assert rows(a.reason_histogram(classified))[0] == ("alternative forms present", 1)
    units = a.units(long)
    assert units.count() == 13
    after = a.auto_audit(classified, log, ts=F.lit("now"))
    assert a.progress(units, after).first()[:] == (13, 6, 4, 1, 1, 6 * 100.0 / 13, 7)
    assert a.progress(units.where("false"), log.where("false")).first().percent == 0.0
    first = units.orderBy(*a.in_review_order()).first()
    assert (first.verb, first.mood) == ("full", "participe")


def test_log(spark, data, rows, tmp_path):
    long, _, _, log = data
    sinks.write_log(log, str(tmp_path / "log"))
    again = files.read_log(spark, str(tmp_path / "log"))
    assert rows(again.drop("seq")) == rows(log)
    text = "".join(p.read_text() for p in sorted((tmp_path / "log").glob("part-*")))
    assert '"flags":[{"person":"1sm"},{"person":"2sm","note":"n"}],"note":"look"}' in text
    unit = a.units(long).where("verb = 'naître'")
    redone = a.recorded(log, a.new_records(unit, a.OK, "you", note="fine"))
    assert rows(redone, "verb", "status", "auditor", "note") == [("gone", "skipped", "me", ""), ("naître", "ok", "you", "fine")]
    assert redone.where("auditor = 'you'").first().ts.endswith("+00:00")
    doubled = log.withColumn("seq", F.lit(1)).unionByName(log.withColumn("seq", F.lit(2)).withColumn("note", F.lit("last")))
    assert {r.note for r in a.latest_records(doubled, "seq").collect()} == {"last"}
    sinks.write_flagged_report(log, str(tmp_path / "report"))
    csv = "".join(p.read_text() for p in (tmp_path / "report").glob("part-*")).splitlines()
    assert csv == [
        "verb,voice,mood,tense,flagged_persons,note,auditor,timestamp",
        "naître,voix_active_avoir,indicatif,present,1sm; 2sm,look,me,2024-01-01T00:00:00+00:00",
    ]


def test_views(data, rows):
    long, _, _, log = data
    units = a.units(long)
    assert a.review_view(units, log, "unaudited").count() == 12
    assert a.review_view(units, log, "flagged").count() == 1
    assert a.review_view(units, log, "ok").count() == 0
    assert a.review_view(units, log, voice="voix_passive").count() == 1
    assert rows(a.search_units(units, " NA").select("verb").distinct()) == [("naitre",), ("naître",)]
    assert a.search_units(units, " ").count() == 0
    assert rows(a.participle_keys(long), "key", "value") == [("passe.sm", "x"), ("present", "x")]


def test_evidence(spark, rows):
    present = tense("Présent", line("a", "je "))
    participle = tense("Passé", line("b"))
    html = page("A9", voice("voix_active", mood("active_par", participle), mood("active_ind", present)))
    pages = spark.createDataFrame([("naître", html)], "verb string, html string")
    verbs = spark.createDataFrame([("naitre", False, True, "naître")], VERBS)
    units = spark.createDataFrame(
        [("naitre", "voix_active_etre", m, t) for m, t in [("indicatif", "present"), ("participe", "participe"), ("subjonctif", "present"), ("indicatif", "passe")]],
        "verb string, voice string, mood string, tense string",
    )
    got = rows(a.evidence(units, verbs, pages), "page_verb", "mood", "tense", "block")
    assert got == sorted(
        [
            ("naître", "indicatif", "present", present),
            ("naître", "participe", "participe", f'<div class="grid">{participle}</div>'),
            ("naître", "subjonctif", "present", None),
            ("naître", "indicatif", "passe", None),
        ],
        key=lambda row: row[1:3],
    )
