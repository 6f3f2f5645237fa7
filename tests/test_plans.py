"""What the plans must show: filters at the scan, no shuffle where none is needed."""

from pyspark.sql import functions as F

from checks.star import smallest
from inflecta.functions.text import WHITESPACE, key_filter, squeeze
from inflecta.operators import audit, documents
from inflecta.operators import extract as x
from inflecta.operators.merging import merge_identical
from inflecta.operators.numbering import number_rows
from inflecta.operators.star import read_star, write_star
from inflecta.plans import lookups as q
from tests.pages import line, mood, page, tense, voice


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().toString()


def star_of(spark, path):
    verbs = [(i, f"v{i:03d}er", False, False, None) for i in range(200)]
    forms = [(i, q.AVOIR if i % 2 else q.ETRE, "indicatif", "present", p, f"f{i}") for i in range(200) for p in ("1sm;1sf", "3sm")]
    verbes = spark.createDataFrame(verbs, "id long, infinitif string, h_aspire boolean, rectification_1990 boolean, rectification_1990_variante string")
    facts = spark.createDataFrame(forms, "verbe_id long, voix string, mode string, temps string, personne string, conjugaison string")
    participles = spark.createDataFrame([(1, q.AVOIR, "present", "p")], "verbe_id long, voix string, forme string, participe string")
    write_star(q.Star(verbes, facts, participles), path)
    return read_star(spark, path)


def test_filters_reach_the_scan(spark, rows, tmp_path):
    star = star_of(spark, str(tmp_path))
    for df in (q.verbs_with_voice(star, q.ETRE), q.verbs_with_auxiliary(star, "être")):
        assert "EqualTo(voix,voix_active_etre)" in plan_of(df) and df.count() in (20, 100)
    assert "In(voix, [" in plan_of(q.verbs_with_both_auxiliaries(star))
    assert q.verbs_with_both_auxiliaries(star).count() == 0
    assert q.impersonal_verbs(star).count() == 0 and q.verbs_with_equal_persons(star, limit=None).count() == 200
    assert [r.conjugaison for r in q.tense_of_verb(star, "v007er", q.AVOIR, "indicatif", "present").collect()] == ["f7", "f7"]


def test_facts_are_stored_by_verb(spark, tmp_path):
    star = star_of(spark, str(tmp_path))
    ids = [r.verbe_id for r in star.conjugaisons.orderBy("id").collect()]
    assert ids == sorted(ids)


def test_forms_of_pages_need_no_shuffle(spark):
    html = page("A9X", voice("voix_active_avoir", mood("active_ind", tense("Présent", line("parle", "je "), line("parles", "tu ")))))
    pages = spark.createDataFrame([("parler", "A9X", html)], "verb string, verb_id string, html string")
    forms = x.page_forms(x.extract_pages(pages))
    assert "Exchange" not in forms._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.personne for r in forms.collect()) == ["1sm;1sf", "2sm;2sf"]


def test_candidates_of_a_tense_are_evaluated_once(spark):
    html = page("A9X", voice("voix_active_avoir", mood("active_ind", tense("Présent", line("parle", "je ")))))
    pages = spark.createDataFrame([("parler", "A9X", html)], "verb string, verb_id string, html string")
    plan = x.page_forms(x.extract_pages(pages))._jdf.queryExecution().optimizedPlan().toString()
    # Each person looks through a lambda variable, not through the expression that makes the candidates.
    assert plan.count("array_max(transform(filter(lambda ") == plan.count("array_max(") == 1


def test_persons_are_merged_without_sorting_slots(spark):
    rows = spark.createDataFrame([(1, "1sm", "a")], "k long, person string, form string")
    plan = plan_of(merge_identical(rows, ["k"]))
    assert "SortAggregate" not in plan and "partial_bit_or" in plan


def test_only_wanted_pages_are_parsed(spark):
    html = page("A9X", voice("voix_passive", mood("passive_ind", tense("Présent", line("vu", "je ")))))
    pages = spark.createDataFrame([(f"v{i}", html) for i in range(400)], "verb string, html string")
    verbs = spark.createDataFrame([("v7", None), ("twin", "v8"), ("none", None)], "verb string, rectification_1990_variante string")
    units = spark.createDataFrame([(v, "voix_passive", "indicatif", "present") for v in ("v7", "twin", "none")], "verb string, voice string, mood string, tense string")
    found = audit.evidence(units, verbs, pages)
    assert sorted((r.verb, r.page_verb, r.block is None) for r in found.collect()) == [("none", None, True), ("twin", "v8", False), ("v7", "v7", False)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The filter stands below the tokeniser, and no join does.
    below = plan[plan.index("ArrowEvalPython") :] if "ArrowEvalPython" in plan else plan[plan.index("EvalPython") :]
    assert "Filter" in below.split("Join")[0]


def test_key_filter_keeps_every_key(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(3000)] + [(None,)], "key string")
    many = spark.range(200000).selectExpr("concat('k', id) AS key")
    kept = many.where(key_filter(keys, "key")(F.col("key")))
    assert kept.join(keys, "key", "left_semi").count() == 3000
    assert kept.count() < 3000 + 1500
    assert many.where(key_filter(keys.where("false"), "key")(F.col("key"))).count() == 0


def test_blocks_of_pages_are_not_broadcast(spark, tmp_path):
    # The size of a file is known, and small.
    units = spark.createDataFrame([("v", "voix_passive", "indicatif", "present")], "verb string, voice string, mood string, tense string")
    verbs = spark.createDataFrame([("v", None)], "verb string, rectification_1990_variante string")
    spark.createDataFrame([("v", "<div></div>")], "verb string, html string").write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    plan = plan_of(audit.evidence(units, verbs, pages))
    top = next(row for row in plan.splitlines() if "Join" in row)
    assert "SortMergeJoin" in top


def test_the_smallest_of_few_values_is_not_sorted_for(spark, rows):
    few = spark.createDataFrame([(1, "parlé"), (1, "allé"), (2, "parlé"), (3, None)], "k long, participe string").groupBy("k").agg(smallest(["parlé", "allé"], "participe"))
    assert rows(few) == [(1, "allé"), (2, "parlé"), (3, None)]
    assert "SortAggregate" not in plan_of(few)


def test_numbered_rows_are_computed_once(spark):
    count = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    numbered = number_rows(spark.range(1000, numPartitions=3).mapInArrow(seen, "id long"), ["id"], "n")
    assert numbered.where("n = id + 1").count() == 1000 and count.value == 1000


def test_roots_are_found_without_table_lines(spark, rows):
    pages = spark.createDataFrame([("v", "A9X", page("A9X")), ("w", "none", "<p>x</p>")], "verb string, verb_id string, html string")
    roots = x.roots_of(pages)
    assert rows(roots) == rows(x.extract_pages(pages), "verb", "root_id") and "tenses" not in roots._jdf.queryExecution().optimizedPlan().toString()


def test_steps_of_a_page_are_not_written_out_below_themselves(spark, rows):
    html = page("A9X", voice("voix_passive", mood("passive_ind", tense("Présent", line("vu", "je ")), tense("Autre", line("vu", "je ")))))
    pages = spark.createDataFrame([("v", "A9X", html), ("w", "A9X", "<p>x</p>")], "verb string, verb_id string, html string")
    extracted = x.extract_pages(pages)
    found = {
        x.verbs_of: [("v", "A9X", False)], x.rejected_pages: [("w", "A9X", "no root block")], x.voices_of: [("v", "voix_passive")],
        x.moods_of: [("v", "voix_passive", "indicatif")], x.tenses_of: [("v", "voix_passive", "indicatif", "present")],
        x.unknown_titles: [("v", "voix_passive", "indicatif", "autre")], x.participle_forms: [],
        x.page_forms: [("v", "voix_passive", "indicatif", "present", "1sm;1sf", "vu")],
        lambda e: x.unmapped_forms(x.person_forms(e)): [],
    }
    for job, expected in found.items():
        got = job(extracted)
        # Each block of a voice is looked for in one place of the plan; copies of the steps would look in hundreds.
        assert got._jdf.queryExecution().optimizedPlan().toString().count("voix_active_être") <= 1
        assert rows(got) == expected


def test_texts_of_a_participle_are_squeezed_once(spark, rows):
    lines = (line("né, née, nés, nées"), line("étant né, née, nés, nées"))
    html = page("A9X", voice("voix_prono", mood("prono_par", tense("Passé", *lines))), voice("voix_passive", mood("passive_par", tense("Présent", line("étant vu, vue, vus, vues")))))
    found = x.participle_forms(x.extract_pages(spark.createDataFrame([("v", "A9X", html)], "verb string, verb_id string, html string")))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 10
    assert len(rows(found)) == 12 and ("v", "voix_passive", "present_sf", "étant vue") in rows(found)


def test_texts_are_quoted_as_json(spark):
    texts = spark.createDataFrame([("a",), (None,), ("[x]",), ('"]',), ("",), ("[",)], "t string")
    quoted = texts.select(documents._quoted(F.col("t")).alias("q"))
    assert [r.q for r in quoted.collect()] == ['"a"', "null", '"[x]"', '"\\"]"', '""', '"["']
    assert quoted._jdf.queryExecution().optimizedPlan().toString().count("StructsToJson") == 1


def test_every_white_space_is_squeezed(spark):
    points = [c for c in range(0x3100) if c not in range(0xD800, 0xE000)]
    texts = spark.createDataFrame([(c, f"a{chr(c)}{chr(c)}b") for c in points], "c int, t string")
    found = {r.c for r in texts.where(squeeze(F.col("t")) == "a b").collect()}
    assert found == {ord(c) for c in WHITESPACE}


def test_units_and_facts_of_one_pass(spark, rows):
    long = spark.createDataFrame([("v", "voix_passive", "indicatif", "present", "1sm", "x"), ("v", "voix_passive", "indicatif", "none", "1sm", "x")], "verb string, voice string, mood string, tense string, personne string, conjugaison string")
    verbs = spark.createDataFrame([("v", False, False, None)], "verb string, h_aspire boolean, rectification_1990 boolean, rectification_1990_variante string")
    pages, log = spark.createDataFrame([("v",)], "verb string"), long.where("false").select(*audit.UNIT)
    facts = audit.unit_facts(long)
    assert rows(facts, *audit.UNIT) == rows(audit.units(long)) and rows(audit.classify_facts(verbs, facts, pages, log)) == rows(audit.classify_units(verbs, long, pages, log))
