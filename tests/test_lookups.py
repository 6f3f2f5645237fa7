import pytest

from inflecta.plans import lookups as q

VERBES = "id long, infinitif string, h_aspire boolean, rectification_1990 boolean, rectification_1990_variante string"
FACTS = "verbe_id long, voix string, mode string, temps string, personne string, conjugaison string"
A, E = q.AVOIR, q.ETRE


@pytest.fixture(scope="module")
def star(spark):
    present = ("indicatif", "present")
    verbes = spark.createDataFrame([(1, "haler", True, False, None), (2, "geler", False, False, None), (3, "falloir", False, False, None)], VERBES)
    facts = spark.createDataFrame(
        [
            (1, A, *present, "1sm;1sf;3sm;3sf", "hale"),
            (1, A, *present, "1pm;1pf", "halons"),
            (1, E, *present, "1sm", "suis"),
            (2, A, *present, "1sm;1sf", "gèle"),
            (2, A, *present, "1pm;1pf", "gelons"),
            (3, A, *present, "3sm", "faut"),
        ],
        FACTS,
    )
    return q.Star(verbes, facts, spark.createDataFrame([(1, A, "passe_sm", "halé")], "verbe_id long, voix string, forme string, participe string"))


def test_short_person_names_cover_merged_keys(star, rows):
    # Two letters less of the singular, three less of the plural: "ha" is not "hal".
    assert rows(q.stem_changing_verbs(star)) == [("geler", "gèle", "gelons"), ("haler", "hale", "halons")]
    assert rows(q.verbs_with_equal_persons(star)) == [("haler",)]
    assert rows(q.impersonal_verbs(star)) == [("falloir",)]
    assert rows(q.verbs_with_form_ending(star, suffix="le")) == [("geler",), ("haler",)]
    assert rows(q.verbs_with_pattern(star, "%LE", ci=True)) == [("geler", "gèle"), ("haler", "hale")]
    assert rows(q.verbs_with_pattern(star, "%LE")) == []
    assert rows(q.form_of_verb(star, "haler", A, "indicatif", "present", "3sf")) == [("hale",)]


def test_lists(star, rows):
    assert rows(q.verbs_with_both_auxiliaries(star)) == [("haler",)]
    assert rows(q.verbs_with_auxiliary(star, "Être")) == [("haler",)]
    with pytest.raises(ValueError):
        q.verbs_with_auxiliary(star, "faire")
    assert rows(q.verbs_per_auxiliary(star)) == [("avoir", 3), ("être", 1)]
    assert [tuple(r) for r in q.tense_of_verb(star, "haler", A, "indicatif", "present").collect()] == [("1sm;1sf;3sm;3sf", "hale"), ("1pm;1pf", "halons")]
    assert [r.pronoun for r in q.conjugation_table(star, "haler").collect()] == ["je, il, elle", "nous"]
    assert rows(q.participles_of_verb(star, "haler", A)) == [("passe_sm", "halé")]
