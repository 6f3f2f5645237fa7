"""Written stars and stores: what is refused, what is switched, what is rewritten; merging against brute force."""

import random

import pytest

from inflecta.dims import PERSON_ORDER
from inflecta.operators import merging
from inflecta.operators import star as st
from inflecta.plans.lookups import AVOIR, Star
from inflecta.session import get_text
from inflecta.sources import files, sinks

VERBES = "id long, infinitif string, h_aspire boolean, rectification_1990 boolean, rectification_1990_variante string"
FORMS = "verbe_id long, voix string, mode string, temps string, personne string, conjugaison string"
PARTICIPLES = "verbe_id long, voix string, forme string, participe string"


def star_of(spark, verbs, forms, participles=((1, AVOIR, "present", "p"),)):
    verbes = spark.createDataFrame([(i, name, False, False, None) for i, name in verbs], VERBES)
    facts = spark.createDataFrame([(i, AVOIR, "indicatif", "present", p, f) for i, p, f in forms], FORMS)
    return Star(verbes, facts, spark.createDataFrame(list(participles), PARTICIPLES))


GOOD = ([(1, "aller"), (2, "venir")], [(1, "1sm;1sf", "vais"), (2, "1sm;1sf", "viens")])


@pytest.mark.parametrize(
    "verbs, forms, participles, broken",
    [
        ([(1, "a"), (2, "a")], [], [], [("verbes", "unique infinitif", "a", 2)]),
        ([(1, "a"), (1, "b")], [], [], [("verbes", "unique id", "1", 2)]),
        ([(1, "a")], [(1, "1sm", "x"), (1, "1sm", "y")], [], [("conjugaisons", "unique key", f"1|{AVOIR}|indicatif|present|1sm", 2)]),
        ([(1, "a")], [(3, "1sm", "x"), (3, "1sf", "y")], [], [("conjugaisons", "reference", "3", 2)]),
        ([(1, "a")], [], [(1, AVOIR, "present", "p"), (1, AVOIR, "present", "q"), (9, AVOIR, "present", "p")],
         [("participes", "reference", "9", 1), ("participes", "unique key", f"1|{AVOIR}|present", 2)]),
    ],
)
def test_a_bad_star_is_refused_and_the_old_one_stays(spark, rows, tmp_path, verbs, forms, participles, broken):
    path = str(tmp_path / "star")
    st.write_star(star_of(spark, *GOOD), path)
    with pytest.raises(st.StarRefused) as refused:
        st.write_star(star_of(spark, verbs, forms, participles), path)
    assert sorted(map(tuple, spark.read.parquet(refused.value.violations).collect())) == broken
    assert rows(st.read_star(spark, path).verbes, "infinitif") == [("aller",), ("venir",)]
    assert len(list((tmp_path / "star").glob("build-*"))) == 1


def test_builds_are_switched(spark, rows, tmp_path):
    path = str(tmp_path / "star")
    with pytest.raises(FileNotFoundError):
        st.read_star(spark, path)
    opened = []
    for name in ("a", "b", "c"):
        st.write_star(star_of(spark, [(1, name)], [(1, "1sm", name)]), path)
        opened.append(st.read_star(spark, path))
        assert rows(opened[-1].conjugaisons, "conjugaison") == [(name,)]
    # The build before the current one still reads; the one before that is gone.
    assert rows(opened[1].verbes, "infinitif") == [("b",)]
    assert len(get_text(spark, f"{path}/CURRENT").split()) == 2 == len(list((tmp_path / "star").glob("build-*")))


def test_an_upsert_writes_the_buckets_of_its_verbs_only(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    verbs = [f"verbe{i}" for i in range(600)]
    sinks.write_store(spark.createDataFrame([(v, f"{{{v}}}") for v in verbs], "verb string, data string"), path)

    def written():
        return {p.parent.name: sorted(f.name for f in p.parent.glob("*.parquet")) for p in (tmp_path / "store").glob("bucket=*/*.parquet")}

    before = written()
    assert sinks.upsert_into(spark, path, spark.createDataFrame([], "verb string, data string")) == [] and written() == before
    new = [("verbe7", "new"), ("être", "added")]
    touched = sinks.upsert_into(spark, path, spark.createDataFrame(new, "verb string, data string"))
    after = written()
    assert {f"bucket={b}" for b in touched} == {b for b in after if after[b] != before.get(b)} and len(touched) == 2
    assert dict(rows(files.stored_records(spark, path))) == {**{v: f"{{{v}}}" for v in verbs}, **dict(new)}
    assert [r.verb for r in files.read_store(spark, path).collect()] == sorted([*verbs, "être"])


def test_merging_is_that_of_the_smallest_forms(spark):
    draw = random.Random(23)
    given = [
        (draw.randrange(30), draw.choice([*PERSON_ORDER, None, "9x"]), draw.choice(["a", "b", "é", "f;g", "", None, *"mnopqr"]))
        for _ in range(2500)
    ]
    least = {}
    for key, person, form in given:
        if person in PERSON_ORDER and form is not None:
            least[key, person] = min(form, least.get((key, person), form))
    want = {}
    for person in PERSON_ORDER:
        for key in range(30):
            if (key, person) in least:
                want.setdefault((key, least[key, person]), []).append(person)
    rows = spark.createDataFrame(given, "k long, person string, form string")
    got = {(r.k, r.conjugaison): r.personne for r in merging.merge_identical(rows, ["k"]).collect()}
    assert got == {key: ";".join(persons) for key, persons in want.items()}
    assert merging.merge_identical(rows.where("false"), ["k"]).collect() == []
