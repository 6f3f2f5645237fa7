import random

from inflecta.operators import homonyms as h


def sequential(entries):
    """Brute force: entries is a list of (key, voices); keys in string order."""
    clusters = []
    for key, voices in sorted(entries):
        for i, (_, other) in enumerate(clusters):
            if voices.items() <= other.items():
                break
            if other.items() <= voices.items():
                clusters[i] = (key, voices)
                break
        else:
            clusters.append((key, voices))
    return [key for key, _ in clusters]


def expected_names(groups):
    names = {}
    for base in sorted(groups):
        entries = groups[base]
        if len(entries) == 1:
            names[entries[0][0]] = entries[0][0]
            continue
        kept = sequential(entries)
        for i, key in enumerate(kept, 1):
            names[base if len(kept) == 1 else f"{base}_{i}"] = key
    return names


def members(spark, groups):
    data = [
        (base, key, sorted(voices.items())) for base, entries in groups.items() for key, voices in entries
    ]
    return spark.createDataFrame(data, "base string, verb string, voices array<struct<voice:string,digest:string>>")


def names_of(spark, groups, plain=()):
    keys = [key for entries in groups.values() for key, _ in entries] + list(plain)
    verbs = spark.createDataFrame([(k,) for k in keys], "verb string")
    return {r.name: r.verb for r in h.homonym_names(verbs, members(spark, groups)).collect()}


GROUPS = {
    "x": [("x_1", {"A": "1"}), ("x_2", {"B": "2"}), ("x_3", {"A": "1", "B": "2"})],
    "equal": [("equal_1", {"A": "1"}), ("equal_2", {"A": "1"})],
    "lone": [("lone_2", {"A": "1"})],
    "ten": [(f"ten_{i}", {"A": str(i % 3)}) for i in range(1, 12)],
    "nested_1": [("nested_1_1", {"A": "1"}), ("nested_1_2", {"A": "1"})],
    "nested": [("nested_1", {"A": "1"}), ("nested_2", {"B": "1"})],
    "empty": [("empty_1", {}), ("empty_2", {"A": "1"}), ("empty_3", {})],
}


def test_named_cases(spark):
    names = names_of(spark, GROUPS, ["equal", "other"])
    assert names == {**expected_names(GROUPS), "other": "other"}
    assert names["x_1"] == "x_3" and names["x_2"] == "x_2" and names["equal"] == "equal_1" and names["nested_1"] == "nested_1_1"


def test_random_groups(spark):
    draw = random.Random(7)
    groups = {}
    for g in range(12):
        base = f"v{g}"
        groups[base] = [
            (f"{base}_{i}", {v: str(draw.randrange(2)) for v in "ABCDE"[: 2 + g % 4] if draw.random() < 0.55})
            for i in range(1, draw.randrange(3, 40))
        ]
    assert names_of(spark, groups) == expected_names(groups)


def test_one_large_group_whose_members_share_a_part(spark):
    entries = [("hot_0", {"A": "1"})] + [(f"hot_{i}", {"A": "1", "B": str(i)}) for i in range(1, 1500)]
    entries += [(f"hot_{i}", {"B": str(i - 1500), "C": "1"}) for i in range(1500, 2000)]
    assert names_of(spark, {"hot": entries}) == expected_names({"hot": entries})


def test_merge_keeps_flags_of_the_kept_member(spark, rows):
    verbs = spark.createDataFrame([("x_1", False), ("x_2", True), ("y", False)], "verb string, h_aspire boolean")
    columns = "verb string, voice string, mood string, tense string, personne string, conjugaison string"
    long = spark.createDataFrame(
        [
            ("x_1", "a", "indicatif", "present", "1sm", "p"),
            ("x_1", "a", "indicatif", "imparfait", None, None),
            ("x_2", "a", "indicatif", "present", "1sm", "p"),
            ("x_2", "a", "indicatif", "imparfait", None, None),
            ("x_2", "b", "indicatif", "present", "1sm", "q"),
            ("y", "a", "indicatif", "present", "1sm", "r"),
        ],
        columns,
    )
    new_verbs, new_rows = h.merge_homonyms(verbs, long)
    assert rows(new_verbs) == [("x", True), ("y", False)]
    assert rows(new_rows, "verb", "voice", "tense", "conjugaison") == [
        ("x", "a", "imparfait", None), ("x", "a", "present", "p"), ("x", "b", "present", "q"), ("y", "a", "present", "r"),
    ]
    again_verbs, again_rows = h.merge_homonyms(new_verbs, new_rows)
    assert rows(again_verbs) == rows(new_verbs) and rows(again_rows) == rows(new_rows)


def test_jobs_do_not_follow_the_chain_of_claims(spark):
    tracker = spark.sparkContext._jsc.sc()

    def jobs_for(length):
        # Each member shares a voice with the next: a chain of claims over the whole group.
        entries = []
        for i in range(length):
            entries += [(f"c_{2 * i:04d}", {"A": str(i)}), (f"c_{2 * i + 1:04d}", {"A": str(i), "B": str(i)} if i % 2 else {"A": str(i), "C": "1"})]
        first = tracker.dagScheduler().numTotalJobs()
        assert names_of(spark, {"c": entries}) == expected_names({"c": entries})
        return tracker.dagScheduler().numTotalJobs() - first

    assert jobs_for(256) <= jobs_for(16) + 12
