"""Jaccard join and vector join against all pairs; connected components."""

import random

import numpy as np
import pytest

from inflecta.llm import jaccard, nearvec
from inflecta.llm.common import Scratch
from inflecta.llm.components import components


def least_reachable(ids, links):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(80), draw.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 160)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), Scratch(spark), "t").collect()))
    want = least_reachable({x for link in links for x in link}, links)
    assert got == {x: c for x, c in want.items() if any(a != b and x in (a, b) for a, b in links)}


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def near_copies(draw):
    base = [f"w{draw.randrange(400)}" for _ in range(60)]
    texts = [" ".join(base)] * 3
    for _ in range(40):  # chains of edits, so that members are far from each other
        words = (draw.choice(texts)).split(" ")
        for _ in range(draw.randrange(1, 3)):
            words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
        texts.append(" ".join(words))
    passage = " ".join(f"p{i}" for i in range(20))
    for _ in range(40):  # share a passage and no more
        texts.append(passage + " " + " ".join(f"u{draw.randrange(10**6)}" for _ in range(draw.randrange(1, 30))))
    return texts


@pytest.mark.parametrize(("chunk", "pairs"), [(1024, 1), (3, 0)])
def test_jaccard_classes(spark, monkeypatch, chunk, pairs):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    monkeypatch.setattr(jaccard, "PAIRS_PER_NODE", pairs)  # 0: further hubs come first
    monkeypatch.setattr(jaccard, "ONE_IN", 1)
    draw = random.Random(9)
    texts = near_copies(draw) + [None, "", "  \n", "one two", "one  TWO", "One two", "a b c d e", "é É x y z", "x " * 3000, "x " * 2000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "no id at all here friend"), (None, "one two")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, node string")
    got = jaccard.classes(docs).collect()
    assert len(got) == len(rows)
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = []
    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                links.append((i, j))
    want = least_reachable(sets, links)
    for row in got:
        if row.doc_id is not None:
            assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), want[row.doc_id])
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == sorted([str(texts.index("one two")), "None"])


def test_jaccard_of_nothing(spark):
    assert jaccard.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in jaccard.classes(spark.createDataFrame([(5, None)], "doc_id long, text string")).collect()] == [(5, 0, 5)]


def test_search_is_exact():
    draw = np.random.default_rng(2)
    for _ in range(200):
        query = np.unique(draw.integers(0, 60, draw.integers(1, 40)).astype(np.uint64))
        sets = [np.unique(draw.integers(0, 60, draw.integers(1, 50)).astype(np.uint64)) for _ in range(draw.integers(1, 30))]
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(query, s)) >= 75 * len(np.union1d(query, s))]
        sizes = np.array([len(s) for s in sets])
        assert sorted(jaccard.search(query, sets, jaccard.whole_need(len(query), sizes, 75))) == want


def test_first_tokens_never_lose_a_link():
    draw = np.random.default_rng(4)
    first = lambda s: s[: len(s) - jaccard.least_overlap(len(s), 75) + 1]
    linked = left_out = 0
    for _ in range(400):
        base = draw.permutation(400)[: draw.integers(1, 60)]
        query = np.unique(base.astype(np.uint64))
        sets = []
        for _ in range(8):
            kept = base[draw.random(len(base)) < draw.choice([1.0, 0.9, 0.8, 0.5])]
            sets.append(np.unique(np.append(kept, draw.integers(0, 400, draw.integers(1, 8))).astype(np.uint64)))
        firsts, sizes = [first(s) for s in sets], np.array([len(s) for s in sets])
        need = jaccard.first_need(len(query), sizes, 75)
        found = jaccard.search(first(query), firsts, need)
        links = jaccard.search(query, sets, jaccard.whole_need(len(query), sizes, 75))
        assert set(links) <= set(found)
        linked, left_out = linked + len(links), left_out + 8 - len(found)
    assert linked > 500 and left_out > 100


@pytest.mark.parametrize("part", [1024, 32, 4])
def test_vector_classes(spark, monkeypatch, part):
    monkeypatch.setattr(nearvec, "PART", part)
    draw = np.random.default_rng(6)
    rows = []
    for label in (1, 2):
        base = draw.standard_normal((6, 20))
        for i in range(70):
            rows.append((base[i % 6] + draw.standard_normal(20) * draw.choice([0.0, 0.1, 0.3]), label))
    rows += [(rows[0][0] * 3, 1), (rows[0][0], None), (np.zeros(20), 1), (np.full(20, np.nan), 1), (rows[0][0][:19], 1), (None, 1), (np.array([]), 2), (np.array([1.0]), 2), (np.array([2.0]), 2)]
    table = [(i, None if v is None else [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)]
    table += [(1000, [*table[0][1][:19], None], 1), table[5]]
    got = nearvec.classes(spark.createDataFrame([(*r, 7) for r in table], "vec_id long, embedding array<float>, label int, n int")).collect()
    assert len(got) == len(table)

    def usable(v, label):
        return v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links, count = [], [0] * len(table)
    for i, (a, v, lv) in enumerate(table):
        for j, (b, w, lw) in enumerate(table):
            if i != j and usable(v, lv) and usable(w, lw) and lv == lw and len(v) == len(w):
                x, y = np.array(v), np.array(w)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    count[i] += 1
                    links.append((a, b))
    want = least_reachable({r[0] for r in table}, links)
    by_id = {r[0]: count[i] for i, r in enumerate(table)}
    for row in got:
        assert (row.n_links, row.component_id, row.kept) == (by_id[row.vec_id], want[row.vec_id], row.vec_id == want[row.vec_id])
    assert sum(count) > 500


def test_cells_within_reach_hold_every_neighbour():
    draw = np.random.default_rng(8)
    points = np.concatenate([draw.standard_normal((600, 4)), np.zeros((50, 4)), np.ones((50, 4)) * draw.standard_normal((50, 1))])
    tree = nearvec.Tree(points[::3], 20)
    rows, own, cell = tree.reached(points, 0.09)
    assert 10 < tree.leaves <= 20 and set(cell) == set(range(tree.leaves)) and len(rows) < 0.6 * len(points) * tree.leaves
    home = dict(zip(rows.tolist(), own.tolist(), strict=True))
    reach = set(zip(rows.tolist(), cell.tolist(), strict=True))
    assert len(home) == len(points) and len(reach) == len(rows)
    apart = ((points[:, None] - points[None]) ** 2).sum(2)
    for a, b in np.argwhere(apart <= 0.09).tolist():
        assert (a, home[b]) in reach
    assert nearvec.Tree(np.zeros((9, 3)), 4).leaves == nearvec.Tree(np.zeros((0, 3)), 4).leaves == 1


@pytest.mark.parametrize("leaves", [3, 1 << 19])
def test_trees_are_bounded(spark, monkeypatch, leaves):
    draw = np.random.default_rng(3)
    monkeypatch.setattr(nearvec, "PART", 8)
    monkeypatch.setattr(nearvec, "LEAVES", leaves)
    table = [(i, [float(x) for x in draw.standard_normal(16)], "a|b") for i in range(120)]
    table += [(200 + i, [x + 0.01 for x in v], label) for i, (_, v, label) in enumerate(table[:60])]
    got = {r.vec_id: r for r in nearvec.classes(spark.createDataFrame(table, "vec_id long, embedding array<double>, label string")).collect()}
    assert all(got[200 + i].component_id == got[i].component_id and got[i].n_links >= 1 for i in range(60))


def test_vectors_of_nothing(spark):
    assert nearvec.classes(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
