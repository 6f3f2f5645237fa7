"""Classifiers on held-out rows and edge cases; gradients; url rules and propagation against plain Python."""

import random
import re
import zlib

import numpy as np
import pytest

from inflecta.llm import langid, quality, toxicity, urlfilter
from inflecta.llm.common import Scratch, labelled_sample

SYLLABLES = {"aa": "lo mi ra ten sul".split(), "bb": "krü sch ögt wen plo".split()}


def prose(draw, lang="aa", n=40):
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def held_out(doc_id, folds=5):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_quality(spark):
    draw, docs, labels = random.Random(1), [], []
    for i in range(300):
        good = i % 3 > 0
        text = prose(draw) if good else " ".join(w + "###" for w in prose(draw).split()) if i % 2 else (draw.choice(["lomi ", "ten "]) * 40)
        docs.append((i, text))
        labels.append((i, int(good), None if i % 2 else 1))
    docs += [(1000, None), (1001, ""), (1002, "one"), (1003, prose(draw, n=5000)), (0, docs[0][1])]
    labels += [(0, 0, 1), (5000, 1, 0), (None, 1, 1), (7, 5, 0)]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(frame, known, "quality")
    got = quality.predictions(frame, model).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    judged = [r for r in got if r.doc_id < 300 and r.held_out]
    assert all(r.held_out == (held_out(r.doc_id) == 0) for r in got) and len(judged) > 30
    assert np.mean([r.predicted == (r.doc_id % 3 > 0) for r in judged]) > 0.95
    assert next(r.predicted for r in got if r.doc_id == 1003) == 1
    # The same rows in every run, whatever the partitions.
    again = quality.train(frame.repartition(7), known.repartition(3), "quality")
    assert again.score(np.array([5, 9])) == model.score(np.array([5, 9]))


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 1), (2, 1)]])
def test_models_without_two_classes(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, y int")
    for rows in (quality.predictions(docs, quality.train(docs, known, "y")), toxicity.predictions(docs, toxicity.train(docs, known, "y"))):
        assert {0 <= r.score <= 1 for r in rows.collect()} == {True}
    assert quality.predictions(docs.limit(0), quality.train(docs.limit(0), known, "y")).count() == 0


def test_sample_leaves_out_the_held_out_fold(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(200)], "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, y int")
    ids = {r.doc_id for r in labelled_sample(docs, known, "y", 30).collect()}
    assert len(ids) == 60 and all(held_out(i) for i in ids)
    later = {r.doc_id for r in labelled_sample(docs, known, "y", 30, skip=30).collect()}
    assert len(later) == 60 and not later & ids


def test_dual_descent_reaches_the_primal_optimum():
    draw = np.random.default_rng(3)
    rows = [np.unique(draw.integers(0, 12, 5)) for _ in range(60)]
    signs = np.where(draw.random(60) < 0.5, 1.0, -1.0)
    scale, cost = draw.standard_normal(12), np.full(60, 0.3)
    w = quality.hinge_by_dual_descent(rows, signs, scale, cost, rounds=2000)
    x = np.zeros((60, 13))
    for i, r in enumerate(rows):
        x[i, r] = scale[r]
    x[:, 12] = 1

    def primal(v):
        return 0.5 * v @ v + (cost * np.maximum(0, 1 - signs * (x @ v))).sum()

    assert all(primal(w) <= primal(w + draw.standard_normal(13) * 0.05) + 1e-3 for _ in range(200))


def test_language(spark):
    draw, docs = random.Random(2), []
    for i in range(240):
        docs.append((i, prose(draw, "aa" if i % 2 else "bb", 12), "aa" if i % 2 else "bb"))
    docs += [(500, None, "aa"), (501, "123 !?", "aa"), (502, "", None), (503, prose(draw, "bb", 100000), None), (504, "lo", None), (1, docs[1][1], "aa")]
    frame = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, lang string, score double")
    got = langid.predictions(frame).collect()
    assert len(got) == len(docs)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (500, 501, 502)) and by_id[503].lang_pred == "bb"
    judged = [r for r in got if r.held_out and r.doc_id < 240]
    assert all(r.held_out == (held_out(r.doc_id, 3) == 1) for r in got)
    assert len(judged) > 50 and np.mean([r.lang_pred == ("aa" if r.doc_id % 2 else "bb") for r in judged]) > 0.97
    assert {r.lang_pred for r in langid.predictions(frame.where("lang IS NULL")).collect()} == {"und"}
    assert langid.predictions(frame.limit(0)).count() == 0
    model = langid.train(frame)
    assert (model.weights == 0).mean() > 0.5  # sparse


def test_gram_counts_do_not_depend_on_the_piece(monkeypatch):
    text = prose(random.Random(4), n=300)
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "PIECE", 17)
    assert (langid.gram_counts(text) == whole).all()


def test_gradients():
    network = toxicity.Network()
    network.params.update({k: v.astype(np.float64) for k, v in network.params.items()})
    windows, labels = [["abc", "loser", "x"], ["hello"], []], np.array([1.0, 0.0, 1.0])

    class Shown:
        def random(self, n):
            return np.zeros(n)

    def loss():
        return network.step(windows, labels, np.ones(3), Shown())[0]

    _, grads = network.step(windows, labels, np.ones(3), Shown())
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        value, network.params[name][at] = network.params[name][at], network.params[name][at] + 1e-4
        above = loss()
        network.params[name][at] = value - 1e-4
        below = loss()
        network.params[name][at] = value
        assert abs((above - below) / 2e-4 - g[at]) < 1e-3 * max(1e-3, abs(g[at])) + 2e-6, name


def test_toxicity(spark):
    draw, docs, labels = random.Random(5), [], []
    for i in range(360):
        words = prose(draw, "aa", draw.randrange(5, 60)).split()
        if i % 3 == 0:  # a stem with endings never met before
            words.insert(draw.randrange(len(words)), "zwk" + "".join(draw.choice("aeiou") for _ in range(4)))
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs += [(1000, None), (1001, ""), (1002, "... !"), (1003, prose(draw, n=3000) + " zwkaoia " + prose(draw, n=3000)), (1004, "x" * 5000)]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, logit int")
    got = {r.doc_id: r for r in toxicity.predictions(frame, toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic")).collect()}
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got.values())
    judged = [r for r in got.values() if r.held_out and r.doc_id < 360]
    assert len(judged) > 40 and np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in judged]) > 0.9
    assert got[1000].score == got[1001].score == got[1002].score < 0.5
    assert got[1003].score > np.median([r.score for r in judged])  # whole texts are read


def test_windows_cover_all_words():
    for n in range(100):
        covered = {i for s, e in toxicity.windows_of(n) for i in range(s, e)}
        assert covered == set(range(n)) and all(e - s <= toxicity.WINDOW for s, e in toxicity.windows_of(n))


def by_every_start(network, words):
    """The highest logit, word by word and window by window."""
    p, size = network.params, toxicity.HIDDEN
    gates = network.word_gates(words) if words else np.zeros((0, 6 * size))

    def read(order, way):
        h = np.zeros(size)
        for i in order:
            x, g = gates[i][way * 3 * size : (way + 1) * 3 * size], h @ p["w.U"][way]
            z, r = (1 / (1 + np.exp(-(x[a : a + size] + g[a : a + size]))) for a in (0, size))
            h = z * h + (1 - z) * np.tanh(x[2 * size :] + r * g[2 * size :])
        return h

    states = []
    for i in range(len(words)):
        half = i // 8 * 8
        states.append(np.concatenate([read(range(max(0, half - 8), i + 1), 0), read(range(min(len(words), half + 16) - 1, i - 1, -1), 1)]))
    best = []
    for start in range(max(1, len(words) - 15)):
        own = np.array(states[start : start + 16]).reshape(-1, 2 * size)
        weight = np.exp(np.tanh(own @ p["w.A"] + p["w.c"]) @ p["w.v"])
        best.append((weight @ own / max(weight.sum(), 1e-300)) @ p["out"][:-1] + p["out"][-1])
    return max(best)


def test_every_window_is_scored(monkeypatch):
    draw, network = random.Random(6), toxicity.Network()
    texts = [prose(draw, n=n) for n in (1, 7, 8, 9, 15, 16, 17, 23, 24, 25, 31, 32, 33, 60, 200)] + [None, "", "?!"]
    wanted = np.array([by_every_start(network, toxicity.words_of(t)) for t in texts])
    assert np.abs(toxicity.Scorer(network).highest(texts) - wanted).max() < 1e-4
    short = [toxicity.words_of(t) for t in texts[:6]]
    assert np.abs(toxicity.Scorer(network).window_logits(short) - wanted[:6]).max() < 1e-4  # what training sees
    monkeypatch.setattr(toxicity, "RUN", 3)
    assert np.abs(toxicity.Scorer(network).highest(texts[::-1]) - wanted[::-1]).max() < 1e-4
    assert len(toxicity.Scorer(network).highest([])) == 0


def test_toxicity_columns_empty_and_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b")] * 50 + [(2, "c"), (3, None), (4, "d")], "doc_id long, text string")
    known = spark.createDataFrame([(1, 0), (2, 1), (4, 1)], "doc_id long, y int")
    assert labelled_sample(docs, known, "y", 1).count() <= 2  # rows are bounded, not ids alone
    with pytest.raises(ValueError):
        toxicity.logits(docs.withColumnRenamed("text", "LOGIT").withColumnRenamed("doc_id", "text"), toxicity.Network())
    assert toxicity.predictions(docs.limit(0), toxicity.Network()).count() == 0
    assert toxicity.predictions(docs, toxicity.train(docs, known, "y")).count() == 53


URLS = [
    None, "", "no scheme", "http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "http://example.com/en", "http://notexample.com/en/a",
    "x://b.net/es/1", "http://b.net/fr/2", "http://b.net/de/?a=/fr/", "http://net/es/", "http://c.org", "http://c.org?x=http://d.com/", "http://u@e.com:80/p#/en/", "://y.com/", "http://ÉX.com/en/",
]


def by_hand(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(URLS)] + [(3, URLS[3], "<a>", "x")], "page_id long, url string, html string, rule string")
    got = urlfilter.verdicts(pages).collect()
    assert len(got) == len(URLS) + 1
    for row in got:
        host, path, rule, verdict = by_hand(URLS[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule) and row.verdict == (verdict or row.verdict) and row.verdict in ("allow", "block")
    assert next(r.verdict for r in got if r.page_id == 0) == "allow"
    assert urlfilter.verdicts(pages.limit(0)).count() == 0


def test_links_and_propagation(spark):
    html = '<a href="http://bad.net/1">x</a><A HREF=//good.com/>y</a><a href="/own">z</a><a href="http://BAD.net/2">w</a>'
    edges = urlfilter.host_edges(spark.createDataFrame([(1, "http://a.org/", html), (2, "http://a.org/b", None)], "page_id long, url string, html string"))
    assert sorted(map(tuple, edges.collect())) == [("a.org", "bad.net", 2), ("a.org", "good.com", 1)]
    links = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "d", 1), ("e", "a", 1)]
    seeds = [("a", 3, 0), ("d", 0, 1), ("b", 1, 1)]
    got = urlfilter.propagated(spark.createDataFrame(links, "a string, b string, links long"), spark.createDataFrame(seeds, "host string, trust long, distrust long"), Scratch(spark), rounds=7)
    names = "abcde"
    for kind, column in (("trust", 1), ("distrust", 2)):
        move, start = np.zeros((5, 5)), np.zeros(5)
        for a, b, n in links:
            i, j = (names.index(a), names.index(b)) if kind == "trust" else (names.index(b), names.index(a))
            move[i, j] += n
        for s in seeds:
            start[names.index(s[0])] = s[column]
        start /= start.sum()
        stuck = move.sum(1) == 0
        move /= np.where(stuck, 1, move.sum(1))[:, None]
        rank = start
        for _ in range(7):
            rank = 0.85 * (rank @ move) + start * (0.15 + 0.85 * rank[stuck].sum())
        for row in got.collect():
            assert abs(row[kind] - rank[names.index(row.host)]) < 1e-12


def test_a_host_that_links_to_blocked_ones_is_blocked(spark):
    rows = [(1, "http://bad.net/es/", None), (2, "http://spam.org/x", '<a href="http://bad.net/">'), (3, "http://ok.org/x", "<a href='http://fine.com/'>"), (4, "http://fine.com/", None)]
    got = {r.page_id: r.verdict for r in urlfilter.verdicts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow"}


def test_a_minority_of_blocked_pages_gives_distrust(spark):
    rows = [(i, f"http://half.net/{'es' if i < 2 else 'de'}/{i}", None) for i in range(10)]  # two of ten blocked, the others undecided
    rows += [(20, "http://www.example.com/en/", None), (21, "http://fair.org/", None), (22, "http://example.com/de/", None)]
    got = {r.page_id: r for r in urlfilter.verdicts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[5].rule is None and abs(got[5].distrust - 1) < 1e-12 and got[5].trust == 0
    assert {got[i].verdict for i in range(10)} == {"block"} and {got[i].verdict for i in (20, 21, 22)} == {"allow"}


def test_rounds_go_on_to_the_end_of_a_chain(spark):
    link = lambda i: f"<a href='http://h{i - 1}.org/'>" if i > 1 else "<a href='http://bad.net/'>"
    rows = [(0, "http://bad.net/es/", None), *((i, f"http://h{i}.org/", link(i)) for i in range(1, 11))]  # h10 is ten links from the blocked page
    got = {r.page_id: r for r in urlfilter.verdicts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(r.verdict == "block" and r.distrust > 0 for r in got.values())
    # In the limit each host of the chain holds 0.85 of the one before; the last one's share goes back to the seed.
    assert all(abs(got[i].distrust / got[i - 1].distrust - 0.85) < 1e-5 for i in range(1, 11))
    assert abs(sum(r.distrust for r in got.values()) - 1) < 1e-9
