"""Line deduplication and decontamination against brute force."""

import random
from collections import defaultdict

import pytest

from inflecta.llm import decontam, langid, linededup, quality


def without_later_copies(docs, min_words):
    """docs: texts in order. For each line the longest run from it on that occurs earlier, by comparing all."""
    seen, out = defaultdict(list), []
    cut = [t.split("\n") for t in docs]
    for a, lines in enumerate(cut):
        gone = set()
        for b, line in enumerate(lines):
            best = 0
            for c, d in seen[line]:
                n = 0
                while b + n < len(lines) and d + n < len(cut[c]) and lines[b + n] == cut[c][d + n]:
                    n += 1
                best = max(best, n)
            seen[line].append((a, b))
            if best and sum(len(x.split()) for x in lines[b : b + best]) >= min_words:
                gone.update(range(b, b + best))
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


@pytest.mark.parametrize(("seed", "size"), [(1, 7), (2, 1 << 17)])
def test_runs(spark, monkeypatch, seed, size):
    monkeypatch.setattr(linededup, "SLICE", size)
    draw, docs = random.Random(seed), []
    base = [f"l{i} " * draw.randrange(0, 4) for i in range(10)]
    for _ in range(50):
        lines = [draw.choice(base) for _ in range(draw.randrange(1, 9))]
        if docs and draw.random() < 0.5:
            other = draw.choice(docs).split("\n")
            at = draw.randrange(len(other))
            lines = lines[:2] + other[at : at + draw.randrange(1, 7)] + lines[2:]
        docs.append("\n".join(lines))
    docs += ["x y z\n" * 40, "x y z\n" * 40, "", "unique line"]
    frame = spark.createDataFrame([(i, t, "e") for i, t in enumerate(docs)], "doc_id long, text string, pos string")
    got = {r.doc_id: r for r in linededup.deduplicated(frame, 5).collect()}
    want = without_later_copies(docs, 5)
    assert [got[i].text for i in range(len(docs))] == want
    assert all(r.pos == "e" and r.n_lines == docs[i].count("\n") + 1 for i, r in got.items())


def test_repeated_rows_nulls_and_nothing(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (1, long), (2, long), (3, None), (None, long + "\nend"), (4, "")]
    got = sorted((str(r.doc_id), r.text, r.n_deleted) for r in linededup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    # The row without an id comes first and keeps its copy.
    assert got == sorted([("1", "", 1), ("1", "", 1), ("2", "", 1), ("3", None, 0), ("None", long + "\nend", 0), ("4", "", 0)], key=lambda r: r[0])
    assert linededup.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def items_and_texts(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefgh") + str(draw.randrange(60))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + ". "
    items = [(i, sentence(draw.randrange(6, 20)) + sentence(draw.randrange(4, 12))) for i in range(40)] + [(40, "One sentence alone with a few words."), (41, None), (42, "...")]
    items.append((43, items[0][1]))
    texts = []
    for _ in range(120):
        text = "".join(sentence(draw.randrange(5, 15)) for _ in range(draw.randrange(0, 25)))
        if draw.random() < 0.4:
            text += draw.choice(items[:41])[1] + sentence(9)
        texts.append(text)
    return items, texts


def test_wand_finds_what_scoring_all_finds(spark, monkeypatch):
    items, texts = items_and_texts(3)
    texts += [None, "", "?!", items[2][1] * 500]
    monkeypatch.setattr(decontam, "SHARD_ITEMS", 1000)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.leaks(docs, frame).collect()}
    index = decontam.Index([(i, t) for i, t in items if t])
    searcher = decontam.Searcher(index, decontam.LEAST, decontam.QUESTION, decontam.ANSWER)
    for i, text in enumerate(texts):
        words, best = decontam.words_of(text), {}
        starts = range(0, max(1, len(words) - searcher.step), searcher.step)
        for start in starts:
            passage = words[start : start + searcher.size]
            for number, item in enumerate(index.items):
                score = sum(w for t, (ns, ws) in enumerate(zip(index.numbers, index.weights, strict=True)) if list(index.terms)[t] in passage for n, w in zip(ns, ws, strict=True) if n == number) if i < 30 else None
                if score is None:
                    continue
                hit = index.search([index.terms[w] for w in set(passage) if w in index.terms], decontam.LEAST)
                assert (score >= decontam.LEAST - 1e-12) == (number in dict(hit)) or abs(score - decontam.LEAST) < 1e-9
                best[item] = max(best.get(item, 0), score)
        for item, text_ in items:
            if text and text_ and text_.strip() in text and decontam.words_of(text_):
                assert (i, item) in got
    assert len({d for d, _ in got}) >= 30 and (len(texts) - 1, 2) in got
    assert decontam.leaks(docs, frame.limit(0)).count() == 0 and decontam.leaks(docs.limit(0), frame).count() == 0


def test_shards_cover_all_items(spark, monkeypatch):
    items, texts = items_and_texts(4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "SHARD_ITEMS", 15)
    found = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, frame).collect()}
    for i, text in enumerate(texts):
        for item, own in items:
            if own and decontam.words_of(own) and own.strip() in text:
                assert (i, item) in found


def test_one_and_ten_shards_give_equal_rows(spark, monkeypatch):
    items, texts = items_and_texts(6)
    draw = random.Random(7)
    items += [(50, " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(60)}" for _ in range(300)) + ".")]  # widens no other item's passages
    for i, text in items[:41]:  # copies with words left out, so that scores lie on both sides of the limit
        for share in (0.6, 0.7, 0.8, 0.9):
            texts.append(" ".join(w for w in text.split() if draw.random() < share) + " " + draw.choice(texts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = {}
    for most in (1000, 5):
        monkeypatch.setattr(decontam, "SHARD_ITEMS", most)
        result = decontam.leaks(docs, frame)
        assert result._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1  # one worker a task
        found[most] = sorted(map(tuple, result.collect()))
    assert len(found[1000]) > 80 and found[1000] == found[5]


def test_names_of_the_caller(spark):
    run = " ".join(f"w{i}" for i in range(9))
    rows = [(1, f"{run}\nx", 5, 6, 7, 8), (2, f"y\n{run}", 5, 6, 7, 8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _h int, d int, gone int, h int")
    got = {r.doc_id: r for r in linededup.deduplicated(frame, 5).collect()}
    assert got[2].text == "y" and got[1].n_deleted == 0 and tuple(got[2])[2:6] == (5, 6, 7, 8)
    for name, apply in (("N_LINES", linededup.deduplicated), ("Lang_Pred", lambda f: langid.identified(f, None)), ("SCORE", lambda f: quality.scored(f, None))):
        with pytest.raises(ValueError):
            apply(frame.withColumnRenamed("d", name))
    with pytest.raises(ValueError):
        decontam.matched(frame.withColumnRenamed("d", "Matches"), frame)
