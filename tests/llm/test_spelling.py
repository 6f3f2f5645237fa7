"""Spelling variants against all pairs of words."""

import random
import re
import zlib

import pytest

from inflecta.llm import spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(words):
    """(word, form, root, n, n_near, form_n) by comparing all."""
    known = {}
    for word, n in words.items():
        others = [(-m, w) for w, m in words.items() if near(word, w)]
        best = min(others) if others else None
        known[word] = (best[1], -best[0], len(others)) if best and -best[0] >= 10 * n else (None, None, len(others))
    rows = []
    for word, n in words.items():
        root = word
        while known[root][0]:
            root = known[root][0]
        rows.append((word, known[word][0], root, n, known[word][2], known[word][1]))
    return sorted(rows, key=str)


def counted(docs):
    words = {}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] = words.get(run, 0) + 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def some_words(draw, k, letters="aéÿ"):
    words = {}
    base = ["".join(draw.choice(letters) for _ in range(draw.choice([7, 7, 8, 9, 12]))) for _ in range(k)]
    for word in base:
        for _ in range(4):
            at = draw.randrange(len(word))
            word = draw.choice([word, word[:at] + word[at + 1 :], word[:at] + draw.choice(letters) + word[at:], word[:at] + draw.choice(letters) + word[at + 1 :]])
            if len(word) >= 7:
                words[word] = draw.choice([2, 3, 20, 31, 300, 4000, 50000])
    return words


@pytest.mark.parametrize("tile", [2048, 5])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "CELLS", 1 << 12)
    words = some_words(random.Random(tile), 150)
    words |= {"a" * 7: 40, "a" * 8: 400, "a" * 9: 4000, "a" * 3000: 2, "a" * 3001: 30, "a" * 3002: 2}
    got = spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert sorted(map(tuple, got), key=str) == expected(words)
    assert max(r.n_near for r in got) >= 3 and len({r.root for r in got if r.form}) > 10


def test_chain_of_forms(spark):
    words = {"abcdefgh" + "x" * k: 2 * 10**k for k in range(12)}
    got = {r.word: r.root for r in spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"abcdefgh" + "x" * 11}


def test_words_of_documents(spark):
    draw = random.Random(9)
    pool = ["Straßenbahn", "straßenbahn", "HABITUDE", "habitude", "naïveté", "sixsix", "seven77", "Ünderstand", "understand", "x" * 5000]
    docs = [(draw.choice([None, *range(60)]), " ".join(draw.choice(pool) + draw.choice(["", ".", "_", "9"]) for _ in range(draw.randint(0, 60)))) for _ in range(150)]
    docs += [(1, None), (2, ""), (3, "··· 123"), docs[0]]
    table = spark.createDataFrame([(d, t, "w", 1) for d, t in docs], "doc_id long, text string, word string, N long")
    words = spelling.vocabulary(spelling.damaged(spelling.occurrences(table)))
    assert {r.word: r.n for r in words.collect()} == counted(docs)
    got = spelling.grouped(words).collect()
    assert sorted(map(tuple, got), key=str) == expected(counted(docs))


def test_no_words(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.grouped(spelling.vocabulary(spelling.damaged(spelling.occurrences(nothing)))).collect() == []
    one = spark.createDataFrame([("abcdefgh", 2)], "word string, n long")
    assert [tuple(r) for r in spelling.grouped(one).collect()] == [("abcdefgh", None, "abcdefgh", 2, 0, None)]
