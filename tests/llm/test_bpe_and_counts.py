"""Byte-level BPE against tiktoken, its round trip, and edit-aware counts against encoding anew."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from inflecta.llm import bpe, counts

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [
    None, "", " ", "a", "Hello  world", " two  blanks \n\n line", "it's we'll don't", "x" * 5000, "ab" * 3000 + " " * 700 + "\t\n", "日本語 ñandú 😀😀", "1234567 3.14",
    "a b   c", "end ", "\x00\x1c \x1f", "It's  a \n b",
]


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(bpe.load_ranks(PATH))


def test_encode_and_decode(spark, reference):
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS + TEXTS[3:5])], "doc_id long, text string, decoded_text string")
    rows = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        assert row.token_ids == reference.encode_ordinary(row.text or "") and bytes(row.decoded) == (row.text or "").encode() and row.decoded_text == "kept"
    assert bpe.token_digests(docs.limit(0), PATH, PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumnRenamed("decoded_text", "token_ids"), PATH, PATTERN)


def test_random_texts(reference, merges):
    draw = random.Random(3)
    texts = ["".join(draw.choice("aab'sreT 1  \n\té漢") for _ in range(draw.randrange(80))) for _ in range(3000)]
    encoder = bpe.Encoder(merges, PATTERN)
    for text, ids in zip(texts, encoder.ids(texts), strict=True):
        assert np.frombuffer(b"".join(ids), np.int32).tolist() == reference.encode_ordinary(text)
        assert "".join(bpe.chunks_of(text, ids)) == text


def test_lesser_rank_made_by_a_merge():
    # "abcd" comes of ab + cd and has a lesser rank than "abc"; a + bc + d makes it in another way.
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"abcd": 257, b"abc": 258, b"dd": 259}
    reference = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    own, draw = bpe.Merges(ranks), random.Random(4)
    for _ in range(500):
        piece = "".join(draw.choice("abcd") for _ in range(draw.randrange(1, 30)))
        assert bpe.encode_pieces([piece.encode()], own)[0].tolist() == reference.encode_ordinary(piece)


def test_edits_count_as_encoding_anew(spark, reference):
    draw, rows = random.Random(5), []
    for i in range(60):
        text = "".join(draw.choice(["the ", "cat", " ", "\n", "ab's ", "12", "é"]) for _ in range(draw.randrange(60)))
        edits = [(draw.randrange(-2, 90), draw.randrange(0, 95), draw.choice(["", " ", "x y", "\n", None, "'s"])) for _ in range(draw.randrange(5))]
        rows.append((i, text, edits))
    rows += [(60, None, [(0, 0, "new text")]), (61, "abc", None), (62, "", [None, (None, None, "z")]), (61, "abc", None)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, edits {counts.EDITS}")
    done = counts.apply_edits(counts.build_trees(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert len(done) == len(rows)
    for row, (_, text, edits) in zip(sorted(done, key=lambda r: r.doc_id), sorted(rows, key=lambda r: r[0]), strict=True):
        before, text = text, text or ""
        for edit in edits or []:
            if edit is not None:
                start = min(max(edit[0] or 0, 0), len(text))
                end = min(max(edit[1] or 0, start), len(text))
                text = text[:start] + (edit[2] or "") + text[end:]
        assert (row.text or "") == text and row.n_tokens == len(reference.encode_ordinary(text)), (before, edits)
        assert row.n_tokens_before == len(reference.encode_ordinary(before or ""))
        leaves = np.frombuffer(bytes(row.leaf_chars), np.int32)
        assert leaves.sum() == len(text) and np.frombuffer(bytes(row.token_tree), np.int32)[1] == row.n_tokens


@pytest.mark.parametrize("text", [
    "word " * 20000, "word " * 20000 + "end", "two  blanks " + "word " * 20000, "    indented\n" * 9000, "line\n" * 20000, "line\r\n\n" * 15000,
    "a, b.  c\n\n" * 10000, "漢字、仮名。" * 17000, " lead" * 20000, "x=1;y=2;" * 12000,
])
def test_only_the_touched_region_is_encoded(reference, merges, text):
    encoder = bpe.Encoder(merges, PATTERN)
    (chars, tokens), = encoder.counts([text])
    assert chars.sum() == len(text) and tokens.sum() == len(reference.encode_ordinary(text))
    counted = counts.CountedText(text, chars, counts.sums_above(tokens), encoder)
    counted.edit(50000, 50004, "other")
    assert counted.encoded < 100 and counted.tokens[1] == len(reference.encode_ordinary(counted.text))
    for _ in range(100):
        counted.edit(50001, 50001, "new word, ")
    assert counted.encoded < 30000 and counted.tokens[1] == len(reference.encode_ordinary(counted.text))
    counted.edit(50001, 50001, "long insertion " * 1000)
    before = counted.encoded
    counted.edit(60000, 60003, "")
    assert counted.encoded < before + 300 and counted.tokens[1] == len(reference.encode_ordinary(counted.text))


def test_pieces_are_encoded_by_themselves(reference):
    draw = random.Random(8)
    for _ in range(4000):
        text = "".join(draw.choice("ab'sl1,/é漢。\u0301\r\n\n   ") for _ in range(draw.randrange(30)))
        pieces = bpe.pieces_of(text)
        assert "".join(pieces) == text and sum((reference.encode_ordinary(p) for p in pieces), []) == reference.encode_ordinary(text), text


def test_random_edits(reference, merges):
    draw, encoder = random.Random(9), bpe.Encoder(merges, PATTERN)
    for _ in range(200):
        text = "".join(draw.choice("ab'sl1,é漢。\r\n\n    ") for _ in range(draw.randrange(80)))
        (chars, tokens), = encoder.counts([text])
        counted = counts.CountedText(text, chars, counts.sums_above(tokens), encoder)
        for _ in range(15):
            at = draw.randrange(len(counted.text) + 2)
            counted.edit(at, at + draw.randrange(6), "".join(draw.choice("a's,\n  ") for _ in range(draw.choice([0, 1, 3, 40]))))
            assert counted.tokens[1] == len(reference.encode_ordinary(counted.text)) and counted.chars[1] == len(counted.text)


def test_clashes_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, N_Tokens string")
    with pytest.raises(ValueError):
        counts.build_trees(docs, PATH, PATTERN)
    with pytest.raises(ValueError):
        bpe.encode(docs, PATH, PATTERN, ids="n_tokens")
    assert counts.counts_after_masking(docs.limit(0), PATH, PATTERN).count() == 0


def test_masking(spark, reference):
    docs = spark.createDataFrame([(1, "mail a.b@c.org or 5551234 now"), (2, None), (3, "none")], "doc_id long, text string")
    rows = {r.doc_id: r for r in counts.counts_after_masking(docs, PATH, PATTERN).collect()}
    assert rows[1].n_edits == 2 and rows[1].n_tokens == len(reference.encode_ordinary("mail *** or *** now"))
    assert rows[2].n_tokens == 0 and rows[3].n_edits == 0
