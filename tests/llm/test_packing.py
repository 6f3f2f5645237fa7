"""Packing against best fit decreasing piece by piece, and against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from inflecta.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [room for room in rooms if room >= length]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - length)
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


def test_rounds_are_best_fit_decreasing():
    draw = random.Random(3)
    for trial in range(300):
        capacity = draw.choice([1, 5, 10, 37, 100])
        lengths = [draw.randint(1, draw.randint(1, capacity)) for _ in range(draw.randint(0, 150))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        runs = packing.rounds(counts, capacity)
        used = {}
        for k, (length, rank, first, each, offset) in enumerate(runs):
            end = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == length else counts[length]
            for r in range(rank, end):
                sequence, slot = first + (r - rank) // each, (r - rank) % each
                assert used.get(sequence, 0) == offset + slot * length
                used[sequence] = offset + (slot + 1) * length
        assert sorted(capacity - n for n in used.values()) == best_fit_decreasing(lengths, capacity), trial


def test_encoder_is_the_tokenizers():
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    encode, draw = packing.Encoder(PATH), random.Random(5)
    letters = "abc  \n\t.,'sé中ا🙂́  1²Ⅷ_<|endoftext|>"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 300))) for _ in range(300)]
    for text in [*texts, "", " " * 1_000_000 + "x", "ab" * 100_000]:
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_cuts():
    assert packing.cuts(1, 4) == [(0, 1)]
    assert packing.cuts(4, 4) == [(0, 4)]
    assert packing.cuts(8, 4) == [(0, 4), (4, 4)]
    assert packing.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_packed_documents(spark):
    draw = random.Random(7)
    docs = [(k, " ".join(draw.choice(["tree", "ünder", "x1", "\n"]) for _ in range(draw.choice([0, 3, 40, 400, 3000])))) for k in range(120)]
    docs += [(500, None), (501, ""), (None, "no id"), (None, "no id"), (7, docs[7][1])]
    rows = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, Length string, sequence_id long")
    cut = packing.pieces(rows, PATH, ids=True)
    placed = packing.packed(cut).collect()
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    want = sorted(
        (d or -1, k, start, length, zlib.crc32(np.array((ids := [*plain.encode(t or "", add_special_tokens=False).ids, 2])[start : start + length], "<u4").tobytes()))
        for d, t in docs
        for k, (start, length) in enumerate(packing.cuts(len(plain.encode(t or "", add_special_tokens=False).ids) + 1, 1024))
    )
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in placed) == want
    by_sequence = {}
    for r in placed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_sequence) == len(best_fit_decreasing([r.length for r in placed], 1024))
    whole = {r.sequence_id: r.ids for r in packing.sequences(packing.packed(cut)).collect()}
    assert sorted(map(len, whole.values())) == sorted(max(o + n for o, n in spans) for spans in by_sequence.values())


def test_one_length_is_spread_and_empty_tables(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "100L AS length", "id AS ids_crc32")
    placed = packing.packed(rows).groupBy("sequence_id").count().collect()
    assert len(placed) == 500 and all(r["count"] == 10 for r in placed)
    assert packing.packed(rows.limit(0)).collect() == []
    assert packing.pieces(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    with pytest.raises(ValueError, match="sequence_id"):
        packing.packed(rows.withColumn("Sequence_ID", rows.doc_id))
    with pytest.raises(ValueError, match="lengths"):
        packing.packed(rows.selectExpr("doc_id", "piece", "2000L AS length", "ids_crc32"))
