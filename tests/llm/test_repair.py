"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import zlib

import pytest

from inflecta.llm import repair

STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
NEW = (("u", "user"), ("a", "assistant"))


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv_id, turn)).encode()) % 20
        if kind:
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """The report of a conversation's rows (turn, role, text): least cost, then least audit, of all edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done, best = [(0, "", 0, 0, ())], set(), None
    while best is None:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in (0, 3):
            best = cost, audit, lines
            continue
        for initial, role in NEW:
            if (state, initial) in STEP:
                heapq.heappush(heap, (cost + 2, audit + "I", at, STEP[state, initial], (*lines, f"{role}:")))
        if at < len(rows):
            _, own, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, lines))
            if faults[at] not in ("blank", "duplicate"):
                late = faults[at] == "truncated"
                if (state, own[:1]) in STEP:
                    heapq.heappush(heap, (cost + late, audit + "K", at + 1, STEP[state, own[:1]], (*lines, f"{own}:{text}")))
                for initial, role in NEW:
                    if (state, initial) in STEP:
                        heapq.heappush(heap, (cost + 2 + late, audit + "R", at + 1, STEP[state, initial], (*lines, f"{role}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    counts = (faults.count(f) for f in ("blank", "duplicate", "truncated"))
    return (gaps, *counts, illegal, best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest())


def by_conversation(rows):
    found = {}
    for row in rows:
        found.setdefault(row[0], []).append(row)
    return found


def invented(draw, conversations):
    rows = []
    for conv_id in conversations:
        for turn in range(draw.choice([1, 2, 5, 9, 40])):
            text = draw.choice([None, "", " \t", "Yes.", "No", "Well, yes!  ", f"Turn {turn}.", "long " * 50, "…"])
            rows.append((conv_id, draw.choice([None, turn, turn, turn, turn + 1]), draw.choice([None, "user", "assistant", "system", "tool", "", "übel"]), text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, Present boolean, block int"


@pytest.mark.parametrize("size", [256, 3])
def test_reports_are_those_of_all_edits(spark, monkeypatch, size):
    monkeypatch.setattr(repair, "BLOCK_ROWS", size)
    rows = invented(random.Random(size), [None, *range(120)])
    rows += rows[:40]
    table = spark.createDataFrame([(*r, None, 1) for r in rows], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in repair.reports(repair.damaged(table), present="present").collect()}
    assert got == {conv_id: cheapest(damage(own)) for conv_id, own in by_conversation(rows).items()}
    plain = {r.conv_id: tuple(r)[1:] for r in repair.reports(table).collect()}
    own = by_conversation((c, t, *(" " if v is None else v for v in (r, x))) for c, t, r, x in rows)
    assert plain == {conv_id: cheapest([r[1:] for r in some]) for conv_id, some in own.items()}


def test_a_long_conversation_over_many_slices(spark, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    draw = random.Random(11)
    rows = [(7, turn, draw.choice(["user", "assistant", "assistant", "system"]), draw.choice([f"Line {turn}.", f"cut {turn}", "Again."])) for turn in range(3000)]
    rows += [(8, 0, "user", "Hello."), (8, 1, "assistant", "Good day.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert repair._ordered(repair._prepared(table, None)).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).filter(lambda n: n > 0).count() > 1
    got = {r.conv_id: tuple(r)[1:] for r in repair.reports(table).collect()}
    assert got == {conv_id: cheapest([r[1:] for r in own]) for conv_id, own in by_conversation(rows).items()}
    texts = [r for r in repair.messages(table).collect() if r.conv_id == 7]
    kept = sorted((r.place, r.role, r.text) for r in texts if r.role is not None)
    assert [place for place, _, _ in kept] == list(range(1, len(kept) + 1))
    assert hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in kept).encode()).hexdigest() == got[7][-1]
    assert len(texts) == len(got[7][-2])


def test_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.reports(repair.damaged(empty), present="present").collect() == []
    gone = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    only = spark.createDataFrame([(5, gone, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    (row,) = repair.reports(repair.damaged(only), present="present").collect()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_any_split_gives_the_same_cells():
    draw = random.Random(13)
    kinds = [(i, g, t) for i in ("s", "u", "a", "") for g in (False, True) for t in (False, True)]
    for _ in range(100):
        own = [draw.choice(kinds) for _ in range(draw.randint(2, 30))]
        at = draw.randint(1, len(own) - 1)
        whole = repair.span_cells(own)
        assert repair.joined(repair.span_cells(own[:at]), repair.span_cells(own[at:])) == whole
        chart = {(k, k + 1): repair.row_cells(kind) for k, kind in enumerate(own)}
        for length in range(2, min(len(own), 8) + 1):  # every split of every span
            for k in range(len(own) - length + 1):
                ways = [repair.joined(chart[k, m], chart[m, k + length]) for m in range(k + 1, k + length)]
                assert all(way == ways[0] for way in ways)
                chart[k, k + length] = ways[0]
