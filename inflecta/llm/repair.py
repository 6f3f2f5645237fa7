"""Repair of damaged conversations by weighted interval parsing.

**Grammar.** A repaired conversation reads ``(s?(ua)+)?`` in the initials of its roles. Reading it passes through four
states: nothing yet (0), after a system message (1), after a user's (2), after an assistant's (3); it may end in 0 or 3.
The repair grammar is in Chomsky normal form: X_pq stands for rows read from state p to state q, with the rules
X_pq → X_pr X_rq and X_pq → one row kept, given another role or deleted, closed under insertions on either side of the row.

**Cells.** A span of rows has a cell for each X_pq: the least cost and, of the audits (initials of the edits in order)
of that cost, the least. Cells are combined bottom-up by the length of spans: 1, 2, 4 … Since X_pq covers every way from
p to q, a span may be split anywhere with the same result, so one split for each span does, not all of them. The least
audit of a span is made of least audits of its parts: two audits of equal cost over the same rows never begin one
another (they could differ by insertions only, which cost), so their order is that of their first difference.

**Spark.** Rows are sorted into slices by range, so a conversation of any length is spread over slices; within a
slice blocks of bounded rows and bytes are parsed. Then the cells of a conversation meet (a few letters a row, as long
as its audit, which is one value of the result), and its blocks stream past them once more in their order, one at a
time, to give the repaired texts. Digests of a conversation are sequential by nature, so that last pass is one task for
each conversation, in the memory of one block.

**Inputs.** Rows are taken by turn, NULL first; rows of one turn by role, then by text; NULL roles and texts count as one
space. Equal rows of one turn stay in one slice, in bounded memory. NULL ids make one conversation. Empty tables give no
rows. Other columns of the input, whatever their names, end here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inflecta.llm.common import Scratch

#: Costs of the edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: A block of rows: so many rows or characters, whichever comes first (one row at least).
BLOCK_ROWS, BLOCK_CHARS = 256, 1 << 18
#: Tables of cells are remembered for spans of so many rows.
REMEMBERED = 16

Cell = tuple[int, str]
Cells = tuple["Cell | None", ...]
Kind = tuple[str, bool, bool]

#: What an initial read in a state leads to.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLES = {"u": "user", "a": "assistant"}
STATES, ENDS = range(4), (0, 3)


def _insertions() -> dict[tuple[int, int], Cell]:
    """Cheapest insertions from state to state; none at all from a state to itself."""
    found = {}
    for p in STATES:
        q, audit = p, ""
        while (p, q) not in found:
            found[p, q] = (INSERT * len(audit), audit)
            q, audit = STEP[q, WANTED[q]], audit + "I"
    return found


INSERTED = _insertions()


def _row_edits(kind: Kind) -> Iterator[tuple[int, int, Cell]]:
    """(p, q, cell) of each edit of a row: its initial, whether it must go, whether it is truncated."""
    initial, must_go, truncated = kind
    for p in STATES:
        yield p, p, (DELETE, "D")
        if not must_go:
            extra = TRUNCATED if truncated else 0
            if (p, initial) in STEP:
                yield p, STEP[p, initial], (KEEP + extra, "K")
            yield p, STEP[p, WANTED[p]], (REROLE + extra, "R")


@lru_cache(maxsize=64)
def row_cells(kind: Kind) -> Cells:
    """Cells of a span of one row, closed under insertions before and after it."""
    best: list[Cell | None] = [None] * 16
    for p, q, (cost, audit) in _row_edits(kind):
        for (a, b), (before, first) in INSERTED.items():
            for (c, d), (after, last) in INSERTED.items():
                if b == p and c == q:
                    cell = (before + cost + after, first + audit + last)
                    if best[4 * a + d] is None or cell < best[4 * a + d]:
                        best[4 * a + d] = cell
    return tuple(best)


def joined(left: Cells, right: Cells) -> Cells:
    """Cells of two spans side by side: X_pq → X_pr X_rq."""
    best: list[Cell | None] = [None] * 16
    for p in STATES:
        for r in STATES:
            one = left[4 * p + r]
            if one is None:
                continue
            for q in STATES:
                two = right[4 * r + q]
                if two is None:
                    continue
                cost, had = one[0] + two[0], best[4 * p + q]
                if had is None or cost < had[0]:
                    best[4 * p + q] = (cost, one[1] + two[1])
                elif cost == had[0]:
                    audit = one[1] + two[1]
                    if audit < had[1]:
                        best[4 * p + q] = (cost, audit)
    return tuple(best)


@lru_cache(maxsize=1 << 14)
def _span(kinds: tuple[Kind, ...]) -> Cells:
    return row_cells(kinds[0]) if len(kinds) == 1 else joined(_span(kinds[: len(kinds) // 2]), _span(kinds[len(kinds) // 2 :]))


#: Cells of no rows: states stay, insertions are possible.
NOTHING: Cells = tuple(INSERTED.get((p, q)) for p in STATES for q in STATES)


def combined(spans: list[Cells]) -> Cells:
    """Cells of adjacent spans, pairs of neighbours first, then pairs of these …"""
    while len(spans) > 1:
        spans = [joined(*spans[k : k + 2]) if k + 1 < len(spans) else spans[k] for k in range(0, len(spans), 2)]
    return spans[0] if spans else NOTHING


def span_cells(kinds: list[Kind]) -> Cells:
    """Cells of a span of rows."""
    return combined([_span(tuple(kinds[k : k + REMEMBERED])) for k in range(0, len(kinds), REMEMBERED)])


def least(cells: Cells) -> tuple[Cell, int]:
    """The cheapest cell from the start to an end, and that end; insertions alone repair nothing, so no rows cost nothing."""
    return min((cells[q], q) for q in ENDS if cells[q] is not None)


def chosen(spans: list[Cells]) -> tuple[int, list[Cell]]:
    """The cost of the best repair of adjacent spans, and each span's part of it."""
    levels = [spans]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([joined(*below[k : k + 2]) if k + 1 < len(below) else below[k] for k in range(0, len(below), 2)])
    (cost, _), end = least(levels[-1][0])
    ways = [(0, end)]
    for below in reversed(levels[:-1]):
        parts = []
        for k, (p, q) in enumerate(ways):
            if 2 * k + 1 == len(below):
                parts.append((p, q))
                continue
            left, right = below[2 * k], below[2 * k + 1]
            _, r = min(((a[0] + b[0], a[1] + b[1]), r) for r in STATES if (a := left[4 * p + r]) is not None and (b := right[4 * r + q]) is not None)
            parts += [(p, r), (r, q)]
        ways = parts
    return cost, [spans[k][4 * p + q] for k, (p, q) in enumerate(ways)]


def replayed(audit: str, rows: Iterable[tuple[str, str]], state: int = 0) -> Iterator[tuple[str, str | None, str, int]]:
    """(edit, role, text, state after it) of each edit of an audit over its rows; a deleted row has no role."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            yield edit, None, text, state
            continue
        if edit == "K":
            state = STEP[state, role[:1]]
        else:
            role = ROLES[WANTED[state]]
            state = STEP[state, WANTED[state]]
        yield edit, role, text, state


# --- Rows into blocks ------------------------------------------------------------------------------------------------

BLANK = " \t\n\x0b\x0c\r"
_BLOCK = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("block", pa.int64()),
        ("costs", pa.list_(pa.int64())),
        ("audits", pa.list_(pa.string())),
        ("blank", pa.int64()),
        ("duplicate", pa.int64()),
        ("truncated", pa.int64()),
        ("illegal", pa.int64()),
        ("ends", pa.list_(pa.string())),
        ("turns", pa.list_(pa.int64())),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
    ]
)
LEGAL = {"su", "ua", "au"}


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows sorted into slices by conversation, turn, role and text; ``again``: role and text came in an earlier turn."""
    kept = rows.withColumn("_key", F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)))
    turn = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("turn"))
    first = kept.where("present").groupBy(F.col("conv_id").alias("_conv"), F.col("_key").alias("_k")).agg(F.min(turn).alias("_first"))
    kept = kept.join(first, kept["conv_id"].eqNullSafe(first["_conv"]) & (kept["_key"] == first["_k"]), "left")
    kept = kept.select("conv_id", "turn", "role", "text", "present", F.coalesce(turn > F.col("_first"), F.lit(False)).alias("again"))
    # Bounds are sampled to the driver, so they hold beginnings only; whole values sort within a slice.
    starts = [F.substring("role", 1, 32), F.substring("text", 1, 128)]
    return kept.repartitionByRange("conv_id", "turn", *starts).sortWithinPartitions("conv_id", "turn", "role", "text")


class _Block:
    """Rows of one conversation, in order."""

    def __init__(self) -> None:
        self.kinds: list[Kind] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.counts, self.illegal, self.chars = [0, 0, 0], 0, 0
        self.turns: list[int] | None = None  # first, last, number of different ones

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        bare = text.rstrip(BLANK)
        fault = 0 if not bare else 1 if repeated else 2 if bare[-1] not in ".!?" else None
        if fault is not None:
            self.counts[fault] += 1
        initial = role[:1]
        if self.roles and self.roles[-1][:1] + initial not in LEGAL:
            self.illegal += 1
        self.kinds.append((initial if initial in ("s", "u", "a") else "", fault in (0, 1), fault == 2))
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text) + len(role)
        if turn is not None:
            if self.turns is None:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns = [self.turns[0], turn, self.turns[2] + 1]

    def row(self, conv_id: int | None, number: int) -> dict:
        cells = span_cells(self.kinds)
        return {
            "conv_id": conv_id,
            "block": number,
            "costs": [c and c[0] for c in cells],
            "audits": [c and c[1] for c in cells],
            "blank": self.counts[0],
            "duplicate": self.counts[1],
            "truncated": self.counts[2],
            "illegal": self.illegal,
            "ends": [self.roles[0][:1], self.roles[-1][:1]] if self.roles else [],
            "turns": self.turns or [],
            "roles": self.roles,
            "texts": self.texts,
        }


def _in_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    block, conv, before, begun = _Block(), None, None, False
    done: list[dict] = []
    size = 0
    for batch in batches:
        for conv_id, turn, role, text, present, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if begun and (conv_id != conv or len(block.kinds) >= BLOCK_ROWS or block.chars >= BLOCK_CHARS):
                done.append(block.row(conv, number))
                number, size, block = number + 1, size + block.chars, _Block()
            begun, conv = True, conv_id
            if present:
                here = (conv_id, turn, role, text)
                block.add(turn, role, text, again or here == before)
                before = here
            if len(done) >= BLOCK_ROWS or size >= 16 * BLOCK_CHARS:
                yield pa.RecordBatch.from_pylist(done, schema=_BLOCK)
                done, size = [], 0
    if begun:
        done.append(block.row(conv, number))
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_BLOCK)


# --- Blocks into repaired conversations ------------------------------------------------------------------------------

_REPORT = pa.schema(
    [
        ("conv_id", pa.int64()),
        *((name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)
_MESSAGE = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


class _Conversation:
    """Cells and counts of a conversation's blocks, then its edits as the blocks come again."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.spans, self.numbers = conv_id, [], []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.last, self.turns = None, None
        self.plan: dict[int, str] | None = None
        self.cost, self.audit, self.state, self.place = 0, "", 0, 0
        self.digest = hashlib.sha256()

    def learn(self, row: dict) -> None:
        for name in self.counts:
            self.counts[name] += row[name]
        if row["turns"]:
            first, last, different = row["turns"]
            if self.turns is None:
                self.turns = [first, last, different]
            else:
                self.turns = [self.turns[0], last, self.turns[2] + different - (self.turns[1] == first)]
        if not row["ends"]:
            return  # a block without rows
        if self.last is not None and self.last + row["ends"][0] not in LEGAL:
            self.counts["illegal"] += 1
        self.last = row["ends"][1]
        self.spans.append(tuple(None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True)))
        self.numbers.append(row["block"])

    def decide(self) -> None:
        self.cost, parts = chosen(self.spans) if self.spans else (0, [])
        self.audit = "".join(audit for _, audit in parts)
        self.plan = dict(zip(self.numbers, (audit for _, audit in parts), strict=True))
        self.spans = []

    def repair(self, row: dict) -> Iterator[dict]:
        if self.plan is None:
            self.decide()
        for edit, role, text, state in replayed(self.plan.pop(row["block"], ""), zip(row["roles"], row["texts"], strict=True), self.state):
            self.state = state
            if role is not None:
                self.digest.update(f"\n{role}:{text}".encode() if self.place else f"{role}:{text}".encode())
                self.place += 1
            yield {"conv_id": self.conv_id, "place": self.place if role is not None else None, "edit": edit, "role": role, "text": text}

    def report(self) -> dict:
        if self.plan is None:
            self.decide()
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": self.cost, "audit": self.audit, "repaired_sha256": self.digest.hexdigest()}


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[_Conversation, dict | None]]:
    """Each conversation with each of its second-pass rows, and with None at its end."""
    now: _Conversation | None = None
    for batch in batches:
        for k in range(batch.num_rows):  # one block at a time
            (row,) = batch.slice(k, 1).to_pylist()
            if now is None or now.conv_id != row["conv_id"]:
                if now is not None:
                    yield now, None
                now = _Conversation(row["conv_id"])
            if row["pass"] == 0:
                now.learn(row)
            else:
                yield now, row
    if now is not None:
        yield now, None


def _reports(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done = []
    for conversation, row in _stream(batches):
        if row is None:
            done.append(conversation.report())
            if len(done) >= BLOCK_ROWS:
                yield pa.RecordBatch.from_pylist(done, schema=_REPORT)
                done = []
        else:
            for _ in conversation.repair(row):
                pass
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_REPORT)


def _messages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conversation, row in _stream(batches):
        if row is not None and (edits := list(conversation.repair(row))):
            yield pa.RecordBatch.from_pylist(edits, schema=_MESSAGE)


def _passes(rows: DataFrame) -> DataFrame:
    """Blocks twice, by conversation: their cells first, then their texts in order."""
    scratch = Scratch(rows.sparkSession)
    blocks = scratch.save(_ordered(rows).mapInArrow(_in_blocks, _ddl(_BLOCK)), "blocks")
    nothing = [F.lit(None).cast("array<string>").alias(c) for c in ("roles", "texts")]
    cells = blocks.select("conv_id", "block", "costs", "audits", "blank", "duplicate", "truncated", "illegal", "ends", "turns", *nothing, F.lit(0).alias("pass"))
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("costs", "array<bigint>"), ("audits", "array<string>"))]
    counts = [F.lit(0).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    ends = [F.lit(None).cast("array<string>").alias("ends"), F.lit(None).cast("array<bigint>").alias("turns")]
    texts = blocks.where(F.size("texts") > 0).select("conv_id", "block", *empty, *counts, *ends, "roles", "texts", F.lit(1).alias("pass"))
    return cells.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "pass", "block")


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.string(): "string", pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{field.name} {names[field.type]}" for field in schema)


def _prepared(rows: DataFrame, present: str | None) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    there = F.lit(True) if present is None else F.col(present)
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text, there.alias("present"))


def messages(rows: DataFrame, present: str | None = None) -> DataFrame:
    """(conv_id, place, edit, role, text) of the cheapest repair: an edit K, R, I or D each; deleted rows without place and role.

    ``present`` names a boolean column: a row where it is false only tells that its conversation exists.
    """
    return _passes(_prepared(rows, present)).mapInArrow(_messages, _ddl(_MESSAGE))


def reports(rows: DataFrame, present: str | None = None) -> DataFrame:
    """A row for each conversation: gaps, faults, cost and audit of the cheapest repair, digest of the repaired lines.

    ``present`` as for ``messages``; a conversation without present rows has zeros, no audit and the digest of no text.
    """
    return _passes(_prepared(rows, present)).mapInArrow(_reports, _ddl(_REPORT))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that crc32(``conv_id:turn``) % 20 names: 0 dropped, 1 emptied, 2 without ``[.!?]``, 3 twice, 4 user.

    A dropped row stays, with ``present`` false.
    """
    rows = _prepared(rows, None)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("present"), copies).drop("_copy")
