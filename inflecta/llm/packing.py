"""Best-fit packing of tokenized documents into sequences of bounded length.

**Pieces.** A document is its token ids and an end id. One longer than a sequence is cut into whole sequences, its first
piece taking what is over; no other document is cut.

**Bulk-synchronous best fit.** All pieces are sorted by length over the cluster, so each has a rank, and pieces of one
length are consecutive ranks. Gaps (sequences by the room left in them) are kept as sorted runs of sequence numbers. A
round takes the pieces of one length, longest first, and sweeps the gaps for their successor: the least room that holds
the length. Every gap of that room takes as many of the pieces as fit, and where more gaps or more pieces want each
other, rank decides: the next pieces go to the next sequences. The gaps filled change their room, and the sweep goes on
with the next successor until the round's pieces are placed; without a successor, sequences are opened. That is the
outcome of best fit decreasing, piece after piece, since pieces of one length are interchangeable.

**Sizes.** Lengths are whole numbers up to the capacity, so a sweep is over runs: what it reads is the number of pieces
of each length, and what it decides is a list of runs (pieces by rank, sequences by number), both bounded by the capacity
(1024) whatever the number of documents. Pieces themselves are sorted, ranked and placed where they are: one range
shuffle of slim rows, spread also where all pieces have one length.

**Inputs.** NULL and empty texts are one end id. NULL ids and repeated rows are packed like others. An empty table gives no
rows. Other columns of the documents end here; a column of the pieces that clashes with an output is refused.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from inflecta.llm.common import Scratch, slices

CAPACITY, END_ID = 1024, 2
# Fixed value: ``monotonically_increasing_id`` keeps the row in the low 33 bits, the slice above them.
_ROW_BITS = 33


# --- Documents into pieces -------------------------------------------------------------------------------------------


def byte_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id of a byte-level vocabulary file, without its special tokens.

    The file writes printable bytes as themselves and the others, in order, as characters from U+0100 on.
    """
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {token["content"] for token in stored["added_tokens"]}
    return {bytes(byte[c] for c in token): n for token, n in stored["model"]["vocab"].items() if token not in special}


class Encoder:
    """Ids of whole texts by a byte-level vocabulary file, strings of special tokens read as ordinary text.

    The merge loop is ``tiktoken``'s, which gives the ids of ``tokenizers`` (held equal by tests) in a quarter of the
    time; a text whose blanks its pattern can't search goes to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        self.path = path
        self.fast = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_ranks(path), special_tokens={})
        self.plain: Tokenizer | None = None

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            if self.plain is None:
                self.plain = Tokenizer.from_file(self.path)
                self.plain.encode_special_tokens = True
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)


def cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of ``total`` ids; what is over comes first."""
    first = total % capacity or min(total, capacity)
    return [(0, first), *((start, capacity) for start in range(first, total, capacity))]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32 and, if wanted, ids) of each piece of each document."""
    kind = docs.schema["doc_id"].dataType
    kinds = [("doc_id", kind), ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    kinds += [("ids", T.ArrayType(T.IntegerType()))] if ids else []

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        for batch in slices(batches, "text"):
            columns: list[list] = [[] for _ in kinds]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                for number, (start, length) in enumerate(cuts(len(tokens), capacity)):
                    own = tokens[start : start + length]
                    for column, value in zip(columns, (doc_id, number, start, length, zlib.crc32(own.tobytes()), own), strict=False):
                        column.append(value)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            arrays = [pa.array(columns[0], batch.column(0).type), *(pa.array(c, t) for c, t in zip(columns[1:], types, strict=False))]
            yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in kinds])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(cut, T.StructType([T.StructField(*k) for k in kinds]))


# --- Rounds over runs of equal lengths -------------------------------------------------------------------------------


class Gaps:
    """Open sequences by the room left in them: runs (first number, how many), the rooms sorted."""

    def __init__(self, capacity: int):
        self.capacity, self.opened = capacity, 0
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, first: int, count: int) -> None:
        if room and count:
            if room not in self.runs:
                insort(self.rooms, room)
                self.runs[room] = []
            self.runs[room].append((first, count))

    def successor(self, length: int, wanted: int) -> tuple[int, int, int]:
        """(room, first, count) of a run of gaps of the least room that holds ``length``; opened, ``wanted`` at most, if none does."""
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            first, self.opened = self.opened, self.opened + wanted
            return self.capacity, first, wanted
        room = self.rooms[at]
        first, count = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room], self.rooms[at]
        return room, first, count


def rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank within the length, first sequence, pieces for each sequence, offset in it) of each run placed, for
    the number of pieces of each length; by length, longest first, then by rank."""
    gaps, placed = Gaps(capacity), []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room, first, count = gaps.successor(length, -(-left // (capacity // length)))
            each = room // length
            used = min(count, -(-left // each))
            taken = min(left, used * each)
            placed.append((length, rank, first, each, capacity - room))
            last = taken - (used - 1) * each  # the last sequence of the run may get fewer pieces
            gaps.add(room, first + used, count - used)
            gaps.add(room - last * length, first + used - 1, 1)
            gaps.add(room - each * length, first, used - 1)
            rank, left = rank + taken, left - taken
    return placed


def packed(rows: DataFrame, capacity: int = CAPACITY, length: str = "length", ties: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """``rows`` with sequence_id and offset: each row, ``length`` (1 to ``capacity``) long, has its place in a sequence.

    ``ties`` orders rows of one length by hash, so that a length of many rows is spread over slices.
    """
    taken = {c.lower() for c in rows.columns} & {"sequence_id", "offset", "_place"}
    if taken:
        raise ValueError(f"the input has columns named like the output: {', '.join(sorted(taken))}")
    scratch = Scratch(rows.sparkSession)
    order = (length, F.xxhash64(*ties))
    # A range shuffle reads its input twice, for bounds and for rows: what the rows are made from is read once.
    rows = scratch.save(rows, "rows")
    ranged = scratch.save(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "ranged")
    scratch.drop("rows")
    # A row for each slice, and for each length: bounded by the number of slices and the capacity.
    of_slices = ranged.groupBy(F.shiftright("_place", _ROW_BITS).alias("s")).agg(F.count("*").alias("n")).orderBy("s").collect()
    counts = {r[0]: r[1] for r in ranged.groupBy(F.col(length).cast("long")).count().collect()}
    if any(n is None or not 0 < n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    runs = rounds(counts, capacity)
    below, start = 0, {}
    for n in sorted(counts):
        start[n], below = below, below + counts[n]
    runs = sorted((start[n] + rank, first, each, offset, n) for n, rank, first, each, offset in runs)
    run_starts, firsts, each, offsets, lengths = (np.array(column, np.int64) for column in (zip(*runs) if runs else [[]] * 5))
    slice_ids = np.array([r["s"] for r in of_slices], np.int64)
    slice_starts = np.concatenate([[0], np.cumsum([r["n"] for r in of_slices])]).astype(np.int64)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index("_place")
            rows_at = batch.column(at).to_numpy()
            rank = slice_starts[np.searchsorted(slice_ids, rows_at >> _ROW_BITS)] + (rows_at & ((1 << _ROW_BITS) - 1))
            run = np.searchsorted(run_starts, rank, side="right") - 1
            within = rank - run_starts[run]
            sequence, offset = firsts[run] + within // each[run], offsets[run] + within % each[run] * lengths[run]
            kept = [batch.column(k) for k in range(batch.num_columns) if k != at]
            names = [name for name in batch.schema.names if name != "_place"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = T.StructType([f for f in ranged.schema.fields if f.name != "_place"] + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")])
    return ranged.mapInArrow(place, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of each sequence, at most its capacity, from packed pieces that hold theirs."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_parts")).select("sequence_id", F.flatten("_parts.ids").alias("ids"))
