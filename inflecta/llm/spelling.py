"""Grouping of spelling variants: words one edit apart, by dense prefix-suffix tiling.

**Method.** Two words are near if one code point is inserted, deleted or replaced. Words stand as rows of padded matrices
of code points, once from the left and once from the right; comparing rows gives the lengths of the common prefix and
suffix, and two words are near if these reach the longer length minus one.

**Blocks.** Only blocks of words that can be near are compared. Let L be the longer length of a pair; positions 0 … L-1 are
cut into three segments. An edit lies in one of them, so what precedes and what follows that segment is common. A word
is put into the blocks of its prefix and suffix around each segment, as a word of the longer length and, for L one more
than its length, as one of the shorter: six blocks a word. A pair whose common prefix ends in a segment is counted in
the block of that segment alone, so no pair counts twice.

**Tiles.** A block of more than ``TILE`` words is cut into tiles by hash; each pair of tiles is a unit of its own, so no task
gets a whole large block. What a unit gives is a row for each of its words that has near ones: their number and the
commonest. Pairs are never written.

**Forms.** A word's form occurs at least ten times as often, so a chain of forms is no longer than the digits of a count.
Roots are found by doubling the steps, five times at most.

**Inputs.** NULL and empty texts have no words; a NULL id counts as no characters. Words of any length are whole: matrices
are cut by cells, not rows. Repeated rows count each. Empty tables give no rows. Other columns of the input end here.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inflecta.llm.common import Scratch

#: Letters of words, least length of a word, least occurrences, and how much commoner a form is.
LETTERS, LENGTH, OCCURRENCES, TIMES = "A-Za-zÀ-ÿ", 7, 2, 10
#: One in so many occurrences loses a code point (the damage that the query measures against).
DAMAGED = 31
SEGMENTS = 3
#: Words of a block that are compared in one unit.
TILE = 2048
#: Cells of a matrix that is compared at once.
CELLS = 1 << 22


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, word) of each maximal run of letters of at least ``LENGTH`` code points, A-Z lower-cased."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{LENGTH},}}"), F.lit(0))
    lower = F.translate(F.col("run"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(runs).alias("run")).select("doc_id", lower.alias("word"))


def damaged(words: DataFrame) -> DataFrame:
    """``words`` where each occurrence whose crc32 of ``doc_id:word`` is divisible by ``DAMAGED`` lost the code point it names."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (F.col("h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return words.withColumn("h", h).select("doc_id", F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and common enough."""
    counted = words.where(F.length("word") >= LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= OCCURRENCES)


def _bounds(longer: Column, segment: int) -> tuple[Column, Column]:
    return F.floor(longer * segment / SEGMENTS).cast("int"), F.floor(longer * (segment + 1) / SEGMENTS).cast("int")


def blocks(words: DataFrame) -> DataFrame:
    """(longer, from, to, short, block, word, n): each word in the blocks of its segments, ``block`` a hash of what is common."""
    size = F.length("word")
    places = []
    for short in (0, 1):
        longer = size + short
        for segment in range(SEGMENTS):
            a, b = _bounds(longer, segment)
            common = F.xxhash64(longer, a, F.substring("word", F.lit(1), a), F.substring(F.col("word"), b + 1 - short, size))
            places.append(F.struct(longer.alias("longer"), a.alias("start"), b.alias("stop"), F.lit(short).alias("short"), common.alias("block")))
    return words.select("word", "n", F.explode(F.array(*places)).alias("p")).select("p.*", "word", "n")


def units(placed: DataFrame) -> DataFrame:
    """Rows of ``blocks`` with ``tile``, ``unit`` and ``alone`` (the unit is one tile): each row goes to every pair of its tile."""
    sizes = placed.groupBy(F.col("block").alias("_b")).agg(F.count("*").alias("_m")).where(F.col("_m") > TILE)
    sized = placed.join(sizes, placed["block"] == sizes["_b"], "left").drop("_b")
    tiles = F.ceil(F.coalesce(F.col("_m"), F.lit(1)) / TILE).cast("int")
    tiled = sized.withColumn("_tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("word", "short"), F.col("_tiles")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    spread = tiled.withColumn("_other", others)
    unit = F.least("tile", "_other") * F.col("_tiles") + F.greatest("tile", "_other")
    return spread.withColumn("unit", unit).withColumn("alone", F.col("tile") == F.col("_other")).drop("_m", "_tiles", "_other")


# --- Matrices --------------------------------------------------------------------------------------------------------


def matrix(words: pa.Array, lengths: np.ndarray, width: int, reverse: bool = False) -> np.ndarray:
    """Code points of the words, a row each, padded with 0; ``reverse``: from their ends. The letters lie below U+0100."""
    points = np.frombuffer("".join(words.to_pylist()).encode("latin-1"), np.uint8)
    ends = np.cumsum(lengths)
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(points)) - np.repeat(ends - lengths, lengths)
    if reverse:
        column = np.repeat(lengths, lengths) - 1 - column
    cells = np.zeros((len(lengths), width), np.uint8)
    cells[row, column] = points
    return cells


def _common(cells: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common beginning of rows i and j."""
    differ = cells[i] != cells[j]
    first = differ.argmax(axis=1)
    return np.minimum(np.where(differ[np.arange(len(i)), first], first, cells.shape[1]), most)


def near_pairs(rows: pa.RecordBatch, left: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of the near pairs within groups of consecutive rows, words of the longer length first in each group."""
    count, width = left.shape
    right = matrix(rows.column("word"), lengths, width, reverse=True)
    short, start, stop, tile, alone = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("short", "start", "stop", "tile", "alone"))
    last = np.flatnonzero(np.append(group[1:] != group[:-1], True))
    end = last[np.searchsorted(last, np.arange(count))] + 1
    most = max(1, CELLS // width)
    found: list[np.ndarray] = [np.zeros((2, 0), np.int64)]
    waiting: list[np.ndarray] = []
    held, step, i = 0, 1, np.flatnonzero(short == 0)

    def compare() -> None:
        pairs = np.concatenate(waiting, axis=1)
        for at in range(0, pairs.shape[1], most):
            i, j = pairs[:, at : at + most]
            shorter, longer = np.minimum(lengths[i], lengths[j]), np.maximum(lengths[i], lengths[j])
            prefix, suffix = _common(left, i, j, shorter), _common(right, i, j, shorter)
            # Equal words share all of both; a pair counts where its common prefix ends.
            near = (prefix + suffix >= longer - 1) & (prefix < longer) & (prefix >= start[i]) & (prefix < stop[i])
            found.append(pairs[:, at : at + most][:, near])

    while len(i := i[end[i] - i > step]):
        j = i + step
        compared = alone[i] | (tile[i] != tile[j])
        waiting.append(np.stack([i[compared], j[compared]]))
        held, step = held + int(compared.sum()), step + 1
        if held >= most:
            compare()
            waiting, held = [], 0
    if held:
        compare()
    i, j = np.concatenate(found, axis=1)
    return i, j


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def _nearest(rows: pa.RecordBatch, group: np.ndarray) -> pa.RecordBatch:
    """For each word of the groups with near ones: how many, and the commonest, the least of equals."""
    words, n = rows.column("word"), rows.column("n").to_numpy()
    lengths = pc.utf8_length(words).to_numpy().astype(np.int64)
    width = max(1, int(lengths.max(initial=0)))
    left = matrix(words, lengths, width)
    i, j = near_pairs(rows, left, lengths, group)
    one, other = np.concatenate([i, j]), np.concatenate([j, i])
    points = left.view(f"S{width}")[:, 0]
    order = np.lexsort((points[other], -n[other], one))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.append(True, one[1:] != one[:-1])) if len(one) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(one)))
    picked, best = pa.array(one[first]), pa.array(other[first])
    return pa.RecordBatch.from_arrays([words.take(picked), pa.array(counts, pa.int64()), pa.array(n[other[first]], pa.int64()), words.take(best)], schema=_FOUND)


def _groups(rows: pa.RecordBatch) -> np.ndarray:
    keys = [rows.column(c).to_numpy(zero_copy_only=False) for c in ("longer", "start", "block", "unit")]
    changed = np.zeros(rows.num_rows, bool)
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return np.cumsum(changed)


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units come sorted; whole units are compared together as long as their matrix is small."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        if not held.num_rows:
            continue
        group = _groups(held)
        longest = int(held.column("longer").to_numpy().max())
        if held.num_rows * longest < CELLS and held.num_rows < CELLS // 64:
            continue
        whole = int(np.searchsorted(group, group[-1]))  # the last unit may go on
        if whole:
            yield _nearest(held.slice(0, whole), group[:whole])
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield _nearest(held, _groups(held))


def nearest(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near) of each of ``words`` (word, n) that has near ones; ``near`` is the commonest, the least of equals."""
    spread = units(blocks(words)).repartition("block", "unit").sortWithinPartitions("longer", "start", "block", "unit", "short")
    found = spread.mapInArrow(_compared, "word string, n_near bigint, near_n bigint, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.m")).alias("near_n"), F.col("best.w").alias("near"))


def grouped(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each of ``words`` (word, n)."""
    scratch = Scratch(words.sparkSession)
    words = scratch.save(words, "words")
    found = nearest(words).withColumnRenamed("word", "_w")
    formed = F.col("near_n") >= TIMES * F.col("n")
    known = words.join(found, F.col("word") == F.col("_w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n")
    )
    known = scratch.save(known, "forms")
    step = scratch.save(known.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots-0")
    rounds = 0
    # Counts grow tenfold with each form, so a chain has at most 19; each round doubles the steps.
    while not step.join(step.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
        further = step.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        step = step.join(further, "root", "left").select("word", F.coalesce("_further", "root").alias("root"))
        rounds += 1
        step = scratch.save(step, f"roots-{rounds}")
    roots = step.select(F.col("word").alias("_w"), F.col("root").alias("_root"))
    return known.join(roots, known["word"] == roots["_w"], "left").select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
