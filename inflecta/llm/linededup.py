"""Line deduplication by a suffix array over line ids, built by distributed prefix doubling.

A text is a sequence of lines (cut at line feeds), lines are numbers by content. A run of lines is deleted where the
same run occurs earlier (in order of doc_id, then line; also in the same document) and it holds ``min_words`` words or
more. The first copy of every repeated run stays. In detail, for each line the longest run from it on that occurs
earlier is found; if it is long enough, all its lines go.

* Only lines that occur twice matter: they form segments of neighbouring repeated lines, and no run leaves a segment.
  Segments of fewer than ``min_words`` words are left out at once.
* Prefix doubling: the rank of a suffix by its first 2^(k+1) lines is the order of its pair of ranks by 2^k lines, here
  and 2^k lines on. Pairs are combined before they are shuffled, sorted by range and numbered; a round is one window
  per document, one sort and one join, and the number of rounds is the logarithm of the longest repeated run.
* Longest common prefixes of neighbours in the suffix array follow from the ranks of all rounds: the greatest power of
  two that agrees, then the same from there on, for the pairs that are not done.
* Going through the suffix array, the intervals of common prefixes around a suffix form a staircase (length, least
  position so far). It is gone through in slices of fixed size from both ends; what a slice hands to the next is its
  staircase, at most as long as the longest run, so slices run in parallel after one pass that returns these alone.

Defined results: NULL texts stay NULL; an empty text is one empty line; a text of which every line goes is empty; rows
equal in doc_id and text are one document (repeated rows fare alike); documents of one doc_id follow each other by a
hash of their text, NULL ids come first. Further columns are passed through.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inflecta.llm.common import Scratch, refuse, slices
from inflecta.operators.numbering import number_rows

MIN_WORDS = 50
#: Suffixes in a slice of the suffix array.
SLICE = 1 << 17


def _ordered(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """Add ``name``: a number that is in the order of ``by``, not dense. Saved at once, since it holds for one run."""
    return rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id())


def repeated_lines(docs: DataFrame, min_words: int, scratch: Scratch) -> DataFrame:
    """(doc, at, pos, words, line) of the lines of long enough segments; doc_id and hash of text as ``d`` and ``h``."""
    own = docs.where("text IS NOT NULL").select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), "text")
    lines = own.select("d", "h", F.posexplode(F.split("text", "\n", -1)).alias("at", "_line"))
    lines = lines.select(
        "d", "h", "at", F.xxhash64("_line").alias("k1"), F.xxhash64(F.lit(1), "_line").alias("k2"), F.regexp_count("_line", F.lit(r"\S+")).alias("words")
    )
    lines = scratch.save(lines, "lines")
    # Rows equal in doc_id and text give equal lines: one of them stays.
    lines = lines.dropDuplicates(["d", "h", "at"])
    twice = lines.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    twice = scratch.save(_ordered(twice, ["k1", "k2"], "line"), "twice")
    found = lines.join(twice, ["k1", "k2"]).select("d", "h", "at", "words", (F.col("line") + 1).alias("line"))
    of_doc = Window.partitionBy("d", "h").orderBy("at")
    found = found.withColumn("segment", F.col("at") - F.row_number().over(of_doc))
    found = found.withColumn("whole", F.sum("words").over(Window.partitionBy("d", "h", "segment"))).where(F.col("whole") >= min_words)
    found = scratch.save(_ordered(found.select("d", "h", "at", "words", "line"), ["d", "h", "at"], "pos"), "ordered")
    scratch.drop("lines", "twice")
    return scratch.save(found.withColumn("doc", F.min("pos").over(Window.partitionBy("d", "h"))), "found")


def ranked(found: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(doc, at, pos, ranks) and the number of rounds: ``ranks[k]`` orders suffixes by their first 2^k lines."""
    of_doc = Window.partitionBy("doc").orderBy("at")
    current = scratch.save(found.select("doc", "at", "pos", F.array("line").alias("ranks")), "ranks-0")
    rounds = 0
    while True:
        step = 1 << rounds
        last = F.element_at("ranks", -1)
        there = F.lead("at", step).over(of_doc) == F.col("at") + step
        pairs = current.withColumn("first", last).withColumn("second", F.when(there, F.lead(last, step).over(of_doc)).otherwise(F.lit(0)))
        counted = pairs.groupBy("first", "second").agg(F.count("*").alias("n"))
        numbered = scratch.save(_ordered(counted, ["first", "second"], "rank"), f"pairs-{rounds}")
        joined = pairs.join(numbered.select("first", "second", (F.col("rank") + 1).alias("rank")), ["first", "second"])
        following = scratch.save(joined.select("doc", "at", "pos", F.concat("ranks", F.array("rank")).alias("ranks")), f"ranks-{rounds + 1}")
        # Done when no two suffixes agree in twice as many lines that both have.
        goes_on = not numbered.where("n > 1 AND second > 0").isEmpty()
        scratch.drop(f"ranks-{rounds}", f"pairs-{rounds}")
        current, rounds = following, rounds + 1
        if not goes_on:
            return current, rounds


def common_prefixes(suffixes: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """(sa, doc, at, pos, lcp): suffixes in their order, with the lines they share with the one before."""
    last = suffixes.withColumn("last", F.element_at("ranks", -1))
    array = scratch.save(number_rows(last, ["last", "pos"], "sa"), "array")
    ends = Window.partitionBy("doc", "segment")
    lengths = found.withColumn("segment", F.col("at") - F.row_number().over(Window.partitionBy("doc").orderBy("at")))
    lengths = lengths.select("doc", "at", (F.max("at").over(ends) - F.col("at") + 1).alias("left"))
    array_of = array.select("sa", "doc", "at", "pos", "ranks").join(lengths, ["doc", "at"])
    before = array.select((F.col("sa") + 1).alias("sa"), F.col("doc").alias("doc2"), F.col("at").alias("at2"), F.col("ranks").alias("ranks2"))
    pairs = array_of.join(before, "sa", "left")

    def agreeing(a: str, b: str):
        """The greatest k whose ranks agree, plus one; 0 if the first lines differ."""
        same = F.transform(F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b")), lambda r: F.when(r["a"] == r["b"], 1).otherwise(0))
        return F.coalesce(F.aggregate(same, F.lit(0), lambda n, one: n + one), F.lit(0))

    whole = F.element_at("ranks", -1) == F.element_at("ranks2", -1)
    k = agreeing("ranks", "ranks2")
    shared = F.when(whole, F.col("left")).when(k > 0, F.pow(F.lit(2), k - 1).cast("long")).otherwise(0)
    pairs = pairs.select("sa", "doc", "at", "pos", "doc2", "at2", F.coalesce(shared, F.lit(0)).cast("long").alias("lcp"), (~whole & (k > 1)).alias("open"))
    current = scratch.save(pairs, "lcp-0")
    levels, step = suffixes.select("doc", "at", "ranks"), 0
    while not current.where("open").isEmpty():
        # From where they agree on; at most as often as a length has binary digits.
        here = levels.select("doc", F.col("at").alias("_at"), F.col("ranks").alias("r1"))
        there = levels.select(F.col("doc").alias("doc2"), F.col("at").alias("_at2"), F.col("ranks").alias("r2"))
        rest = current.where("open").withColumn("_at", F.col("at") + F.col("lcp")).withColumn("_at2", F.col("at2") + F.col("lcp"))
        rest = rest.join(here, ["doc", "_at"], "left").join(there, ["doc2", "_at2"], "left")
        more = agreeing("r1", "r2")
        longer = F.col("lcp") + F.when(more > 0, F.pow(F.lit(2), more - 1).cast("long")).otherwise(0)
        rest = rest.select("sa", "doc", "at", "pos", "doc2", "at2", longer.alias("lcp"), (more > 1).alias("open"))
        step += 1
        current = scratch.save(current.where("NOT open OR open IS NULL").unionByName(rest), f"lcp-{step}")
        scratch.drop(f"lcp-{step - 1}")
    return current.select("sa", "doc", "at", "pos", "lcp")


class Staircase:
    """Of the suffixes gone by: for each length the least position among those that share so many lines with here.

    Steps have rising lengths and rising positions: a shorter prefix counts only if it occurs earlier.
    """

    def __init__(self, steps: Iterable[tuple[int, int]] = ()):
        self.lengths: list[int] = [n for n, _ in steps]
        self.places: list[int] = [p for _, p in steps]

    def narrow(self, lcp: int) -> None:
        """Move on to a suffix that shares ``lcp`` lines with the one before."""
        cut = bisect_right(self.lengths, lcp)
        if cut < len(self.lengths):
            place = self.places[cut]
            del self.lengths[cut:], self.places[cut:]
            if lcp > 0:
                self.add(lcp, place)

    def add(self, length: int, place: int) -> None:
        """A suffix at ``place`` that shares ``length`` lines, at least as many as any other."""
        while self.places and self.places[-1] >= place:
            self.lengths.pop()
            self.places.pop()
        if not self.lengths or self.lengths[-1] < length:
            self.lengths.append(length)
            self.places.append(place)

    def longest_before(self, place: int) -> int:
        """The longest length with an earlier position."""
        at = bisect_right(self.places, place - 1)
        return self.lengths[at - 1] if at else 0

    def steps(self) -> list[tuple[int, int]]:
        return list(zip(self.lengths, self.places, strict=True))


_ENDLESS = 1 << 60


def go_through(lcps: list[int], places: list[int], stairs: Staircase, found: list[int] | None = None) -> None:
    """Go through suffixes; ``lcps[i]`` is shared with the one before. Raises ``found[i]`` to the longest run met earlier."""
    for i, (lcp, place) in enumerate(zip(lcps, places, strict=True)):
        stairs.narrow(lcp)
        if found is not None:
            found[i] = max(found[i], stairs.longest_before(place))
        stairs.add(_ENDLESS, place)


def _both_ways(table: pa.Table, following: int) -> tuple[np.ndarray, list[int], list[int], list[int]]:
    """Order of the rows, positions, and the lcps met from the left and (reversed) from the right."""
    sa = table["sa"].to_numpy()
    order = np.argsort(sa)
    lcp = table["lcp"].to_numpy()[order].tolist()
    return order, table["pos"].to_numpy()[order].tolist(), lcp, [following, *lcp[:0:-1]]


def earlier_runs(array: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, at, run): for each suffix the longest run of lines from it on that occurs earlier; only run > 0."""
    rows = array.select("doc", "at", "pos", "lcp", "sa", F.floor((F.col("sa") - 1) / SLICE).alias("slice"))
    rows = scratch.save(rows, "slices")

    def summary(group: pa.Table) -> pa.Table:
        slice_, out = group["slice"][0].as_py(), []
        _, places, lcps, back = _both_ways(group, 0)
        for way, own, at in (("left", lcps, places), ("right", back, places[::-1])):
            stairs = Staircase()
            go_through([0, *own[1:]], at, stairs)
            out.append({"slice": slice_, "way": way, "least": min(own[1:], default=_ENDLESS), "edge": lcps[0], "lengths": stairs.lengths, "places": stairs.places})
        return pa.Table.from_pylist(out, pa.schema([("slice", pa.int64()), ("way", pa.string()), ("least", pa.int64()), ("edge", pa.int64()), ("lengths", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))]))

    kind = "slice long, way string, least long, edge long, lengths array<long>, places array<long>"
    # Two rows for each SLICE suffixes.
    parts = {(r["way"], r["slice"]): r for r in rows.groupBy("slice").applyInArrow(summary, kind).collect()}
    numbers = sorted({n for _, n in parts})
    entering: dict[tuple[str, int], list[tuple[int, int]]] = {}
    following: dict[int, int] = {}
    for way, ordered in (("left", numbers), ("right", numbers[::-1])):
        stairs = Staircase()
        for n in ordered:
            part = parts[way, n]
            edge = part["edge"] if way == "left" else (parts["left", n + 1]["edge"] if n + 1 in numbers else 0)
            following[n] = edge if way == "right" else following.get(n, 0)
            entering[way, n] = stairs.steps()
            stairs.narrow(min(edge, part["least"]))
            for length, place in zip(part["lengths"], part["places"], strict=True):
                stairs = _with(stairs, length, place)
    shared = rows.sparkSession.sparkContext.broadcast((entering, following))

    def settle(group: pa.Table) -> pa.Table:
        stairs, after = shared.value
        n = group["slice"][0].as_py()
        order, places, lcps, back = _both_ways(group, after[n])
        run, reverse = [0] * len(places), [0] * len(places)
        go_through(lcps, places, Staircase(stairs["left", n]), run)
        go_through(back, places[::-1], Staircase(stairs["right", n]), reverse)
        best = np.maximum(np.array(run), np.array(reverse)[::-1])
        hit = best > 0
        return pa.table({c: pa.array(group[c].to_numpy()[order][hit]) for c in ("doc", "at")} | {"run": pa.array(best[hit].astype(np.int64))})

    return rows.groupBy("slice").applyInArrow(settle, "doc long, at int, run long")


def _with(stairs: Staircase, length: int, place: int) -> Staircase:
    """The staircase with one more step, wherever it lies."""
    steps = sorted([*stairs.steps(), (length, place)], key=lambda s: (-s[0], s[1]))
    kept: list[tuple[int, int]] = []
    for n, p in steps:  # from the longest: a shorter one stays if it is earlier
        if not kept or p < kept[-1][1]:
            kept.append((n, p))
    return Staircase(kept[::-1])


def _deleted(found: DataFrame, runs: DataFrame, min_words: int) -> DataFrame:
    """(d, h, gone): the line numbers to delete of each document, from runs that hold enough words."""
    rows = found.select("doc", "at", "words", "d", "h").join(runs, ["doc", "at"], "left").select("doc", "at", F.coalesce("run", F.lit(0)).alias("run"), "words", "d", "h")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            doc = table["doc"].to_numpy()
            cut = int(np.searchsorted(doc, doc[-1])) if len(doc) else 0
            yield from settle(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None:
            yield from settle(held)

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        length, words = table["run"].to_numpy(), table["words"].to_numpy().astype(np.int64)
        total = np.append(0, np.cumsum(words))
        at = np.flatnonzero(length)
        at = at[total[at + length[at]] - total[at] >= min_words]
        change = np.zeros(len(length) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + length[at], -1)
        gone = table.filter(pa.array(np.cumsum(change)[:-1] > 0)).select(["d", "h", "at"])
        yield from gone.to_batches()

    kind = {f.name: f.dataType.simpleString() for f in found.schema}
    lines = rows.repartition("doc").sortWithinPartitions("doc", "at").mapInArrow(run, f"d {kind['d']}, h long, at int")
    return lines.groupBy("d", "h").agg(F.sort_array(F.collect_list("at")).alias("gone"))


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs``, ``text`` without its later copies of runs; ``n_lines`` and ``n_deleted`` are added."""
    refuse(docs.columns, "n_lines", "n_deleted")
    scratch = Scratch(docs.sparkSession)
    found = repeated_lines(docs.select("doc_id", "text"), min_words, scratch)
    suffixes, _ = ranked(found, scratch)
    array = common_prefixes(suffixes, found, scratch)
    gone = scratch.keep(_deleted(found, earlier_runs(array, scratch), min_words))
    scratch.drop_all()
    tag = uuid.uuid4().hex  # names that no column of the caller has
    lost_lines = f"gone_{tag}"
    gone = gone.select(*(F.col(c).alias(f"{c}_{tag}") for c in ("d", "h", "gone")))
    keyed = docs.withColumn(f"key_{tag}", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(f"d_{tag}")) & (F.col(f"key_{tag}") == F.col(f"h_{tag}"))
    joined = keyed.join(gone, same, "left").select(*(F.col(f"`{c}`") for c in docs.columns), F.col(lost_lines))
    names = docs.columns

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            texts, total, deleted = [], [], []
            for text, lost in zip(columns["text"].to_pylist(), columns[lost_lines].to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                total.append(len(lines))
                deleted.append(len(lost or ()))
                if lost:
                    drop = set(lost)
                    text = "\n".join(line for i, line in enumerate(lines) if i not in drop)
                texts.append(text)
            columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*(columns[n] for n in names), pa.array(total, pa.int32()), pa.array(deleted, pa.int32())], names=[*names, "n_lines", "n_deleted"])

    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.IntegerType()), T.StructField("n_deleted", T.IntegerType())])
    return joined.mapInArrow(cut, schema)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_deleted, text_sha256) of each row after deduplication."""
    return deduplicated(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))
