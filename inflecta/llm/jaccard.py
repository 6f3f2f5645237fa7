"""Jaccard join of word-shingle sets by T-occurrence search, and the classes it makes.

Two documents link when ``100 * intersection >= threshold * union`` of their sets of distinct shingles.

How it is found, exactly:

* Documents with equal sets are one node; only nodes are compared.
* A shingle is a 64-bit token whose natural order is one global order: shingles that a fixed-size count sketch
  finds frequent come last (6 bits of level), the rest follows their hash. Two sets that link share a token among
  the first n - T + 1 of each (T: the overlap any link needs); only these are shuffled, and only tokens that
  two nodes share stay. A pair is a candidate only through a token that, as the pair's first, leaves room for the
  overlap beside the tokens before it and those that a node shares with none.
* A search takes a query set and the inverted lists of its tokens over a chunk of candidates. As in DivideSkip,
  the L longest lists are set aside: the short ones are merged by a heap, candidates met T - L times or more are
  probed in the long ones by binary search, and those that reach the overlap of the pair are links.
* A candidate pair is searched twice: in the first tokens that both share with any, which bound the overlap from above,
  and, where that bound reaches the overlap needed, in the whole sets. So whole sets are made and sent only of nodes with such a pair.
* First each node is searched with one hub, the node among those it shares a token with that shares most tokens;
  what links becomes a class. A group whose members do not all link with one hub would leave pairs that grow with its
  square: while many pairs are left, each round tries each node with one more, of another class, in linear work. Then all
  candidate pairs of different classes are searched, each with the node outside the largest class of its token as
  the query. Pairs inside a class need no search: the class is known. No round decides what is found, only how soon.

Nothing is capped: large groups of copies are one class after the hubs, whatever their size, and a query's
candidates go in chunks of bounded tokens over several tasks (a candidate that is longer goes alone).

Defined results: NULL, empty and word-less texts have an empty set, link with nothing and are their own class;
a NULL doc_id takes part and gets the least non-NULL id of its class; repeated rows each return a row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inflecta.llm.common import Scratch, slices
from inflecta.llm.components import components

WORDS, THRESHOLD = 5, 75
#: Cells of the count sketch and bits of a token that hold its level.
SKETCH, LEVEL_BITS = 1 << 22, 6
#: Tokens of a query's candidates that one task searches at a time; further candidates go to further tasks.
CHUNK = 1 << 20
#: Further hubs are tried while more than so many pairs a node are left, and each round leaves at most this share of them.
#: The pairs left are counted for one query of so many, by hash: it tells only whether a round comes first.
PAIRS_PER_NODE, LEAST_GAIN, ONE_IN = 1, 0.75, 16
#: Bits of the bitmap that leaves out texts which share nothing, as a power of two.
FILTER_BITS = 25
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hash a task remembers before it starts anew.
REMEMBERED = 150_000


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text given as UTF-8 bytes."""

    def __init__(self, words: int):
        self.words, self.known = words, {}
        self.weights = np.cumprod(np.full(words, _MIX)) | np.uint64(1)

    def hashes(self, text: bytes) -> np.ndarray:
        found, known = text.lower().split(), self.known  # bytes: A-Z only; splits on \\x20 and \\x09-\\x0D only
        if not found:
            return np.empty(0, np.uint64)
        try:
            own = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for word in set(found).difference(known):
                known[word] = xxhash.xxh3_64_intdigest(word)
            own = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        n = max(1, len(own) - self.words + 1)
        whole = np.zeros(n, np.uint64)
        for k in range(min(self.words, len(own))):
            whole += (own[k : k + n] ^ (own[k : k + n] >> np.uint64(29))) * self.weights[k]
        whole ^= whole >> np.uint64(32)
        whole *= _MIX
        whole ^= whole >> np.uint64(29)
        if len(own) < self.words:
            whole ^= np.uint64(len(own))
        return np.unique(whole)


def _texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    values = batch.column(batch.schema.get_field_index(text))
    return [one or b"" for one in values.cast(pa.binary()).to_pylist()]


def frequent_cells(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """(cell, n): sketch cells that hold far more shingles than the mean, at most a fixed number of rows.

    Each task counts all its shingles and reports the cells that stand out there.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, shingler = np.zeros(SKETCH, np.uint32), Shingler(words)
        for batch in slices(batches, text):
            every = [shingler.hashes(one) for one in _texts(batch, text)]
            if every:
                cells, n = np.unique(np.concatenate(every) % np.uint64(SKETCH), return_counts=True)
                counts[cells] += n.astype(np.uint32)
        mean = counts.mean()
        cells = np.flatnonzero(counts >= mean + 6 * mean**0.5 + 8)
        values = [pa.array([*cells, -1], pa.int32()), pa.array([*counts[cells], int(counts.sum(dtype=np.int64))], pa.int64())]
        yield pa.RecordBatch.from_arrays(values, names=["cell", "n"])

    return docs.select(text).mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))


class Order:
    """Turns shingle hashes into tokens whose natural order puts frequent ones last."""

    def __init__(self, cells: dict[int, int]):
        total = cells.pop(-1, 0)
        least = max(8.0, 4 * total / SKETCH)
        kept = sorted((cell, n) for cell, n in cells.items() if n >= least)
        self.cells = np.array([cell for cell, _ in kept], np.uint64)
        levels = [min(int(np.log2(n / least)) + 1, (1 << LEVEL_BITS - 1) - 1) for _, n in kept]
        self.levels = np.array([*levels, 0], np.uint64)

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        tokens = hashes >> np.uint64(LEVEL_BITS)
        if len(self.cells):
            cell = hashes % np.uint64(SKETCH)
            at = np.searchsorted(self.cells, cell)
            at[(at == len(self.cells)) | (self.cells[np.minimum(at, len(self.cells) - 1)] != cell)] = len(self.cells)
            tokens = tokens | self.levels[at] << np.uint64(64 - LEVEL_BITS)
        return np.unique(tokens)


def least_overlap(n: int, threshold: int) -> int:
    """The overlap that any link of a set of ``n`` needs."""
    return -(-threshold * n // 100)


def pair_overlap(n, m, threshold: int):
    """The overlap that a link of sets of ``n`` and ``m`` needs."""
    return -(-threshold * (n + m) // (100 + threshold))


def _sets(docs: DataFrame, order, words: int, threshold: int, text: str, prefix: bool, among=None) -> DataFrame:
    """All columns but the text; n, digest, and the first tokens needed (``prefix``) or all of them as uint64 bytes.

    ``among``: a broadcast bitmap (``_id_filter``) of the doc_ids wanted; most others are left out before they are cut.
    """
    others = [c for c in docs.columns if c != text]

    def chosen(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells = _cells_of(batch.column(batch.schema.get_field_index("doc_id")).fill_null(0).to_numpy())
        there = among.value[(cells >> np.uint64(5)).astype(np.int64)] >> (cells & np.uint64(31)).astype(np.uint32) & 1
        return batch.filter(pa.array(there == 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, ordered = Shingler(words), order.value
        for batch in slices(batches if among is None else map(chosen, batches), text):
            n, digests, tokens = [], [], []
            for one in _texts(batch, text):
                hashes = shingler.hashes(one)
                own = ordered.tokens(hashes)
                n.append(len(own))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(own) else None)
                first = len(own) - least_overlap(len(own), threshold) + 1 if prefix else len(own)
                tokens.append(own[: first if len(own) else 0].tobytes())
            new = [pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(tokens, pa.binary())]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=[*others, "n", "digest", "tokens"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text), "n long", "digest binary", "tokens binary"])
    return docs.mapInArrow(run, schema)


def _shared(nodes: DataFrame) -> DataFrame:
    """(token, node, n, at): first tokens that two nodes or more share, with their place in the node's order.

    One shuffle by token; frequent tokens, known by their level, are spread over several partitions and all kept.
    """

    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512).to_pydict()
                own = [np.frombuffer(x, np.int64) for x in part["tokens"]]
                sizes = np.array([len(x) for x in own], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(own)),
                        pa.array(np.repeat(np.array(part["node"], np.int64), sizes)),
                        pa.array(np.repeat(np.array(part["n"], np.int32), sizes)),
                        pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])),
                    ],
                    names=["token", "node", "n", "at"],
                )

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, until the next one tells whether its token is shared
        last_kept = None
        for batch in batches:
            whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            token = whole.column(0).to_numpy()
            same = token[1:] == token[:-1]
            shared = np.append(same, False) | np.append(False, same) | (token >> (64 - LEVEL_BITS) != 0)
            shared[0] |= token[0] == last_kept
            shared[-1] &= False
            out = whole.filter(pa.array(shared))
            if len(token) > 1:
                last_kept = token[-2] if shared[-2] else None
            held = whole.slice(len(token) - 1)
            yield out
        if held is not None:
            one = int(held.column(0)[0].as_py())
            if one == last_kept or one >> (64 - LEVEL_BITS) != 0:
                yield held

    kind = "token long, node long, n int, at int"
    rows = nodes.select("node", "n", "tokens").mapInArrow(explode, kind)
    level = F.shiftrightunsigned("token", 64 - LEVEL_BITS)
    salt = F.when(level != 0, F.pmod(F.xxhash64("node"), F.lit(64))).otherwise(F.lit(0))
    return rows.repartition("token", salt).sortWithinPartitions("token", "node").mapInArrow(keep, kind)


def _needed(n: Column, m: Column, threshold: int) -> Column:
    """``pair_overlap`` as a column."""
    return F.ceil(F.lit(threshold) * (n + m) / F.lit(100 + threshold))


def _enough(threshold: int) -> Column:
    """Whether a shared token, if the pair's first, leaves room for the overlap that the pair (x, y) needs."""
    return F.least("x_room", "y_room") >= _needed(F.col("x_n"), F.col("y_n"), threshold)


def _as(rows: DataFrame, side: str, *columns: str) -> DataFrame:
    return rows.select("token", *[F.col(c).alias(side if c == "node" else f"{side}_{c}") for c in columns])


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()


def _open_rows(shared: DataFrame, label: DataFrame) -> DataFrame:
    """The rows of tokens with several classes: with the node's class, and the class of most rows of the token."""
    labelled = shared.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = labelled.groupBy("token", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("size", "component")).alias("l"), F.count("*").alias("classes"))
    mixed = largest.where("classes > 1").select("token", F.col("l.component").alias("largest"))
    return labelled.join(mixed, "token")


def _pairs(open_rows: DataFrame, threshold: int, one_in: int = 1) -> DataFrame:
    """(x, y, y_n): distinct candidate pairs of different classes; x is outside its token's largest class, ``one_in`` of all x."""
    outside = (F.col("component") != F.col("largest")) & (F.pmod(F.xxhash64("node"), F.lit(one_in)) == 0)
    queries = _as(open_rows.where(outside), "x", "node", "n", "room", "component")
    return (
        queries.join(_as(open_rows, "y", "node", "n", "room", "component", "largest"), "token")
        .where("x_component <> y_component AND (y_component = y_largest OR x < y)")
        .where(_enough(threshold))
        .select("x", "y", F.col("y_n").cast("long").alias("y_n"))
        .distinct()
    )


def _further_hubs(open_rows: DataFrame, number: int, threshold: int) -> DataFrame:
    """(x, y, y_n): each node with one of another class, of those outside the largest class of a common token; other ones in each round."""
    place = F.xxhash64("node", F.lit(number)).alias("place")
    hubs = open_rows.where("component <> largest").groupBy("token").agg(F.max(F.struct(place, "node", "n", "room", "component")).alias("hub"))
    pairs = _as(hubs.select("token", "hub.*"), "x", "place", "node", "n", "room", "component").join(_as(open_rows, "y", "node", "n", "room", "component"), "token")
    pairs = pairs.where((F.col("x_component") != F.col("y_component")) & _enough(threshold))
    best = pairs.groupBy("y").agg(F.max(F.struct("x_place", "x")).alias("h"), F.first("y_n").cast("long").alias("y_n"))
    return best.select(F.col("h.x").alias("x"), "y", "y_n")


def search(query: np.ndarray, sets: list[np.ndarray], need: np.ndarray) -> list[int]:
    """Places in ``sets`` of those that have ``need`` tokens (one at least) of ``query``, by DivideSkip over its inverted lists."""
    if not len(query) or not sets:
        return []
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    at = np.minimum(np.searchsorted(query, every), len(query) - 1)
    mine = query[at] == every
    at, owner = at[mine], owner[mine]
    order = np.lexsort((owner, at))
    lists = np.split(owner[order], np.cumsum(np.bincount(at, minlength=len(query)))[:-1])
    lists.sort(key=len)
    least = max(1, int(need.min()))
    longest = len(lists[-1])
    aside = max(0, min(least - 1, len(lists) - 1, int(least / (0.01 * np.log2(longest + 2) + 1))))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    found = [(one, sum(1 for _ in same)) for one, same in groupby(heapq.merge(*(s.tolist() for s in short if len(s))))]
    found = [(one, n) for one, n in found if n >= least - aside]
    if not found:
        return []
    candidates = np.array([one for one, _ in found])
    overlap = np.array([n for _, n in found])
    for one in long:
        if len(one):
            place = np.minimum(np.searchsorted(one, candidates), len(one) - 1)
            overlap += one[place] == candidates
    return candidates[overlap >= need[candidates]].tolist()


def whole_need(n: int, sizes: np.ndarray, threshold: int) -> np.ndarray:
    """Overlap that whole sets of ``sizes`` need to link with one of ``n``."""
    return pair_overlap(n, sizes, threshold)


def first_need(n: int, sizes: np.ndarray, threshold: int) -> np.ndarray:
    """Overlap of first tokens that sets of ``sizes`` need at least to link with one of ``n``.

    Of the two sets, take the one whose first tokens end first. What else they share lies behind that end, so it is
    in the rest of that set: the overlap any link of it needs, less one.
    """
    rest = np.maximum(least_overlap(n, threshold), least_overlap(sizes, threshold)) - 1
    return np.maximum(pair_overlap(n, sizes, threshold) - rest, 1)


def _as_tokens(stored: bytes | list[int]) -> np.ndarray:
    return np.frombuffer(stored, np.uint64) if isinstance(stored, bytes) else np.array(stored, np.uint64)


def _found(pairs: DataFrame, sets: DataFrame, need, threshold: int) -> DataFrame:
    """Those of the distinct pairs (x, y, y_n) that reach ``need`` in ``sets`` (node, n, tokens). Each query x meets its candidates in chunks."""
    sizes = pairs.groupBy("x").agg(F.ceil(F.sum("y_n") / CHUNK).alias("parts"))
    pairs = pairs.join(sizes, "x").select("x", "y", F.pmod(F.xxhash64("y"), F.col("parts")).alias("part"))
    members = pairs.join(sets.withColumnRenamed("node", "y"), "y").select("x", "part", "y", "n", "tokens")
    queries = pairs.select("x", "part").distinct().join(sets.withColumnRenamed("node", "x"), "x")
    rows = members.unionByName(queries.select("x", "part", F.col("x").alias("y"), "n", "tokens"))

    def run(group: pa.Table) -> pa.Table:
        part = group.to_pydict()
        x = part["x"][0]
        every = [(y, n, _as_tokens(t)) for y, n, t in zip(part["y"], part["n"], part["tokens"], strict=True)]
        _, n, query = next(row for row in every if row[0] == x)
        others = [row for row in every if row[0] != x]
        tokens, ns = [t for _, _, t in others], np.array([m for _, m, _ in others], np.int64)
        hit = search(query, tokens, need(n, ns, threshold)) if others else []
        return pa.table({"x": pa.array([x] * len(hit), pa.int64()), "y": pa.array([others[i][0] for i in hit], pa.int64()), "y_n": pa.array(ns[hit], pa.int64())})

    return rows.groupBy("x", "part").applyInArrow(run, "x long, y long, y_n long")


def _links(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, firsts: DataFrame, order, words: int, threshold: int, scratch: Scratch, name: str) -> DataFrame:
    """(a, b): those of the distinct pairs (x, y, y_n) of nodes that link; ``firsts``: the first tokens a node shares."""
    likely = scratch.save(_found(pairs, firsts, first_need, threshold), f"likely-{name}")
    # Whole sets, from the texts, of the nodes that may link.
    sets = scratch.save(_tokens_of(docs, nodes.join(_ends(likely), "node", "left_semi"), order, words, threshold), f"sets-{name}")
    found = _found(likely, sets, whole_need, threshold).select(F.col("x").alias("a"), F.col("y").alias("b"))
    links = scratch.save(found, f"links-{name}")
    scratch.drop(f"likely-{name}", f"sets-{name}")
    return links


def classes(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select("doc_id", F.col(text).alias("text"))
    cells = {row[0]: row[1] for row in frequent_cells(docs, words).where(f"cell < 0 OR n >= 8").collect()}  # at most SKETCH
    order = spark.sparkContext.broadcast(Order(cells))
    first = scratch.save(_sets(docs, order, words, threshold, "text", prefix=True), "first")
    nodes = (
        first.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = scratch.save(nodes, "nodes")
    rows = scratch.save(first.select("doc_id", "n", "digest"), "rows")
    scratch.drop("first")
    # The tokens that a node shares with none leave less room for an overlap.
    of_node = Window.partitionBy("node")
    ranked = _shared(nodes).select(
        "token",
        "node",
        "n",
        F.count("*").over(of_node).alias("degree"),
        F.row_number().over(of_node.orderBy("at")).alias("place"),
    )
    first_tokens = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") / 100) + 1
    # What two nodes have in common of their first tokens is among the shared ones.
    shared = scratch.save(ranked.select("token", "node", "n", "degree", (F.col("n") - (first_tokens - F.col("degree")) - (F.col("place") - 1)).cast("int").alias("room")), "all")
    firsts = shared.groupBy("node").agg(F.first("n").cast("long").alias("n"), F.sort_array(F.collect_list("token")).alias("tokens"))
    firsts = scratch.save(firsts, "firsts")
    # Only rows whose room is enough for the smallest set of their token stay, then only tokens of two rows or more.
    smallest = shared.groupBy("token").agg(F.min("n").alias("x_n"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    fits = F.col("room") >= _needed(F.greatest("x_n", F.ceil(F.lit(threshold) * F.col("n") / 100)), F.col("n"), threshold)
    shared = scratch.save(shared.join(smallest, "token").where(fits).drop("x_n"), "shared")
    scratch.drop("all")

    # The hub of a node: of those it shares a token with, the one that shares most tokens itself.
    best = shared.groupBy("token").agg(F.max(F.struct("degree", (-F.col("node")).alias("node"), "n", "room")).alias("hub"), F.count("*").alias("rows"))
    best = best.where("rows > 1").select("token", (-F.col("hub.node")).alias("node"), "hub.degree", "hub.n", "hub.room")
    tried = (
        _as(best, "x", "node", "degree", "n", "room")
        .join(_as(shared, "y", "node", "n", "room"), "token")
        .where((F.col("x") != F.col("y")) & _enough(threshold))
        .groupBy("y")
        .agg(F.max(F.struct("x_degree", (-F.col("x")).alias("x"))).alias("h"), F.first("y_n").cast("long").alias("y_n"))
        .select((-F.col("h.x")).alias("x"), "y", "y_n")
    )
    tried = scratch.save(tried, "tried")
    links = _links(tried, docs, nodes, firsts, order, words, threshold, scratch, "hubs")
    # Members of one class that do not link with its first hub are tried with further ones, before they meet in pairs.
    number, enough, before = 0, PAIRS_PER_NODE * nodes.count(), None
    while True:
        label = components(links, scratch, f"hubs-{number}")
        open_rows = scratch.save(_open_rows(shared, label), f"open-{number}")
        left = _pairs(open_rows, threshold, ONE_IN).count() * ONE_IN
        if left <= enough or (before is not None and left > before * LEAST_GAIN):
            break
        number, before = number + 1, left
        tried = scratch.save(_further_hubs(open_rows, number, threshold), f"tried-{number}")
        links = links.unionByName(_links(tried, docs, nodes, firsts, order, words, threshold, scratch, f"hubs-{number}"))
        scratch.drop(f"open-{number - 1}", f"tried-{number}")
    pairs = scratch.save(_pairs(open_rows, threshold), "pairs")
    more = _links(pairs, docs, nodes, firsts, order, words, threshold, scratch, "pairs")
    scratch.drop("pairs", f"open-{number}", "shared", "tried", "firsts")
    final = components(links.unionByName(more), scratch, "all")

    least = nodes.join(final, "node").groupBy("component").agg(F.min("least").alias("component_id"))
    ids = nodes.select("node", "digest", "least").join(final, "node", "left").join(least, "component", "left")
    ids = ids.select("digest", F.coalesce("component_id", "least").alias("component_id"))
    result = rows.join(ids, "digest", "left")
    result = result.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    result = scratch.keep(result)
    scratch.drop_all()
    return result


def _cells_of(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * _MIX) >> np.uint64(64 - FILTER_BITS)


def _id_filter(ids: DataFrame):
    """A broadcast bitmap of fixed size that has a bit for each id; other ids may share it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.unique(_cells_of(batch.column(0).fill_null(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array((cells >> np.uint64(5)).astype(np.int32)), pa.array((cells & np.uint64(31)).astype(np.int32))], names=["word", "bit"])

    words = ids.mapInArrow(run, "word int, bit int").groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    found = words.toPandas()  # at most 2 ** FILTER_BITS / 32 rows
    bitmap = np.zeros(1 << FILTER_BITS - 5, np.uint32)
    bitmap[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return ids.sparkSession.sparkContext.broadcast(bitmap)


def _tokens_of(docs: DataFrame, wanted: DataFrame, order, words: int, threshold: int) -> DataFrame:
    """(node, n, tokens) of the wanted nodes: texts of one document of each are cut into shingles again.

    A bitmap of the documents' ids leaves out nearly all other texts before they are cut; the join by digest is exact.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    sets = _sets(texts, order, words, threshold, "text", prefix=False, among=_id_filter(wanted.select("least")))
    # Documents of one digest have one set, so any of them will do; the join finds the sets where they were put together.
    one = sets.where("digest IS NOT NULL").groupBy("digest").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    return wanted.select("node", "digest").join(one, "digest").select("node", "n", "tokens")
