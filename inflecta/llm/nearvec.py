"""Near-duplicate vectors by a subspace pigeonhole join.

Two vectors of one label link when their cosine is at least ``threshold``, that is, when their unit vectors lie within
a squared distance of 2 - 2 * threshold. Unit vectors are rotated (a fixed orthogonal matrix for each dimension, so no
block is poor by how the input was made) and split into blocks of ``BLOCK`` dimensions. If all blocks of a pair were
further apart than their share of the squared distance, the pair would be; so each link is found in some block:

* In each block vectors are range-joined over the cells of a k-d tree on all of the block's coordinates. A vector goes
  to each cell that lies within the block's squared budget of it, summed over coordinates; the unit of two cells
  gets the vectors of each that reach the other. Trees grow with the label, to cells of about ``PART`` vectors: the
  more vectors, the smaller the share of the label that one of them meets.
* Trees are fitted on a sample of about ``PER_LEAF`` vectors a cell, by hash; every vector is dealt by them. ``LEAVES``
  bounds the cells of all trees, which are broadcast, and ``LABEL_LEAVES`` those of a label's. A cell that holds more
  than ``PART`` vectors all the same is cut into parts by hash, and each pair of parts is a unit, so neither a
  dense place nor a large label meets in one task.
* A unit tests the block's distance, then verifies the candidates by cosine in double precision on the vectors as they
  came, and keeps a pair only in the first block that finds it.
* It returns, for each vector, how many vectors it linked here and the least of those it is connected with here; so
  a group of thousands is not written out as pairs.

Equal vectors of a label are one node with a count. Exact: no link is missed and none is below the threshold.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components, and vectors without a label,
link with nothing; vectors of different lengths do not link; repeated rows are vectors of their own; NULL ids take
part, their class has the least id that is not NULL.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inflecta.llm.common import Scratch
from inflecta.llm.components import components

THRESHOLD, BLOCK, PART = 0.93, 8, 2048
#: Share of PART that a cell is planned for; sampled vectors for each cell of a tree.
FILL, PER_LEAF = 0.75, 16
#: Bounds of the cells of the trees of one label in one block, and of all trees of all labels and blocks.
LABEL_LEAVES, LEAVES = 4096, 1 << 19
#: Vectors of so many dimensions make parts of PART; those of more make smaller ones, of as many bytes.
DIMENSIONS = 64


def rotation(dim: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int) -> list[tuple[int, int]]:
    """Start and end of each block of dimensions."""
    n = -(-dim // BLOCK)
    cuts = [dim * i // n for i in range(n + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _prepared(vectors: DataFrame, code: str) -> DataFrame:
    """(vec_id, label, dim, digest, vector): dim and digest NULL where the vector takes part in nothing."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values = lists.values.to_numpy(zero_copy_only=False).astype(code)
            offsets, there = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
            labelled = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            dims, digests, out = [], [], []
            for i in range(batch.num_rows):
                own = values[offsets[i] : offsets[i + 1]] + 0  # -0.0 counts as 0.0
                norm = np.linalg.norm(own.astype(np.float64))
                used = there[i] and labelled[i] and np.isfinite(own).all() and 0 < norm < np.inf
                dims.append(len(own) if used else None)
                out.append(own.tobytes() if used else None)
                digests.append(xxhash.xxh3_128_digest(out[-1]) if used else None)
            columns = [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "dim", "digest", "vector"])

    kind = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.mapInArrow(run, f"vec_id {kind['vec_id']}, label {kind['label']}, dim int, digest binary, vector binary")


class Tree:
    """Cells of a block, by cuts of one coordinate after another: nodes in preorder, the left one next to its parent."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.nodes: list[tuple[int, float, int]] = []  # coordinate, cut and place of the right node; -1, 0 and number of a cell
        self.leaves = 0
        self._grow(points, leaves)
        self.axis, self.cut, self.right = (np.array(c, k) for c, k in zip(zip(*self.nodes, strict=True), (np.int16, np.float64, np.int32), strict=True))
        del self.nodes

    def _grow(self, points: np.ndarray, leaves: int) -> None:
        """Cut where the points spread most, so that both sides get the share of the points that their cells are."""
        if leaves > 1 and len(points) > 1:
            axis = int(np.argmax(points.std(0)))
            values = np.sort(points[:, axis])
            at = int(np.searchsorted(values, values[len(values) * (leaves // 2) // leaves], "left"))
            at = at or int(np.searchsorted(values, values[0], "right"))  # equal values stay together
            if 0 < at < len(values):
                cut, place = float(values[at]), len(self.nodes)
                self.nodes.append((axis, cut, 0))
                low = points[:, axis] < cut
                self._grow(points[low], leaves // 2)
                self.nodes[place] = axis, cut, len(self.nodes)
                self._grow(points[~low], leaves - leaves // 2)
                return
        self.nodes.append((-1, 0.0, self.leaves))
        self.leaves += 1

    def reached(self, points: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, own cell, cell) for each cell within the squared distance ``budget`` of a row's point."""
        own, rows_of, cell_of = np.zeros(len(points), np.int64), [], []
        todo = [(0, np.arange(len(points)), np.zeros(points.shape), np.ones(len(points), bool))]
        while todo:
            at, rows, off, inside = todo.pop()
            axis = int(self.axis[at])
            if axis < 0:
                own[rows[inside]] = self.right[at]
                rows_of.append(rows)
                cell_of.append(np.full(len(rows), self.right[at], np.int64))
                continue
            over = points[rows, axis] - self.cut[at]
            for node, beyond, here in ((at + 1, over, over < 0), (int(self.right[at]), -over, over >= 0)):
                further = off.copy()
                np.maximum(further[:, axis], beyond, out=further[:, axis])
                near = (further * further).sum(1) <= budget
                if near.any():
                    todo.append((node, rows[near], further[near], (inside & here)[near]))
        rows = np.concatenate(rows_of)
        return rows, own[rows], np.concatenate(cell_of)


def budgets_of(dim: int, threshold: float) -> np.ndarray:
    """Each block's share of the squared distance, with room for rounding."""
    return np.array([(2 - 2 * threshold) * (b - a) / dim for a, b in blocks_of(dim)]) + 1e-9


def _turned(vectors: pa.Array, dim: int, code: str) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(vectors.to_pylist()), code).reshape(-1, dim)) @ rotation(dim)


def _trees(nodes: DataFrame, code: str, scratch: Scratch) -> dict[tuple[str, int], list[Tree]]:
    """The trees of each block of each label (as text) and dimension that has more than one part."""
    most = _most()
    sizes = scratch.save(nodes.groupBy("label", "dim").agg(F.count("*").alias("size")).where(F.col("size") > most), "sizes")
    leaves = F.least(F.lit(LABEL_LEAVES).cast("double"), F.ceil(F.col("size") / F.greatest(most * FILL, F.lit(1.0))))
    total = sizes.agg(F.sum(leaves * F.ceil(F.col("dim") / BLOCK))).first()[0] or 0
    sizes = sizes.withColumn("leaves", F.ceil(leaves / max(1.0, total / LEAVES)).cast("int")).where("leaves > 1")
    drawn = F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) < F.col("leaves") * PER_LEAF / F.col("size") * (1 << 30)
    sample = nodes.select("label", "dim", "digest", "vector").join(sizes, ["label", "dim"]).where(drawn)

    def grow(rows: pa.Table) -> pa.Table:
        dim, leaves = rows["dim"][0].as_py(), rows["leaves"][0].as_py()
        turned = _turned(rows["vector"], dim, code)
        body = pickle.dumps([Tree(turned[:, a:b], leaves) for a, b in blocks_of(dim)])
        return pa.table({"name": rows["name"].slice(0, 1), "dim": rows["dim"].slice(0, 1), "body": pa.array([body], pa.binary())})

    sample = sample.select(F.col("label").cast("string").alias("name"), "dim", "leaves", "vector")
    grown = sample.groupBy("name", "dim").applyInArrow(grow, "name string, dim int, body binary")
    return {(r["name"], r["dim"]): pickle.loads(r["body"]) for r in grown.collect()}  # at most 2 * LEAVES cells


def _most() -> Column:
    """Vectors of a part."""
    return F.greatest(F.lit(1), F.floor(F.lit(PART * DIMENSIONS) / F.greatest(F.col("dim"), F.lit(DIMENSIONS))))


def _reached(nodes: DataFrame, threshold: float, code: str, trees) -> DataFrame:
    """(node, name, dim, block, own, cell): each cell that a node reaches in each block, its own one among them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for start in range(0, large.num_rows, 1024):
                table = pa.Table.from_batches([large.slice(start, 1024)])
                keys = list(zip(table["name"].to_pylist(), table["dim"].to_pylist(), strict=True))
                groups: dict[tuple[str | None, int], list[int]] = {}
                for row, (name, dim) in enumerate(keys):
                    groups.setdefault((name if (name, dim) in trees.value else None, dim), []).append(row)
                for (name, dim), places in groups.items():
                    part = table.take(pa.array(places)).combine_chunks()
                    turned = None if name is None else _turned(part["vector"], dim, code)
                    for block, (a, b) in enumerate(blocks_of(dim)):
                        if name is None:
                            rows, own = np.arange(len(places)), np.zeros(len(places), np.int64)
                            cell = own
                        else:
                            rows, own, cell = trees.value[name, dim][block].reached(turned[:, a:b], budgets_of(dim, threshold)[block])
                        found = part.select(["node", "name", "dim"]).take(pa.array(rows))
                        for column, values in (("block", np.full(len(rows), block)), ("own", own), ("cell", cell)):
                            found = found.append_column(column, pa.array(values, pa.int32()))
                        yield from found.to_batches()

    rows = nodes.select("node", F.col("label").cast("string").alias("name"), "dim", "vector")
    return rows.mapInArrow(run, "node long, name string, dim int, block int, own int, cell int")


def _units(nodes: DataFrame, reached: DataFrame) -> DataFrame:
    """The rows of all units of work: (unit, dim, block, side, node, n, vector); side 0, 1, or 2 for both."""
    place = ["name", "dim", "block"]
    # A row for each cell of more than one part.
    parts = reached.where("own = cell").groupBy(*place, "cell").agg(F.ceil(F.count("*") / F.first(_most())).alias("parts")).where("parts > 1")
    rows = reached
    for cell, count in (("own", "parts"), ("cell", "others")):
        rows = rows.join(parts.select(*place, F.col("cell").alias(cell), F.col("parts").alias(count)), [*place, cell], "left")
    rows = rows.withColumns({"parts": F.coalesce("parts", F.lit(1)), "others": F.coalesce("others", F.lit(1))})
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
    mine, theirs = F.struct(F.col("own").alias("cell"), F.col("part").alias("part")), F.struct(F.col("cell").alias("cell"), F.col("other").alias("part"))
    ends = F.array_sort(F.array(mine, theirs))
    side = F.when(mine == theirs, 2).when(mine < theirs, 0).otherwise(1)
    # The label comes last: it may hold the mark.
    name = F.concat_ws("|", "dim", "block", *(F.get(ends, F.lit(i))[c] for i in (0, 1) for c in ("cell", "part")), "name")
    rows = rows.select(name.alias("unit"), "dim", "block", side.alias("side"), "node")
    return rows.join(nodes.select("node", "n", "vector"), "node").select("unit", "dim", "block", "side", "node", "n", "vector")


def _least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the least place it is connected with by the pairs (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked_in_unit(dim: int, block: int, side: np.ndarray, raw: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of the links of a unit whose first block this is."""
    blocks, budgets, turn = blocks_of(dim), budgets_of(dim, threshold), rotation(dim)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    same = bool((side == 2).all())
    vectors = _unit(raw)
    coords = vectors @ turn[:, slice(*blocks[block])]
    squares = (coords * coords).sum(1)
    double = raw.astype(np.float64)
    norms = np.linalg.norm(double, axis=1)
    found_a, found_b = [], []
    for start in range(0, len(left), 256):
        rows = left[start : start + 256]
        near = squares[rows][:, None] + squares[right][None] - 2 * (coords[rows] @ coords[right].T) <= budgets[block]
        if same:
            near &= rows[:, None] < right[None]
        i, j = np.nonzero(near)
        for at in range(0, len(i), 8192):
            a, b = rows[i[at : at + 8192]], right[j[at : at + 8192]]
            hit = np.einsum("nd,nd->n", double[a], double[b]) / (norms[a] * norms[b]) >= threshold
            a, b = a[hit], b[hit]
            if block and len(a):
                apart = ((vectors[a] - vectors[b]) @ turn) ** 2
                earlier = np.add.reduceat(apart, [s for s, _ in blocks], axis=1)[:, :block] <= budgets[:block]
                a, b = a[~earlier.any(1)], b[~earlier.any(1)]
            found_a.append(a)
            found_b.append(b)
    return tuple(np.concatenate(f) if f else np.empty(0, np.int64) for f in (found_a, found_b))


def _found(units: DataFrame, threshold: float, code: str) -> DataFrame:
    """(node, links, root) of the nodes that link in a unit. Only one unit is held at a time."""

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(rows).combine_chunks()
        if table.num_rows < 2:
            return None
        dim, block = table["dim"][0].as_py(), table["block"][0].as_py()
        raw = np.frombuffer(b"".join(table["vector"].to_pylist()), code).reshape(table.num_rows, dim)
        a, b = linked_in_unit(dim, block, table["side"].to_numpy(), raw, threshold)
        if not len(a):
            return None
        n, node = table["n"].to_numpy(), table["node"].to_numpy()
        links = np.bincount(a, n[b], len(n)) + np.bincount(b, n[a], len(n))
        order = np.argsort(node, kind="stable")
        rank = np.empty(len(node), np.int64)
        rank[order] = np.arange(len(node))
        root = node[order][_least_reachable(len(node), rank[a], rank[b])[rank]]
        at = np.flatnonzero(links > 0)
        return pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(links[at].astype(np.int64)), pa.array(root[at])], names=["node", "links", "root"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            units = batch.column(0)
            ends = units.dictionary_encode().indices.to_numpy()
            starts = np.flatnonzero(np.diff(ends, prepend=-1))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
                if units[a].as_py() != current:
                    if held and (made := settle(held)) is not None:
                        yield made
                    held, current = [], units[a].as_py()
                held.append(batch.slice(a, b - a))
        if held and (made := settle(held)) is not None:
            yield made

    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "node long, links long, root long")


def classes(vectors: DataFrame, threshold: float = THRESHOLD, vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``vectors`` (vec_id, label, vector)."""
    scratch = Scratch(vectors.sparkSession)
    single = vectors.schema[vector].dataType.elementType == T.FloatType()
    kind, code = ("array<float>", "<f4") if single else ("array<double>", "<f8")
    rows = vectors.select("vec_id", "label", F.col(vector).cast(kind).alias("vector"))
    rows = scratch.save(_prepared(rows, code), "rows")
    nodes = rows.where("digest IS NOT NULL").groupBy("label", "dim", "digest")
    nodes = nodes.agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    nodes = scratch.save(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    trees = vectors.sparkSession.sparkContext.broadcast(_trees(nodes, code, scratch))
    reached = scratch.save(_reached(nodes, threshold, code, trees), "reached")
    found = scratch.save(_found(_units(nodes, reached), threshold, code), "found")
    scratch.drop("reached")
    label = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch, "classes")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "label", "dim", "digest", "n", "least").join(links, "node", "left").join(label, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    ids = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(ids, "component").select("label", "dim", "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    result = rows.select("vec_id", "label", "dim", "digest").join(known, ["label", "dim", "digest"], "left")
    result = result.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    result = scratch.keep(result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
    scratch.drop_all()
    return result
