"""Token counts that follow edits.

``build_trees`` keeps for each document the leaves of a segment tree (a few whole pre-tokens each, about
a word, see ``bpe.Encoder``): their lengths in characters and the tree of their token counts. ``apply_edits`` finds
the leaves that an edit touches by descending a tree of lengths, re-encodes only these with the leaves whose
pre-tokens could reach the edit, cuts them anew and updates the sums above them. A leaf holds at most ``CROWDED``
pieces: where more come, leaves are put in and the sums (numbers only) are renewed. The rest of the text is never
encoded again, whatever blanks it has.

An edit is (start, end, replacement) in characters of the text as the edits before it left it; start and end are
moved into the text, an end before the start counts as the start, a NULL replacement as empty. A NULL text counts
as empty (edits may fill it); NULL edits are none, NULL bounds are 0. Repeated rows are counted each; further
columns are passed through, a clash with an output name is refused by name.

A leaf never gets smaller than a pre-token, and a run of letters without any break is one pre-token.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from inflecta.llm.bpe import Encoder, Merges, load_ranks, pieces_of
from inflecta.llm.common import refuse, slices

EDITS = "array<struct<start:int,end:int,replacement:string>>"
#: Characters from which a place between leaves is told: so far before and behind an edit leaves are encoded again.
CONTEXT = 3
#: Pieces that a leaf holds at most.
CROWDED = 16


def sums_above(leaves: np.ndarray) -> np.ndarray:
    """The tree over ``leaves``: node i has children 2i and 2i+1, the root is 1, leaves start at half its length."""
    width = 1 << max(0, len(leaves) - 1).bit_length()
    tree = np.zeros(2 * width, np.int32)
    tree[width : width + len(leaves)] = leaves
    while width > 1:
        half = width // 2
        tree[half:width] = tree[width : 2 * width].reshape(-1, 2).sum(1)
        width = half
    return tree


def _set(tree: np.ndarray, first: int, values: np.ndarray) -> None:
    """Put ``values`` at leaves from ``first`` and renew the sums above them."""
    low = len(tree) // 2 + first
    high = low + len(values)
    tree[low:high] = values
    while low > 1:
        low, high = low // 2, (high - 1) // 2 + 1
        tree[low:high] = tree[2 * low : 2 * high].reshape(-1, 2).sum(1)


def _leaf_at(tree: np.ndarray, at: int) -> tuple[int, int]:
    """The leaf that holds character ``at``, and where it starts."""
    node, start, width = 1, 0, len(tree) // 2
    while node < width:
        node *= 2
        left = int(tree[node])
        if at - start >= left:
            start += left
            node += 1
    return node - width, start


class CountedText:
    """A text under edits, its tree of lengths and its tree of token counts."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, encoder: Encoder):
        self.text, self.leaves, self.encoder = text, len(chars), encoder
        self.chars, self.tokens = sums_above(chars), tokens.copy()
        self.encoded = 0  # characters encoded again

    def edit(self, start: int, end: int, replacement: str) -> None:
        size = len(self.text)
        start = min(max(start, 0), size)
        end = min(max(end, start), size)
        a = b = first = 0
        if size:
            a, first = _leaf_at(self.chars, max(0, min(start, size - 1) - CONTEXT))
            b, last = _leaf_at(self.chars, min(end + CONTEXT, size - 1))
            stop = last + int(self.chars[len(self.chars) // 2 + b])
        else:
            stop = 0
        self.text = self.text[:start] + replacement + self.text[end:]
        pieces = pieces_of(self.text[first : stop + len(replacement) - (end - start)])
        self.encoded += sum(map(len, pieces))
        chars = np.fromiter(map(len, pieces), np.int32, len(pieces))
        tokens = np.fromiter(map(len, self.encoder.encode(pieces)), np.int32, len(pieces)) // 4
        slots = b - a + 1
        if len(pieces) > CROWDED * slots:
            self._splice(a, b, chars, tokens)
            return
        # Dealt in order over the leaves there are.
        starts = np.arange(slots) * len(pieces) // slots
        for tree, values in ((self.chars, chars), (self.tokens, tokens)):
            above = np.append(0, np.cumsum(values))
            _set(tree, a, np.diff(above[np.append(starts, len(pieces))]))

    def _splice(self, a: int, b: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """Put new leaves in the place of leaves a to b."""
        for name, values in (("chars", chars), ("tokens", tokens)):
            tree = getattr(self, name)
            leaves = tree[len(tree) // 2 :][: self.leaves]
            setattr(self, name, sums_above(np.concatenate([leaves[:a], values, leaves[b + 1 :]])))
        self.leaves += len(chars) - (b - a + 1)


def build_trees(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns of ``docs``; ``leaf_chars`` and ``token_tree`` (int32 as bytes, see ``sums_above``); ``n_tokens`` long."""
    merges = docs.sparkSession.sparkContext.broadcast(Merges(load_ranks(ranks_path)))
    return docs.mapInArrow(_building(merges, pattern, text), _built(docs.schema))


def _built(schema: T.StructType) -> T.StructType:
    refuse(schema.names, "leaf_chars", "token_tree", "n_tokens")
    kinds = (("leaf_chars", T.BinaryType()), ("token_tree", T.BinaryType()), ("n_tokens", T.LongType()))
    return T.StructType([*schema.fields, *(T.StructField(n, k) for n, k in kinds)])


def _building(merges, pattern: str, text: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges.value, pattern)
        for batch in slices(batches, text, 2048, 8 << 20):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            chars, trees, totals = [], [], []
            for sizes, ids in encoder.counts(texts):
                chars.append(sizes.tobytes())
                tree = sums_above(ids)
                trees.append(tree.tobytes())
                totals.append(int(tree[1]))
            new = [pa.array(chars, pa.binary()), pa.array(trees, pa.binary()), pa.array(totals, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "leaf_chars", "token_tree", "n_tokens"])

    return run


def apply_edits(trees: DataFrame, ranks_path: str, pattern: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """The rows of ``build_trees`` with column ``edits``, after the edits.

    ``text``, ``leaf_chars``, ``token_tree`` and ``n_tokens`` are renewed, ``edits`` becomes NULL; ``n_tokens_before``
    (long), ``n_edits`` (int) and ``chars_encoded`` (long, characters encoded again) are added.
    """
    merges = trees.sparkSession.sparkContext.broadcast(Merges(load_ranks(ranks_path)))
    return trees.mapInArrow(_editing(merges, pattern, text, edits), _edited(trees.schema))


def _edited(schema: T.StructType) -> T.StructType:
    refuse(schema.names, "n_tokens_before", "n_edits", "chars_encoded")
    kinds = (("n_tokens_before", T.LongType()), ("n_edits", T.IntegerType()), ("chars_encoded", T.LongType()))
    return T.StructType([*schema.fields, *(T.StructField(n, k) for n, k in kinds)])


def _editing(merges, pattern: str, text: str, edits: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges.value, pattern)
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            before, done, encoded = columns["n_tokens"], np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            given = pc.fill_null(pc.list_value_length(columns[edits]), 0).to_numpy()
            state: dict[str, list] = {n: [] for n in (text, "leaf_chars", "token_tree", "n_tokens")}
            for i in np.flatnonzero(given).tolist():
                chars, tokens = (np.frombuffer(columns[n][i].as_py(), np.int32) for n in ("leaf_chars", "token_tree"))
                counted = CountedText(columns[text][i].as_py() or "", chars, tokens, encoder)
                for edit in columns[edits][i].as_py():
                    if edit is not None:
                        counted.edit(edit["start"] or 0, edit["end"] or 0, edit["replacement"] or "")
                        done[i] += 1
                encoded[i] = counted.encoded
                width = len(counted.chars) // 2
                new = counted.text, counted.chars[width : width + counted.leaves].tobytes(), counted.tokens.tobytes(), int(counted.tokens[1])
                for values, value in zip(state.values(), new, strict=True):
                    values.append(value)
            if given.any():  # only the rows with edits change
                mask = pa.array(given > 0)
                columns |= {n: pc.replace_with_mask(columns[n], mask, pa.array(values, columns[n].type)) for n, values in state.items()}
            columns[edits] = pa.nulls(batch.num_rows, columns[edits].type)
            yield pa.RecordBatch.from_arrays(
                [*(columns[n] for n in batch.schema.names), before, pa.array(done), pa.array(encoded)],
                names=[*batch.schema.names, "n_tokens_before", "n_edits", "chars_encoded"],
            )

    return run


#: What counts as personal data in ``masking_edits``: addresses with an at sign, and runs of five digits or more.
_DIGITS = re.compile(r"[0-9]{5,}")
_MAIL_OR_DIGITS = re.compile(r"[^\s@]*@[^\s@]+|[0-9]{5,}")


def masking_edits(docs: DataFrame, text: str = "text", edits: str = "edits", mask: str = "***") -> DataFrame:
    """Add ``edits`` that replace personal data by ``mask``, last place first, so that each fits the text it finds."""
    return docs.mapInArrow(_masking(text, edits, mask), _masked(docs.schema, edits))


def _masked(schema: T.StructType, edits: str) -> T.StructType:
    refuse(schema.names, edits)
    return T.StructType([*schema.fields, T.StructField(edits, T._parse_datatype_string(EDITS))])


def _masking(text: str, edits: str, mask: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 2048, 8 << 20):
            found = []
            for one in batch.column(batch.schema.get_field_index(text)).to_pylist():
                matches = list((_MAIL_OR_DIGITS if "@" in (one or "") else _DIGITS).finditer(one or ""))
                found.append([{"start": m.start(), "end": m.end(), "replacement": mask} for m in reversed(matches)])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("replacement", pa.string())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, edits])

    return run


def counts_after_masking(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_edits, n_tokens_before, n_tokens, chars_encoded) of each row, personal data masked by edits."""
    docs = docs.select("doc_id", "text")
    merges = docs.sparkSession.sparkContext.broadcast(Merges(load_ranks(ranks_path)))
    mask, build, edit = _masking("text", "edits", "***"), _building(merges, pattern, "text"), _editing(merges, pattern, "text", "edits")
    kept = ["doc_id", "n_edits", "n_tokens_before", "n_tokens", "chars_encoded"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The three operators one after the other in one worker; texts and trees need not leave it.
        for batch in edit(build(mask(batches))):
            yield batch.select(kept)

    schema = _edited(_built(_masked(docs.schema, "edits")))
    return docs.mapInArrow(run, T.StructType([schema[c] for c in kept]))
