"""Byte-level BPE: encoding with a hierarchical-bitmap rank queue, and decoding.

A text is cut by the tokenizer's pattern; each match is encoded by itself. Ranks are those of a public
vocabulary file, read once on the driver and broadcast (its size is fixed by the file, about 50,000 entries).

The queue has a bucket for each merge rank; a bucket holds positions of a linked list of parts. Three levels of
64-bit words mark which buckets hold anything, so find-first-set on three words gives the least rank. An entry
whose pair has changed since it was queued is stale and skipped. Pre-tokens that a worker has not met are encoded
many at a time under one queue; a very long one costs about n log n like the others.

Defined results: a NULL or empty text has no tokens and decodes to no bytes; repeated rows are encoded each;
further columns are passed through, a clash with an output name is refused by name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inflecta.llm.common import refuse, slices

#: Distinct chunks remembered by a worker before it starts anew: bounds its memory, changes no result.
REMEMBERED = 500_000
#: Characters of new pre-tokens that are encoded under one queue; a longer pre-token goes alone.
BLOCK_CHARS = 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a public ``.tiktoken`` file on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Buckets of linked-list positions by rank, under a three-level bitmap that finds the least rank."""

    __slots__ = ("buckets", "words", "groups", "top")

    def __init__(self):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.words: dict[int, int] = {}
        self.groups: dict[int, int] = {}
        self.top = 0

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        starts = np.flatnonzero(np.diff(ranks, prepend=-1))
        buckets, words, groups = self.buckets, self.words, self.groups
        for rank, a, b in zip(ranks[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(ranks)], strict=True):
            bucket = buckets.get(rank)
            if bucket is not None:
                bucket.append(positions[a:b])
                continue
            buckets[rank] = [positions[a:b]]
            word, group = rank >> 6, rank >> 12
            words[word] = words.get(word, 0) | 1 << (rank & 63)
            groups[group] = groups.get(group, 0) | 1 << (word & 63)
            self.top |= 1 << group

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The least rank and its positions in order, without repeats."""
        if not self.top:
            return None
        group = (self.top & -self.top).bit_length() - 1
        of_group = self.groups[group]
        word = group << 6 | (of_group & -of_group).bit_length() - 1
        of_word = self.words[word]
        rank = word << 6 | (of_word & -of_word).bit_length() - 1
        self.words[word] = of_word = of_word & (of_word - 1)
        if not of_word:
            self.groups[group] = of_group = of_group & (of_group - 1)
            if not of_group:
                self.top &= self.top - 1
        bucket = self.buckets.pop(rank)
        return rank, bucket[0] if len(bucket) == 1 else np.unique(np.concatenate(bucket))


class Merges:
    """Rank of the token that two neighbouring tokens make, for arrays of them; -1 where there is none."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int32)[order]
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], -1)


def encode_pieces(pieces: list[bytes], merges: Merges) -> list[np.ndarray]:
    """Ids of each pre-token.

    All pre-tokens lie in one linked list of parts, cut between them, under one queue: they do not touch each
    other, so taking the least rank of all is the least rank of each. Positions of one rank are merged at once,
    but for neighbours, of which the left goes first: every second one of a run of overlapping pairs, or, where
    a merge makes a pair of a lesser rank, only the first of each run, before the queue is asked again.
    """
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    n = int(lengths.sum())
    token = np.append(merges.of_byte[np.frombuffer(b"".join(pieces), np.uint8)], np.int32(-1))
    follows, before = np.arange(1, n + 2), np.arange(-1, n)
    stops = np.cumsum(lengths)
    filled = lengths > 0
    follows[stops[filled] - 1] = n  # n: no neighbour
    before[(stops - lengths)[filled]] = n
    follows[n] = before[n] = n
    current = np.full(n + 1, -1, np.int32)  # rank of the part here with the next one
    inner = np.flatnonzero(follows[:n] < n)
    current[inner] = merges.find(token[inner], token[inner + 1])
    queue = RankQueue()
    inner = inner[current[inner] >= 0]
    queue.push(current[inner], inner)
    while (head := queue.pop()) is not None:
        rank, at = head
        at = at[current[at] == rank]  # the others are stale
        if not len(at):
            continue
        place = np.arange(len(at))
        overlaps = np.append(False, follows[at[:-1]] == at[1:])
        first = np.maximum.accumulate(np.where(overlaps, 0, place))
        every, at = at, at[(place - first) % 2 == 0]
        touches = np.append(False, follows[follows[at[:-1]]] == at[1:])
        if touches.any():
            left = before[at]
            made = np.maximum(merges.find(token[left], np.full(len(at), rank)), -1)
            between = merges.find(np.full(len(at), rank), token[follows[follows[at]]])
            if ((made >= 0) & (made < rank)).any() or ((between >= 0) & (between < rank)).any():
                at = at[~touches]
                rest = np.setdiff1d(every, at, assume_unique=True)
                queue.push(np.full(len(rest), rank, np.int32), rest)
        absorbed = follows[at]
        after = follows[absorbed]
        token[at] = rank
        token[absorbed] = current[absorbed] = -1
        follows[at] = after
        before[after] = at
        before[n] = n
        changed = before[at]
        changed = np.unique(np.concatenate([at, changed[changed < n]]))
        new = np.where(follows[changed] < n, merges.find(token[changed], token[follows[changed]]), -1)
        current[changed] = new
        queue.push(new[new >= 0], changed[new >= 0])
    alive = np.flatnonzero(token[:n] >= 0)
    cuts = np.searchsorted(alive, stops)
    ids = token[alive]
    return [ids[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]


#: Places where every match of the pattern ends and a new one begins, told by two characters before and one behind:
#: before a space after no white space, after a single line end, behind a letter or digit, before a sign or white space.
_CUTS = regex.compile(r"(?<=\S)(?= )|(?<=\S\n)(?=[^\s/])|(?<=[\p{L}\p{N}])(?=[^\p{L}\p{N}\p{M}'’])")
#: Characters of a chunk from which a text is cut at all such places.
LONG_CHUNK = 256


def pieces_of(text: str) -> list[str]:
    """The text cut at every place where matches are known to meet; each piece is encoded by itself."""
    return _CUTS.split(text)


class Encoder:
    """Encodes texts, remembering chunks.

    A text is first cut before each single space that stands between two characters that are no white space.
    The tokenizer's pattern always begins a match there (``spaced``), so a chunk is cut and encoded by itself and
    a chunk met before is not encoded again. A text with other white space around a space is cut as a whole.
    """

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.split = merges, regex.compile(pattern).findall
        self.known: dict[str, bytes | None] = {}  # chunk after a space: ids as int32, or None if not spaced

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as int32, all matches encoded in blocks of bounded bytes."""
        cut = [self.split(text) for text in texts]
        new = list(set().union(*cut))
        ids: dict[str, bytes] = {}
        block, size = [], 0
        for i, one in enumerate(new):
            block.append(one)
            size += len(one)
            if size >= BLOCK_CHARS or i == len(new) - 1:
                found = encode_pieces([t.encode() for t in block], self.merges)
                ids.update((t, x.tobytes()) for t, x in zip(block, found, strict=True))
                block, size = [], 0
        return [b"".join(map(ids.__getitem__, tokens)) for tokens in cut]

    def _learn(self, chunks: set[str], texts: list[str]) -> list[bytes]:
        """Get to know the chunks; ids of further texts, encoded with them."""
        known = self.known
        new = [c for c in chunks if c not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(chunks)
        spaced = [c for c in new if c and not c[0].isspace() and not c[-1].isspace()]
        ids = self.encode([*(" " + c for c in spaced), *texts])
        known.update(dict.fromkeys(new))
        known.update(zip(spaced, ids, strict=False))
        return ids[len(spaced) :]

    def ids(self, texts: list[str | None]) -> list[list[bytes]]:
        """Ids of each text as int32 bytes, one entry for each of its chunks (``chunks_of`` gives their texts)."""
        cut = [text.split(" ") if text else [""] for text in texts]
        first = [parts.pop(0) for parts in cut]
        own = self._learn(set().union(*cut), first)
        find = self.known.__getitem__
        out = [list(map(find, parts)) for parts in cut]
        odd = [i for i, ids in enumerate(out) if ids and (not first[i] or first[i][-1].isspace() or None in ids)]
        for i, ids in zip(odd, self.encode([texts[i] for i in odd]), strict=True):
            own[i], out[i] = ids, []
        for ids, start in zip(out, own, strict=True):
            ids.insert(0, start)
        return out

    def counts(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Characters and token counts (int32) of each text's leaves: its chunks, or its ``pieces_of`` where a chunk is long or not spaced."""
        cut = [text.split(" ") for text in texts]
        self._learn(set().union(*(parts[1:] for parts in cut)), [])
        sizes = [np.fromiter(map(len, parts), np.int32, len(parts)) for parts in cut]
        known, fine, first = self.known, [], []
        for i, (parts, size) in enumerate(zip(cut, sizes, strict=True)):
            if size.max() > LONG_CHUNK or (len(parts) > 1 and (not parts[0] or parts[0][-1].isspace() or any(known[c] is None for c in parts[1:]))):
                fine.append(i)
                cut[i] = pieces_of(texts[i])
                sizes[i] = np.fromiter(map(len, cut[i]), np.int32, len(cut[i]))
            else:
                size[1:] += 1  # the space that a chunk begins with
                first.append(parts[0])
        apart = list({*first, *(piece for i in fine for piece in cut[i])})
        own = dict(zip(apart, (len(ids) // 4 for ids in self.encode(apart)), strict=True))
        out, fine = [], set(fine)
        for i, (parts, size) in enumerate(zip(cut, sizes, strict=True)):
            if i in fine:
                n = np.fromiter(map(own.__getitem__, parts), np.int32, len(parts))
            else:
                n = np.fromiter((len(known[c]) for c in parts[1:]), np.int32, len(parts) - 1) // 4
                n = np.concatenate([[own[parts[0]]], n]).astype(np.int32)
            out.append((size, n))
        return out


def chunks_of(text: str, ids: list[bytes]) -> list[str]:
    """The chunks that ``ids`` are of."""
    parts = text.split(" ") if len(ids) > 1 else [text]
    return [parts[0], *[" " + part for part in parts[1:]]]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """All columns of ``docs`` and ``ids``, an array of int, never NULL."""
    refuse(docs.columns, ids)
    merges = docs.sparkSession.sparkContext.broadcast(Merges(load_ranks(ranks_path)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges.value, pattern)
        for batch in slices(batches, text, 2048, 8 << 20):
            flat = [b"".join(ids) for ids in encoder.ids(batch.column(batch.schema.get_field_index(text)).to_pylist())]
            offsets = np.cumsum([0, *map(len, flat)]) // 4
            values = np.frombuffer(b"".join(flat), np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, ids])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, ranks_path: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and ``decoded``: the bytes of the tokens, joined; NULL ids give NULL."""
    refuse(rows.columns, decoded)
    by_id = {rank: token for token, rank in load_ranks(ranks_path).items()}
    tokens = rows.sparkSession.sparkContext.broadcast(by_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens.value.__getitem__
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                lists = batch.column(batch.schema.get_field_index(ids))
                out = [None if one is None else b"".join(map(token, one.tolist())) for one in _arrays(lists)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, decoded])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(decoded, T.BinaryType())]))


def _arrays(lists: pa.ListArray) -> Iterator[np.ndarray | None]:
    values = lists.values.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    for i, valid in enumerate(lists.is_valid().to_pylist()):
        yield values[offsets[i] : offsets[i + 1]] if valid else None


def token_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row: encoded, then decoded from the ids."""
    encoded = encode(docs.select("doc_id", "text"), ranks_path, pattern).drop("text")
    both = decode(encoded, ranks_path)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
