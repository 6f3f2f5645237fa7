"""Benchmark decontamination: a BM25 index of test items, searched by every training passage with block-max WAND.

Words are what white space separates, in lower case and without marks at their ends. An item's posting weights are its
BM25 contributions divided by their sum, so a passage's score for an item lies between 0 and 1: how much of the item's
weight the passage covers, whatever the item's length. Every overlapping passage of every text is a query, and all
items with a score of ``least`` or more are retrieved: items are numbered so that neighbours share words, posting lists
are cut into blocks of ``BLOCK`` numbers with the greatest weight of each, and a passage whose bounds reach the
threshold in no block is done; the others are searched with cursors, pivot and block skips.

A retrieved item is verified: of its question (all but the last sentence) and of its answer (the last one) enough
n-grams of up to three words must stand in the passage. An item of one sentence is question and answer at once.

Item count, mean length and the number of items with a word are those of all items, and passages are twice as long as
the upper bound of the item's length class, a power of two: what is found of an item does not depend on how items are
dealt to shards. Shards of bounded size are indexed in tasks and broadcast; documents are never shuffled. One worker of a
task goes through all shards for each batch of texts and holds one of them at a time.

Defined results: NULL, empty and word-less texts and items match nothing; equal items match each; repeated rows are
searched each; no items leave every document unmatched.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inflecta.llm.common import Scratch, refuse, slices

K1, B = 1.2, 0.75
#: Least score of a retrieved item; least share of n-grams of its question and of its answer.
LEAST, QUESTION, ANSWER = 0.6, 0.6, 0.5
BLOCK = 4
#: Bounds of a shard of test items that is broadcast.
SHARD_ITEMS, SHARD_CHARS = 2000, 4 << 20
#: Bound of the first length class, in words; what bounds may lose by rounding.
CLASS, ROUNDING = 32, 1e-5
#: Tokens whose word a task remembers before it starts anew.
REMEMBERED = 300_000
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
MATCH = "array<struct<item_id:bigint,score:double,question:double,answer:double,start:int,end:int>>"
MATCH_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))


def _word(token: str) -> str:
    if token.isalnum():
        return token
    start, end = 0, len(token)
    while start < end and not token[start].isalnum():
        start += 1
    while end > start and not token[end - 1].isalnum():
        end -= 1
    return token[start:end]


def words_of(text: str | None) -> list[str]:
    """Words in order; a token of marks only is no word."""
    return [w for w in map(_word, (text or "").lower().split()) if w]


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for w in map(words_of, _SENTENCE.split(text)) if w]
    if len(parts) < 2:
        return (parts or [[]])[0], (parts or [[]])[0]
    return [w for part in parts[:-1] for w in part], parts[-1]


def grams(words: list) -> set[tuple]:
    n = min(3, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def length_class(words: int) -> int:
    """The least power of two that is no less, ``CLASS`` at least."""
    return max(CLASS, 1 << (words - 1).bit_length())


class Index:
    """Inverted index of items, by BM25 with weights of sum 1.

    ``whole`` are item count, mean length and items by word of the collection the items are part of, ``longest`` the
    bound of their length; both are taken from the items themselves where not given.
    """

    def __init__(self, items: list[tuple[int, str]], k1: float = K1, b: float = B, whole: tuple[int, float, dict[str, int]] | None = None, longest: int | None = None):
        found = [(item, text, words_of(text)) for item, text in items]
        # Items that share their rarest words, and so their language, come together: blocks have low bounds.
        common = Counter(w for _, _, words in found for w in set(words))
        found = sorted(((i, t, w) for i, t, w in found if w), key=lambda r: (max(set(r[2]), key=lambda w: (common[w], w)), len(r[2]), r[0]))
        self.items = [item for item, _, _ in found]
        self.parts = [tuple(map(grams, question_and_answer(text))) for _, text, _ in found]
        self.longest = longest or max((len(words) for _, _, words in found), default=0)
        count, mean, having = whole or (len(found), sum(len(w) for _, _, w in found) / max(len(found), 1), common)
        postings: dict[str, list[tuple[int, float]]] = {}
        for number, (_, _, words) in enumerate(found):
            weights = {}
            for word, n in Counter(words).items():
                idf = math.log(1 + (count - having[word] + 0.5) / (having[word] + 0.5))
                weights[word] = idf * n * (k1 + 1) / (n + k1 * (1 - b + b * len(words) / mean))
            whole = sum(weights.values())
            for word, weight in weights.items():
                postings.setdefault(word, []).append((number, weight / whole))
        self.terms = {word: i for i, word in enumerate(sorted(postings))}
        self.numbers = [[n for n, _ in postings[w]] for w in self.terms]
        self.weights = [[x for _, x in postings[w]] for w in self.terms]
        self.greatest = np.array([max(w) for w in self.weights], np.float64)
        # By term the greatest weight of each block that it has postings in.
        self.block_greatest: list[dict[int, float]] = []
        for numbers, weights in zip(self.numbers, self.weights, strict=True):
            blocks: dict[int, float] = {}
            for number, weight in zip(numbers, weights, strict=True):
                blocks[number // BLOCK] = max(blocks.get(number // BLOCK, 0.0), weight)
            self.block_greatest.append(blocks)

    def block_bounds(self) -> np.ndarray:
        """The greatest weights as a matrix (term, block), rounded up; made where an index is used, not sent."""
        made = np.zeros((len(self.terms), -(-max(len(self.items), 1) // BLOCK)), np.float32)
        for term, blocks in enumerate(self.block_greatest):
            made[term, list(blocks)] = list(blocks.values())
        return np.nextafter(made, np.float32(1), where=made > 0, out=made)

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """(number, score) of all items with ``least`` or more, by block-max WAND."""
        low = least * (1 - ROUNDING)
        cursors = [[self.numbers[t][0], 0, t] for t in terms]  # current number, place, term
        ended, out = len(self.items), []

        def advance(cursor, to):
            numbers, place = self.numbers[cursor[2]], cursor[1]
            while place < len(numbers) and numbers[place] < to:
                place += 1
            cursor[1] = place
            cursor[0] = numbers[place] if place < len(numbers) else ended

        while True:
            cursors = sorted(c for c in cursors if c[0] < ended)
            bound, pivot = 0.0, None
            for i, cursor in enumerate(cursors):
                bound += self.greatest[cursor[2]]
                if bound >= low:
                    pivot = i
                    break
            if pivot is None:
                return out
            number = cursors[pivot][0]
            block = number // BLOCK
            ahead = [c for c in cursors if c[0] <= number]
            if sum(self.block_greatest[c[2]].get(block, 0.0) for c in cursors if c[0] < (block + 1) * BLOCK) < low:
                # No item of this block reaches the threshold.
                for cursor in cursors:
                    if cursor[0] < (block + 1) * BLOCK:
                        advance(cursor, (block + 1) * BLOCK)
            elif cursors[0][0] == number:
                score = math.fsum(self.weights[c[2]][c[1]] for c in ahead)
                if score >= least:
                    out.append((number, score))
                for cursor in ahead:
                    advance(cursor, number + 1)
            else:
                for cursor in ahead:
                    advance(cursor, number)


class Shard:
    """Indexes of a shard's items, one for each length class, under common terms."""

    def __init__(self, items: list[tuple[int, str]], whole: tuple[int, float, dict[str, int]]):
        classes: dict[int, list[tuple[int, str]]] = {}
        for item, text in items:
            classes.setdefault(length_class(len(words_of(text))), []).append((item, text))
        self.indexes = [Index(sorted(classes[longest]), whole=whole, longest=longest) for longest in sorted(classes)]
        self.terms = {word: i for i, word in enumerate(sorted({w for index in self.indexes for w in index.terms}))}
        # Term of each index; the last place is that of words without a term.
        self.own = [np.array([*(index.terms.get(w, -1) for w in self.terms), -1], np.int32) for index in self.indexes]


class ShardSearcher:
    """Finds the items of a shard in texts."""

    def __init__(self, shard: Shard, least: float, question: float, answer: float):
        self.shard = shard
        self.searchers = [Searcher(index, least, question, answer) for index in shard.indexes]
        self.known: dict[str, int] = {}

    def _terms(self, tokens: list[str]) -> np.ndarray:
        """Term of each token: -1 for other words, -2 for no word."""
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for token in set(tokens).difference(known):
                word = _word(token)
                known[token] = self.shard.terms.get(word, -1) if word else -2
            return np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))

    def search(self, text: str | None) -> list[dict]:
        """The best verified passage for each item found in the text."""
        if not text or not self.searchers:
            return []
        tokens = text.lower().split()
        terms = self._terms(tokens)
        is_word = terms > -2
        terms = terms[is_word]
        if not (terms >= 0).any():
            return []
        kept: list[list[str]] = []

        def words() -> list[str]:
            if not kept:
                kept.append([_word(t) for t, w in zip(tokens, is_word.tolist(), strict=True) if w])
            return kept[0]

        return [one for searcher, own in zip(self.searchers, self.shard.own, strict=True) for one in searcher.search(own[terms], words)]


class Searcher:
    """Finds the items of an index in texts."""

    def __init__(self, index: Index, least: float, question: float, answer: float):
        self.index, self.least, self.question, self.answer = index, least, question, answer
        # An item of up to half a passage stands whole in one of them.
        self.size = max(2 * CLASS, 2 * index.longest)
        self.step = self.size // 2
        self.bounds = index.block_bounds()

    def search(self, terms: np.ndarray, words_of_text: Callable[[], list[str]]) -> list[dict]:
        """The best verified passage for each item found: ``terms`` of all words in order, -1 for words without one."""
        index, low = self.index, self.least * (1 - ROUNDING)
        at = np.flatnonzero(terms >= 0)
        if not len(at):
            return []
        # A word lies in the passage that begins in its step and in the one before.
        steps = at // self.step
        last = max(0, -(-(len(terms) - self.size) // self.step))
        pairs = np.concatenate([np.minimum(steps, last), np.clip(steps - 1, 0, last)]).astype(np.int64) << 32
        pairs = np.unique(pairs | np.concatenate([terms[at], terms[at]]))
        passage, term = pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.int64)
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
        whole = np.add.reduceat(index.greatest[term], starts)
        best = {}
        for i in np.flatnonzero(whole >= low).tolist():
            own = term[starts[i] : starts[i + 1] if i + 1 < len(starts) else len(term)]
            if self.bounds[own].sum(0).max() < low:
                continue
            hits = index.search(own.tolist(), self.least)
            if not hits:
                continue
            words = words_of_text()
            start = int(passage[starts[i]]) * self.step
            here = grams(words[start : start + self.size]) | {(w,) for w in words[start : start + self.size]}
            here |= set(zip(words[start : start + self.size], words[start + 1 : start + self.size], strict=False))
            for number, score in hits:
                question, answer = (len(g & here) / len(g) for g in index.parts[number])
                if question >= self.question and answer >= self.answer and (number not in best or best[number]["score"] < score):
                    end = min(start + self.size, len(words))
                    best[number] = {"item_id": index.items[number], "score": score, "question": question, "answer": answer, "start": start, "end": end}
        return [best[n] for n in sorted(best, key=lambda n: (index.items[n], n))]


def _with_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words = [words_of(text) for text in batch.column(1).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array(map(len, words), pa.int64()), pa.array([sorted(set(w)) for w in words], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "text", "n", "words"])


def shards_of(items: DataFrame, scratch: Scratch) -> Iterator[bytes]:
    """Pickled shards, each of bounded size, of all items with a word; counts are taken over all of them."""
    items = items.where("text IS NOT NULL AND item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = scratch.save(items.mapInArrow(_with_words, "item_id long, text string, n long, words array<string>").where("n > 0"), "items")
    n, total, chars = items.agg(F.count("*"), F.sum("n"), F.sum(F.length("text"))).first()
    if not n:
        return
    count, mean = max(-(-n // SHARD_ITEMS), -(-chars // SHARD_CHARS)), total / n
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)).cast("int"))
    terms = items.select("shard", F.explode("words").alias("word"))
    having = terms.groupBy("word").agg(F.count("*").alias("having"))
    own = scratch.save(terms.distinct().join(having, "word").select("shard", "word", "having"), "terms")

    def build(part: pa.Table, values: pa.Table) -> pa.Table:
        rows = zip(part["item_id"].to_pylist(), part["text"].to_pylist(), strict=True)
        whole = n, mean, dict(zip(values["word"].to_pylist(), values["having"].to_pylist(), strict=True))
        return pa.table({"shard": part["shard"].slice(0, 1), "body": pa.array([pickle.dumps(Shard(list(rows), whole))], pa.binary())})

    built = items.select("shard", "item_id", "text").groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(build, "shard int, body binary")
    built = scratch.save(built, "shards")
    for shard in range(count):
        for row in built.where(F.col("shard") == shard).collect():  # one at most, bounded
            yield bytes(row["body"])


def matched(docs: DataFrame, items: DataFrame, text: str = "text", matches: str = "matches", least: float = LEAST, question: float = QUESTION, answer: float = ANSWER) -> DataFrame:
    """All columns of ``docs`` and ``matches``: an entry for each item found, of the passage that covers it best.

    ``start`` and ``end`` are the passage's place in words. Items without an id are left out.
    """
    refuse(docs.columns, matches)
    scratch, context = Scratch(docs.sparkSession), docs.sparkSession.sparkContext
    shards = [context.broadcast(shard) for shard in shards_of(items, scratch)]
    scratch.drop_all()
    limits = least, question, answer

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher, order = None, list(range(len(shards)))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for number in order:
                if searcher is None or searcher[0] != number:
                    searcher = None  # the one before goes before the next one comes
                    searcher = number, ShardSearcher(pickle.loads(shards[number].value), *limits)
                    vars(shards[number]).pop("_value", None)  # a broadcast keeps what it has read
                for row, own in enumerate(found):
                    own += searcher[1].search(texts[row].as_py())
            order.reverse()  # the last shard of a batch is the first of the next
            made = pa.array([sorted(own, key=lambda m: tuple(m.values())) for own in found], MATCH_ARROW)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, matches])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(matches, T._parse_datatype_string(MATCH))]))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question, answer, start, end) of each item found in each document."""
    found = matched(docs.select("doc_id", "text"), items).where(F.size("matches") > 0)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
