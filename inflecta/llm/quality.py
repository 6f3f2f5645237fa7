"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams (1 to 3) over the *forms* of a text's words: letter case, marks around and
inside, kind of characters, length, and whether a word repeats the one before or closes a pair met before. Forms
occur in any language, so what is learned does not hang on a vocabulary. Since long texts contain nearly every
n-gram once, an n-gram has one indicator for each share of the text that it reaches (``SHARES``). Words themselves
are a further kind of unigram. Indicators are hashed to ``FEATURES`` columns.

The model is fitted on a sample of at most ``PER_CLASS`` labelled rows of each class (a stated bound; the same rows
in every run): indicators are scaled by the log ratio of class frequencies, a linear hinge-loss model is fitted by
dual coordinate descent, and a held-back fifth calibrates margins to probabilities under the true class shares.
Every text is scored whole.

Defined results: NULL and empty texts have the single indicator "empty" and get the score that the model gives it;
without labelled rows of both classes every score is the share of label 1, or 0.5 without any; repeated rows are
scored each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inflecta.llm.common import class_sizes, fold_of, labelled_sample, refuse, slices

FEATURES = 1 << 16
SHARES = (0.0, 0.02, 0.1, 0.3, 0.6)
PER_CLASS = 4000
#: Words whose form a task remembers before it starts anew.
REMEMBERED = 400_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RUNS = re.compile(r"(.)\1+")
#: Words of a text that are worked on at a time; shares are taken over the whole text.
PIECE = 1 << 20


def _form(word: str) -> int:
    """A small code of what a word looks like."""
    letters = word.strip("".join(c for c in set(word) if not c.isalnum()))
    marks = word.replace(letters, "_", 1) if letters else word
    marks = _RUNS.sub(r"\1\1", marks)[:6]
    if not letters:
        case = "none"
    elif letters.isdigit():
        case = "digits"
    elif letters.isalpha():
        case = "single" if len(letters) == 1 else "upper" if letters.isupper() else "lower" if letters.islower() else "title" if letters.istitle() else "mixed"
    else:
        case = "other"
    size = min(len(letters) // 8, 3)
    return zlib.crc32(f"{case} {marks} {size}".encode()) & 0xFFFFFF


class Indicators:
    """Distinct feature numbers of a text."""

    def __init__(self):
        self.forms: dict[str, int] = {}

    def _codes(self, words: list[str]) -> np.ndarray:
        forms = self.forms
        try:
            return np.fromiter(map(forms.__getitem__, words), np.int64, len(words))
        except KeyError:
            if len(forms) > REMEMBERED:
                forms.clear()
            for word in set(words).difference(forms):
                forms[word] = _form(word) << 32 | zlib.crc32(word.lower().encode())
            return np.fromiter(map(forms.__getitem__, words), np.int64, len(words))

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        if not words:
            return np.array([0], np.int32)
        code = self._codes(words)
        n = len(words)
        lexical = (code & 0xFFFFFFFF).astype(np.uint64)
        same = np.zeros(n, np.uint64)
        same[1:] = np.fromiter(map(eq, words[1:], words), bool, n - 1)
        pairs = (lexical[1:] * _MIX) ^ lexical[:-1]
        order = np.argsort(pairs, kind="stable")
        met = np.zeros(n, bool)
        met[1:][order[1:]] = pairs[order[1:]] == pairs[order[:-1]]
        form = (code >> 32).astype(np.uint64) << np.uint64(2) | same << np.uint64(1) | met.astype(np.uint64)
        grams, own = [], np.zeros(n, np.uint64)
        for k in range(1, 4):
            if n >= k:
                own = (own[: n - k + 1] + form[k - 1 :]) * _MIX
                own ^= own >> np.uint64(31)
                grams.append(own + np.uint64(k))
        every, counts = np.unique(np.concatenate(grams), return_counts=True)
        found = [np.unique(lexical) * _MIX + np.uint64(77)]
        share = counts / n
        for i, least in enumerate(SHARES):
            found.append((every[share > least] ^ np.uint64(i + 1)) * _MIX)
        found = np.concatenate(found)
        return np.unique((found >> np.uint64(64 - 16)).astype(np.int32) % FEATURES)


def log_ratio(counts: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    p, q = counts[1] + smooth, counts[0] + smooth
    return np.log(p / p.sum()) - np.log(q / q.sum())


def hinge_by_dual_descent(rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray, cost: np.ndarray, rounds: int = 20, seed: int = 1) -> np.ndarray:
    """Weights w (last: bias) of min |w|^2/2 + sum cost_i max(0, 1 - y_i w x_i), x the scaled indicators."""
    w, alpha, order = np.zeros(len(scale) + 1), np.zeros(len(rows)), np.random.default_rng(seed)
    values = [np.append(scale[r], 1.0) for r in rows]
    places = [np.append(r, len(scale)) for r in rows]
    norms = [float(v @ v) for v in values]
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(rows)):
            at, x, y = places[i], values[i], signs[i]
            slope = y * float(w[at] @ x) - 1
            aim = min(max(alpha[i] - slope / norms[i], 0.0), cost[i])
            if aim != alpha[i]:
                worst = max(worst, abs(aim - alpha[i]) * norms[i])
                w[at] += (aim - alpha[i]) * y * x
                alpha[i] = aim
        if worst < 0.01:
            break
    return w


def calibrate(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-(a * margin + b))) by weighted Newton steps with smoothed targets."""
    n1, n0 = weights[labels == 1].sum(), weights[labels == 0].sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, at = np.column_stack([margins, np.ones(len(margins))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weights * (p - target)) + 1e-3 * at
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


class Model:
    """Scores indicators; ``constant`` where nothing could be learned."""

    def __init__(self, weights: np.ndarray | None, a: float, b: float, constant: float = 0.5):
        self.weights, self.a, self.b, self.constant = weights, a, b, constant

    def score(self, features: np.ndarray) -> float:
        if self.weights is None:
            return self.constant
        margin = self.weights[features].sum() + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(self.a * margin + self.b, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, label: str, text: str = "text", per_class: int = PER_CLASS, cost: float = 0.1) -> Model:
    """A model of ``label`` (0 or 1) in ``labels`` (doc_id, label), outside the held-out fold; other values teach nothing."""
    totals = np.array(class_sizes(labels, label), float)
    if not totals.all():
        return Model(None, 0, 0, float(totals[1] / totals.sum()) if totals.sum() else 0.5)
    sample = featured(labelled_sample(docs, labels, label, per_class, text=text), text).select("doc_id", label, "features").toPandas()
    sample = sample.assign(key=[zlib.crc32(str(i).encode()) for i in sample["doc_id"]]).sort_values(["key", "doc_id"])
    y, features = sample[label].to_numpy(int), [np.asarray(f, np.int64) for f in sample["features"]]
    if len(set(y)) < 2:  # labels of documents that are not there
        return Model(None, 0, 0, float(totals[1] / totals.sum()))
    counts = np.zeros((2, FEATURES))
    for own, one in zip(features, y, strict=True):
        counts[one, own] += 1
    return fit(features, y, totals, counts, cost)


def fit(features: list[np.ndarray], labels: np.ndarray, totals: np.ndarray, counts: np.ndarray, cost: float = 0.1) -> Model:
    ratio = log_ratio(counts)
    held = np.arange(len(labels)) % 5 == 4
    if len(set(labels[held])) < 2 or len(set(labels[~held])) < 2:
        held = np.zeros(len(labels), bool)
    # Each class weighs what its share of all rows is.
    weight = (totals / totals.sum() / np.maximum(np.bincount(labels, minlength=2) / len(labels), 1e-9))[labels]
    at = np.flatnonzero(~held)
    w = hinge_by_dual_descent([features[i] for i in at], np.where(labels[at] == 1, 1.0, -1.0), ratio, cost * weight[at])
    scaled = np.append(w[:-1] * ratio, w[-1])
    used = np.flatnonzero(held) if held.any() else at
    margins = np.array([scaled[features[i]].sum() + scaled[-1] for i in used])
    a, b = calibrate(margins, labels[used], weight[used])
    return Model(scaled, a, b)


def featured(rows: DataFrame, text: str) -> DataFrame:
    """All columns but the text, and ``features``."""
    kept = [c for c in rows.columns if c != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in slices(batches, text):
            own = [indicators.of(one) for one in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(own, pa.list_(pa.int32()))], names=[*kept, "features"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text)
    return rows.mapInArrow(run, f"{schema}, features array<int>")


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``score``, the probability of label 1; a clash of that name, in any case, is refused."""
    refuse(docs.columns, score)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators, own = Indicators(), shared.value
        for batch in slices(batches, text):
            values = [own.score(indicators.of(one)) for one in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, score])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{score}` double")


def predictions(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (fold_of("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )
