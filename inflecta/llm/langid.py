"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Character n-grams (1 to 3, lower case, whole text) are hashed to ``FEATURES`` columns; a document's vector is
log(1 + count) * idf, of length 1. Document frequencies come from every training row, one partial count for each
task. The weights are sparse: follow-the-regularised-leader with an elastic net, online over a sample of at most
``PER_LANGUAGE`` rows of each language (a stated bound; the same rows in every run), of which a held-back fifth
sets the temperature that divides the logits.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0; without training rows every text is;
repeated rows are predicted each; ties of logits go to the language that sorts first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inflecta.llm.common import fold_of, refuse, sample_of_classes, slices

FEATURES = 1 << 15
ORDERS = 3
PER_LANGUAGE = 1500
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - 15)
#: Characters hashed at a time; counts add up over the whole text.
PIECE = 1 << 18


def gram_counts(text: str) -> np.ndarray:
    """Count of each hashed n-gram of the whole text."""
    counts = np.zeros(FEATURES, np.int64)
    text = " " + text.lower() + " "
    for start in range(0, len(text), PIECE):
        # The next piece's first characters end the n-grams that begin here.
        piece = text[start : start + PIECE + ORDERS - 1]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        own = np.zeros(len(codes), np.uint64)
        for k in range(ORDERS):
            n = min(PIECE, len(codes) - k)
            if n <= 0:
                break
            own = own[:n] * np.uint64(0x100000001B3) + codes[k : k + n]
            counts += np.bincount(((own + np.uint64(k)) * _MIX >> _SHIFT).astype(np.int64), minlength=FEATURES)
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Model:
    """Languages, idf, weights (language x feature), bias and temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0):
        self.languages, self.idf, self.weights, self.bias, self.temperature = languages, idf, weights, bias, temperature

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        counts = gram_counts(text)
        at = np.flatnonzero(counts)
        values = np.log1p(counts[at]) * self.idf[at]
        return at, values / max(np.linalg.norm(values), 1e-12)

    def logits(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return self.weights[:, at] @ values + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return "und", 0.0
        p = softmax(self.logits(*self.vector(text)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def document_frequencies(rows: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Number of rows with a text, and for each hashed n-gram the rows that have it; over all rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found = 0, np.zeros(FEATURES, np.int64)
        for batch in slices(batches, text):
            for one in batch.column(batch.schema.get_field_index(text)).to_pylist():
                if one:
                    total += 1
                    found += gram_counts(one) > 0
        there = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([*there, -1], pa.int32()), pa.array([*found[there], total], pa.int64())], names=["gram", "n"])

    sums = rows.select(text).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()  # FEATURES rows at most
    counts = np.zeros(FEATURES + 1, np.int64)  # the last place: gram -1
    counts[sums["gram"].to_numpy()] = sums["n"].to_numpy()
    return int(counts[-1]), counts[:-1]


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, rate: float = 2.0, l1: float = 0.02, l2: float = 0.01, rounds: int = 2, seed: int = 1
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal with l1 and l2 penalties; the bias is not penalised by l1."""
    z, n = np.zeros((classes, FEATURES + 1)), np.zeros((classes, FEATURES + 1))
    lasso = np.full(FEATURES + 1, l1)
    lasso[-1] = 0

    def weights(at):
        zs = z[:, at]
        return np.where(np.abs(zs) > lasso[at], -(zs - np.sign(zs) * lasso[at]) / ((1 + np.sqrt(n[:, at])) / rate + l2), 0.0)

    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            at, x = np.append(rows[i][0], FEATURES), np.append(rows[i][1], 1.0)
            w = weights(at)
            error = softmax(w @ x)
            error[labels[i]] -= 1
            slope = error[:, None] * x
            grown = n[:, at] + slope * slope
            z[:, at] += slope - (np.sqrt(grown) - np.sqrt(n[:, at])) / rate * w
            n[:, at] = grown
    w = weights(np.arange(FEATURES + 1))
    return w[:, :-1], w[:, -1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()) + 1e-4 * log_t * log_t

    low, high, g = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(rows: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """A model from rows (doc_id, text, lang); rows without a language or a letter teach nothing."""
    rows = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select("doc_id", text, lang)
    total, found = document_frequencies(rows, text)
    idf = np.log((1 + total) / (1 + found)) + 1
    none = Model([], idf, np.zeros((0, FEATURES)), np.zeros(0))
    sample = _vectors(sample_of_classes(rows, lang, per_language), none, text, lang).toPandas()
    languages = sorted(set(sample["lang"]))
    if not languages:
        return none
    sample = sample.assign(key=[zlib.crc32(str(i).encode()) for i in sample["doc_id"]]).sort_values(["key", "doc_id"])
    labels = np.array([languages.index(x) for x in sample["lang"]])
    vectors = [(np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(v, np.float32).astype(float)) for a, v in zip(sample["grams"], sample["weights"], strict=True)]
    held = np.arange(len(labels)) % 5 == 4
    used, kept = np.flatnonzero(~held), np.flatnonzero(held)
    weights, bias = follow_the_leader([vectors[i] for i in used], labels[used], len(languages))
    model = Model(languages, idf, weights, bias)
    if len(kept):
        model.temperature = fit_temperature(np.array([model.logits(*vectors[i]) for i in kept]), labels[kept])
    return model


def _vectors(rows: DataFrame, model: Model, text: str, lang: str) -> DataFrame:
    """(doc_id, lang, grams, weights) of rows with a letter; the vectors as int32 and float32 bytes."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            out = {"doc_id": [], "lang": [], "grams": [], "weights": []}
            for doc_id, one, label in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", text, lang)), strict=True):
                if has_letter(one):
                    at, values = shared.value.vector(one)
                    for name, value in zip(out, (doc_id, label, at.astype(np.int32).tobytes(), values.astype(np.float32).tobytes()), strict=True):
                        out[name].append(value)
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, lang string, grams binary, weights binary")


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs``, ``lang_pred`` and ``score``."""
    refuse(docs.columns, "lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, text):
            found = [own.predict(one) for one in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double")


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row; learned from rows outside the held-out fold (remainder 1)."""
    model = train(docs.where(fold_of("doc_id", 3) != 1))
    return identified(docs.select("doc_id", "text"), model).select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
