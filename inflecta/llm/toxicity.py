"""Toxicity: a bidirectional gated recurrent network with attention pooling over characters and words, in numpy.

A word's vector joins a hashed word embedding with what the same kind of network (bidirectional GRU and attention)
makes of its characters, so unseen words are judged by how they are built. A second one reads the words, and its
attention pools their states over every window of ``WINDOW`` words, one for each start; a document's score is that
of its highest window, calibrated over whole documents. The reading that gives a word its state starts a half
window before the half window that the word stands in (counted from the start of the text), in both directions:
a state depends on 8 to 15 words on each side, as far as the text goes, whatever windows it is pooled in. A text of
``WINDOW`` words or fewer is one window, read from end to end.

Labels mark documents, not windows. The model is fitted on bounded samples of labelled rows, the same in every run:
over ``COUNTED`` rows of each class, counts of words and of their character pieces tell which windows of a toxic
document are likely the reason; ``PER_CLASS`` of them give a few windows each for training (of those that overlap by half): the
likeliest, and for clean documents also some by hash. In training the window of a toxic document that the
model itself finds highest counts. A fixed fold of the labelled documents never trains and only calibrates, at every
size, at most ``PER_CLASS`` of each class; without both classes in it the logit stays as it is. Calibration and
scoring cover every window of every text.

Defined results: NULL, empty and word-less texts have one empty window and get the score of that; without labelled
rows of both classes every score is the share of label 1, or 0 without any; repeated rows are scored each. A very long text
is read whole, in blocks of windows; two numbers a word are held. A clash with an output name, in any case, is refused.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inflecta.llm.common import class_sizes, fold_of, labelled_sample, refuse, slices
from inflecta.llm.quality import calibrate

WINDOW, HALF = 16, 8
#: Longest run of word characters read as one word; a longer one is read as several.
LONGEST = 24
CHARS, CHAR_SIZE, CHAR_HIDDEN = 128, 8, 8
WORDS, WORD_SIZE, HIDDEN, ATTENTION = 1 << 13, 8, 8, 8
PER_CLASS, COUNTED = 1000, 5000
#: Cells of the class counts that point to likely windows.
CELLS = 1 << 18
#: Words a task remembers, and windows it runs at a time.
REMEMBERED, RUN = 200_000, 2048
_words = re.compile(rf"\w{{1,{LONGEST}}}").findall


def words_of(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def windows_of(n: int) -> list[tuple[int, int]]:
    """Start and end of the windows over ``n`` words that training chooses from; one empty window where there is none."""
    if n <= WINDOW:
        return [(0, n)]
    starts = [*range(0, n - WINDOW, HALF), n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Reader:
    """Bidirectional GRU with attention pooling: (batch, time, size) to (batch, 2 * hidden)."""

    def __init__(self, name: str, size: int, hidden: int, params: dict[str, np.ndarray], rng: np.random.Generator):
        self.name, self.hidden, self.params = name, hidden, params
        shapes = {"W": (size, 6 * hidden), "b": (6 * hidden,), "U": (2, hidden, 3 * hidden), "A": (2 * hidden, ATTENTION), "c": (ATTENTION,), "v": (ATTENTION,)}
        for key, shape in shapes.items():
            scale = 0.0 if key in "bc" else (1.0 / shape[-2 if len(shape) > 1 else 0]) ** 0.5
            params[f"{name}.{key}"] = (rng.standard_normal(shape) * scale).astype(np.float32)

    def inputs(self, x: np.ndarray) -> np.ndarray:
        """What each element adds to the gates of both directions."""
        return x @ self.params[f"{self.name}.W"] + self.params[f"{self.name}.b"]

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """``gates`` (batch, time, 6 * hidden) from ``inputs``; ``mask`` (batch, time) 1.0 where there is an element."""
        n, time, _ = gates.shape
        h_size = self.hidden
        U = self.params[f"{self.name}.U"]
        both = gates.reshape(n, time, 2, 3 * h_size).transpose(1, 2, 0, 3)
        h = np.zeros((2, n, h_size), np.float32)
        states = np.empty((time, 2, n, h_size), np.float32)
        steps = []
        for s in range(time):
            m = np.stack([mask[:, s], mask[:, time - 1 - s]])[..., None]
            x = np.stack([both[s, 0], both[time - 1 - s, 1]])
            g = h @ U
            zr = _sigmoid(x[..., : 2 * h_size] + g[..., : 2 * h_size])
            z, r = zr[..., :h_size], zr[..., h_size:]
            c = np.tanh(x[..., 2 * h_size :] + r * g[..., 2 * h_size :])
            new = h + m * (1 - z) * (c - h)
            if keep:
                steps.append((h, m, z, r, c, g[..., 2 * h_size :]))
            states[s, 0], states[time - 1 - s, 1] = new[0], new[1]
            h = new
        outs = states.transpose(2, 0, 1, 3).reshape(n, time, 2 * h_size)
        A, c0, v = (self.params[f"{self.name}.{k}"] for k in "Acv")
        u = np.tanh(outs @ A + c0)
        score = u @ v + (mask - 1) * 1e4
        score = np.exp(score - score.max(1, keepdims=True)) * np.maximum(mask, 1e-9)
        share = score / score.sum(1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", share, outs)
        return (pooled, (steps, outs, u, share)) if keep else pooled

    def around(self, known: np.ndarray, halves: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """States (n, HALF, 2 * hidden) of elements given as rows of ``known`` gates, 0 where there is none.

        Read forward from the start of ``before``, backward from the end of ``after``.
        """
        size = self.hidden
        U = self.params[f"{self.name}.U"]
        gates = known[:, : 3 * size], known[:, 3 * size :]
        orders = np.concatenate([before, halves], 1), np.concatenate([halves, after], 1)[:, ::-1]
        h = np.zeros((2, len(halves), size), np.float32)
        states = np.empty((len(halves), HALF, 2, size), np.float32)
        for s in range(WINDOW):
            at = orders[0][:, s], orders[1][:, s]
            x = np.stack([gates[0][at[0]], gates[1][at[1]]])
            m = np.stack([at[0] > 0, at[1] > 0]).astype(np.float32)[..., None]
            g = h @ U
            zr = _sigmoid(x[..., : 2 * size] + g[..., : 2 * size])
            c = np.tanh(x[..., 2 * size :] + zr[..., size:] * g[..., 2 * size :])
            h = h + m * (1 - zr[..., :size]) * (c - h)
            if s >= HALF:
                states[:, s - HALF, 0], states[:, WINDOW - 1 - s, 1] = h[0], h[1]
        return states.reshape(len(halves), HALF, 2 * size)

    def backward(self, d: np.ndarray, x: np.ndarray, kept, grads: dict[str, np.ndarray]) -> np.ndarray:
        """Gradient of the elements ``x`` from that of the pooled output; adds those of the parameters."""
        steps, outs, u, share = kept
        p, name, size = self.params, self.name, self.hidden
        n, time, _ = outs.shape
        d_outs = share[..., None] * d[:, None]
        d_share = np.einsum("nth,nh->nt", outs, d)
        d_score = share * (d_share - (share * d_share).sum(1, keepdims=True))
        d_u = d_score[..., None] * p[f"{name}.v"] * (1 - u * u)
        grads[f"{name}.v"] += np.einsum("nt,nta->a", d_score, u)
        grads[f"{name}.c"] += d_u.sum((0, 1))
        grads[f"{name}.A"] += np.einsum("nth,nta->ha", outs, d_u)
        d_outs += d_u @ p[f"{name}.A"].T
        d_states = d_outs.reshape(n, time, 2, size).transpose(1, 2, 0, 3)
        d_gates = np.zeros((time, 2, n, 3 * size), np.float32)
        dh, Ut = np.zeros((2, n, size), np.float32), p[f"{name}.U"].transpose(0, 2, 1)
        for s in range(time - 1, -1, -1):
            h, m, z, r, c, gc = steps[s]
            dh = dh + np.stack([d_states[s, 0], d_states[time - 1 - s, 1]])
            dc = dh * m * (1 - z) * (1 - c * c)
            dz = dh * m * (h - c) * z * (1 - z)
            dr = dc * gc * r * (1 - r)
            d_in = np.concatenate([dz, dr, dc], -1)
            d_rec = np.concatenate([dz, dr, dc * r], -1)
            grads[f"{name}.U"] += h.transpose(0, 2, 1) @ d_rec
            dh = dh * (1 - m * (1 - z)) + d_rec @ Ut
            d_gates[s, 0], d_gates[time - 1 - s, 1] = d_in[0], d_in[1]
        flat = d_gates.transpose(2, 0, 1, 3).reshape(n, time, 6 * size)
        grads[f"{name}.W"] += np.einsum("ntd,ntg->dg", x, flat, optimize=True)
        grads[f"{name}.b"] += flat.sum((0, 1))
        return flat @ p[f"{name}.W"].T


class Network:
    """Logits of windows of words."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.params: dict[str, np.ndarray] = {
            "chars": (rng.standard_normal((CHARS, CHAR_SIZE)) * 0.3).astype(np.float32),
            "words": (rng.standard_normal((WORDS, WORD_SIZE)) * 0.1).astype(np.float32),
            "out": (rng.standard_normal(2 * HIDDEN + 1) * 0.3).astype(np.float32),
        }
        self.chars = Reader("c", CHAR_SIZE, CHAR_HIDDEN, self.params, rng)
        self.words = Reader("w", 2 * CHAR_HIDDEN + WORD_SIZE, HIDDEN, self.params, rng)
        self.a, self.b = 1.0, 0.0  # calibration of a document's highest logit

    @staticmethod
    def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Characters (n, longest), their mask, and the embedding row of each word."""
        longest = max(map(len, words), default=1)
        chars = np.zeros((len(words), longest), np.int64)
        mask = np.zeros((len(words), longest), np.float32)
        for i, word in enumerate(words):
            codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
            chars[i, : len(codes)] = codes % CHARS
            mask[i, : len(codes)] = 1
        rows = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORDS for w in words), np.int64, len(words))
        return chars, mask, rows

    def word_gates(self, words: list[str]) -> np.ndarray:
        """What each word adds to the gates of the window reader; words of like length together."""
        gates = np.empty((len(words), 6 * HIDDEN), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for start in range(0, len(order), RUN):
            part = order[start : start + RUN]
            chars, mask, rows = self.codes([words[i] for i in part])
            # Each character's part of the gates depends on the character alone.
            made = self.chars.forward(self.chars.inputs(self.params["chars"])[chars], mask)
            gates[part] = self.words.inputs(np.concatenate([made, self.params["words"][rows]], 1))
        return gates

    def logits(self, gates: np.ndarray, mask: np.ndarray) -> np.ndarray:
        out = self.params["out"]
        return self.words.forward(gates, mask) @ out[:-1] + out[-1]

    def weighed(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each state in attention, and what it adds to a logit."""
        A, c, v = (self.params[f"w.{k}"] for k in "Acv")
        return np.exp((np.tanh(states @ A + c) @ v).astype(np.float64)), (states @ self.params["out"][:-1]).astype(np.float64)

    def step(self, windows: list[list[str]], labels: np.ndarray, weights: np.ndarray, drop: np.random.Generator) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of one batch; the word embedding of half the words is hidden."""
        p = self.params
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        vocabulary = sorted({w for window in windows for w in window}) or [""]
        place = {w: i for i, w in enumerate(vocabulary)}
        chars, char_mask, rows = self.codes(vocabulary)
        x = p["chars"][chars]
        made, kept_chars = self.chars.forward(self.chars.inputs(x), char_mask, keep=True)
        shown = (drop.random(len(vocabulary)) < 0.5).astype(np.float32)[:, None]
        vectors = np.concatenate([made, p["words"][rows] * shown], 1)
        at = np.zeros((len(windows), WINDOW), np.int64)
        mask = np.zeros((len(windows), WINDOW), np.float32)
        for i, window in enumerate(windows):
            at[i, : len(window)] = [place[w] for w in window]
            mask[i, : len(window)] = 1
        inputs = vectors[at]
        pooled, kept = self.words.forward(self.words.inputs(inputs), mask, keep=True)
        logit = pooled @ p["out"][:-1] + p["out"][-1]
        prob = _sigmoid(logit)
        loss = float(-(weights * np.where(labels == 1, np.log(prob + 1e-7), np.log(1 - prob + 1e-7))).mean())
        d = (weights * (prob - labels) / len(labels)).astype(np.float32)
        grads["out"][:-1], grads["out"][-1] = pooled.T @ d, d.sum()
        d_inputs = self.words.backward(d[:, None] * p["out"][:-1], inputs, kept, grads) * mask[..., None]
        d_vectors = np.zeros_like(vectors)
        np.add.at(d_vectors, at.ravel(), d_inputs.reshape(-1, vectors.shape[1]))
        size = made.shape[1]
        np.add.at(grads["words"], rows, d_vectors[:, size:] * shown)
        d_chars = self.chars.backward(d_vectors[:, :size], x, kept_chars, grads) * char_mask[..., None]
        np.add.at(grads["chars"], chars.ravel(), d_chars.reshape(-1, CHAR_SIZE))
        return loss, grads


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m, self.v = ({k: np.zeros_like(p) for k, p in params.items()} for _ in range(2))

    def apply(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        size = sum(float((g * g).sum()) for g in grads.values()) ** 0.5
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (size + 1e-9))
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-7)


def fit_windows(
    bags: list[tuple[int, list[list[str]]]], rounds: int = 8, hard: int = 3, easy: int = 1, batch: int = 64, rate: float = 0.01, seed: int = 3
) -> Network:
    """A network from bags (label, windows).

    Of a bag of label 1 the window that the network finds highest counts (at first the likeliest, which comes first),
    of label 0 the ``hard`` highest and ``easy`` others.
    """
    network, rng = Network(), np.random.default_rng(seed)
    adam = Adam(network.params, rate)
    for number in range(rounds):
        adam.rate = rate * (1 - number / (rounds + 1))
        chosen: list[tuple[list[str], int]] = []
        flat = Scorer(network).window_logits([w for _, windows in bags for w in windows]) if number else None
        at = 0
        for label, windows in bags:
            heights = -np.arange(len(windows)) if flat is None else flat[at : at + len(windows)]
            at += len(windows)
            order = np.argsort(-heights, kind="stable")
            picked = order[:1] if label else [*order[:hard], *rng.permutation(order[hard:])[:easy]]
            chosen += [(windows[int(i)], label) for i in picked]
        labels = np.array([y for _, y in chosen], np.float32)
        share = min(max(float(labels.mean()), 1e-6), 1 - 1e-6)
        weights = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        order = rng.permutation(len(chosen))
        for start in range(0, len(order), batch):
            part = order[start : start + batch]
            _, grads = network.step([chosen[i][0] for i in part], labels[part], weights[part], rng)
            adam.apply(grads)
    return network


class Scorer:
    """Highest window logits of texts, remembering the gates of words."""

    def __init__(self, network: Network):
        self.network, self.known, self.gates = network, {}, np.zeros((1, 6 * HIDDEN), np.float32)  # row 0: no word

    def _rows(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = list(set(words).difference(known))
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                self.gates = self.gates[:1]
                new = list(set(words))
            new.sort()
            known.update(zip(new, range(len(self.gates), len(self.gates) + len(new)), strict=True))
            self.gates = np.concatenate([self.gates, self.network.word_gates(new)])
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _run(self, rows: np.ndarray) -> np.ndarray:
        """Logits of windows given as rows of gates, 0 where there is no word."""
        parts = [rows[i : i + RUN] for i in range(0, len(rows), RUN)]
        return np.concatenate([self.network.logits(self.gates[p], (p > 0).astype(np.float32)) for p in parts])

    def window_logits(self, windows: list[list[str]]) -> np.ndarray:
        rows = np.zeros((len(windows), WINDOW), np.int64)
        flat = self._rows([w for window in windows for w in window])
        at = 0
        for i, window in enumerate(windows):
            rows[i, : len(window)] = flat[at : at + len(window)]
            at += len(window)
        return self._run(rows)

    def highest(self, texts: list[str | None]) -> np.ndarray:
        """The highest logit over all windows of each text."""
        words = [words_of(text) for text in texts]
        if not words:
            return np.empty(0)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = self._rows([w for own in words for w in own])
        # Texts lie one after the other in whole halves of a window, two at least, filled up with row 0.
        halves = np.maximum(-(-sizes // HALF), WINDOW // HALF)
        ends = np.cumsum(halves)
        starts = (ends - halves) * HALF
        rows = np.zeros((int(ends[-1]), HALF), np.int64)
        rows.ravel()[np.arange(len(flat)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)] = flat
        weights, parts = self._weighed(rows, ends)
        over = _sums(weights), _sums(weights * parts)
        heights = over[1] / np.maximum(over[0], 1e-300)
        place = np.arange(len(heights)) - np.repeat(starts, halves * HALF)[: len(heights)]
        heights[place > np.repeat(np.maximum(sizes - WINDOW, 0), halves * HALF)[: len(heights)]] = -np.inf  # runs into the next text
        return np.maximum.reduceat(heights, starts) + float(self.network.params["out"][-1])

    def _weighed(self, rows: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each place (0 without a word) and its part of a logit; ``ends`` are the texts' ends in ``rows``."""
        weights, parts = np.empty(rows.size), np.empty(rows.size)
        opens, closes = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
        opens[0], opens[ends[:-1]], closes[ends - 1] = True, True, True
        for i in range(0, len(rows), RUN):
            n = np.arange(i, min(i + RUN, len(rows)))
            before = np.where(opens[n, None], 0, rows[n - 1])
            after = np.where(closes[n, None], 0, rows[(n + 1) % len(rows)])
            states = self.network.words.around(self.gates, rows[n], before, after)
            block = slice(i * HALF, (i + len(n)) * HALF)
            weight, part = self.network.weighed(states.reshape(-1, states.shape[-1]))
            weights[block], parts[block] = np.where(rows[n].ravel() > 0, weight, 0), part
        return weights, parts


def _sums(values: np.ndarray) -> np.ndarray:
    """The sum of ``WINDOW`` (a power of two) values from each place on."""
    step = 1
    while step < WINDOW:
        values = values[:-step] + values[step:]
        step *= 2
    return values


def _cells_of(word: str) -> list[int]:
    """Cells of a word and of its pieces of four characters; the first piece is one of its own."""
    pieces = {word, *(f"{'+' if i else '^'}{word[i : i + 4]}" for i in range(max(1, len(word) - 3)))}
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % CELLS for p in pieces]


class Cells:
    def __init__(self):
        self.known: dict[str, list[int]] = {}

    def of(self, words: Iterable[str]) -> list[list[int]]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out = []
        for word in words:
            cells = self.known.get(word)
            if cells is None:
                cells = self.known[word] = _cells_of(word)
            out.append(cells)
        return out


def class_odds(rows: DataFrame, label: str, text: str) -> np.ndarray:
    """For each cell the log odds of class 1 in labelled rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals, cells = np.zeros((2, CELLS), np.int64), np.zeros(2, np.int64), Cells()
        for batch in slices(batches, text):
            part = batch.to_pydict()
            for one, y in zip(part[text], part[label], strict=True):
                found = {c for own in cells.of(set(words_of(one))) for c in own}
                counts[y, np.fromiter(found, np.int64, len(found))] += 1
                totals[y] += 1
        there = np.flatnonzero(counts.any(0))
        values = [np.append(there, -1), np.append(counts[0, there], totals[0]), np.append(counts[1, there], totals[1])]
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], names=["cell", "n0", "n1"])

    parts = rows.select(text, F.col(label).cast("int").alias(label)).mapInArrow(run, "cell long, n0 long, n1 long")
    sums = parts.groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas().sort_values("cell")  # CELLS rows at most
    counts = np.zeros((2, CELLS + 1))  # the last place: cell -1
    counts[0, sums["cell"]], counts[1, sums["cell"]] = sums["n0"], sums["n1"]
    totals = counts[:, -1].copy()
    rate = (counts[:, :-1] + 0.5) / (totals[:, None] + 1)
    # A cell seen in few toxic rows says little.
    return (np.log(rate[1]) - np.log(rate[0])) * np.minimum(1, counts[1, :-1] / 5)


def likely_windows(rows: DataFrame, odds: np.ndarray, label: str, text: str, likely: int = 4, others: int = 8) -> DataFrame:
    """(doc_id, label, windows): the likeliest windows first, for label 0 also some by hash."""
    shared = rows.sparkSession.sparkContext.broadcast(odds.astype(np.float32))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells()
        for batch in slices(batches, text):
            part, out = batch.to_pydict(), []
            for doc_id, y, one in zip(part["doc_id"], part[label], part[text], strict=True):
                words = words_of(one)
                height = {w: max(shared.value[own].max(), 0) for w, own in zip(set(words), cells.of(set(words)), strict=True)}
                own = np.array([height[w] for w in words])
                spans = windows_of(len(words))
                strength = np.array([own[s:e].sum() for s, e in spans])
                picked = list(np.argsort(-strength, kind="stable")[:likely])
                if not y:
                    picked += sorted(range(len(spans)), key=lambda i: zlib.crc32(f"{doc_id} {i}".encode()))[:others]
                out.append([" ".join(words[slice(*spans[i])]) for i in dict.fromkeys(picked)])
            columns = [pa.array(part["doc_id"], pa.int64()), pa.array(part[label], pa.int32()), pa.array(out, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "windows"])

    rows = rows.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias(label), text)
    return rows.mapInArrow(run, "doc_id long, label int, windows array<string>")


def train(docs: DataFrame, labels: DataFrame, label: str, text: str = "text", per_class: int = PER_CLASS) -> Network | float:
    """A calibrated network of ``label`` (0 or 1) in ``labels`` (doc_id, label), outside the held-out fold.

    A constant score where there is no row of a class.
    """
    totals = np.array(class_sizes(labels, label), float)
    constant = float(totals[1] / totals.sum()) if totals.sum() else 0.0
    if not totals.all():
        return constant
    apart = fold_of("doc_id", 5) == 1
    fitting, calibrating = labels.where(~apart), labels.where(apart)
    odds = class_odds(labelled_sample(docs, fitting, label, COUNTED, text=text), label, text)
    found = likely_windows(labelled_sample(docs, fitting, label, per_class, text=text), odds, label, text).toPandas()
    if found["label"].nunique() < 2:  # labels of documents that are not there, or none to train on
        return constant
    found = found.assign(key=[zlib.crc32(str(i).encode()) for i in found["doc_id"]]).sort_values(["key", "doc_id"])
    network = fit_windows([(int(y), [w.split() for w in ws]) for y, ws in zip(found["label"], found["windows"], strict=True)])
    scored = logits(labelled_sample(docs, calibrating, label, per_class, text=text), network, text).select(label, "logit").toPandas()
    if scored[label].nunique() < 2:
        return network
    y = scored[label].to_numpy(int)
    weights = (totals / totals.sum() / np.maximum(np.bincount(y, minlength=2) / len(y), 1e-9))[y]
    z = scored["logit"].to_numpy()
    network.a = max(calibrate(z, y, weights)[0], 0.1)
    network.b = -network.a * best_cut(z, y, weights)
    return network


def best_cut(z: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """The place between two logits that divides the classes with the least weighted error; of equals the middle one."""
    order = np.argsort(z, kind="stable")
    z, y, weights = z[order], y[order], weights[order]
    missed = np.append(0, np.cumsum(weights * (y == 1)))  # rows below the cut are taken for class 0
    wrong = np.append(np.cumsum((weights * (y == 0))[::-1])[::-1], 0)
    errors = missed + wrong
    errors[1:-1][z[1:] == z[:-1]] = np.inf  # equal logits are not divided
    best = np.flatnonzero(errors <= errors.min() + 1e-9)
    at = int(best[len(best) // 2])
    low, high = z[at - 1] if at else z[0] - 2, z[at] if at < len(z) else z[-1] + 2
    return float(low + high) / 2


def logits(docs: DataFrame, network: Network, text: str = "text", logit: str = "logit") -> DataFrame:
    """All columns of ``docs`` and ``logit``, the highest over all windows of the text."""
    refuse(docs.columns, logit)
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches, text):
            values = scorer.highest(batch.column(batch.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values.astype(np.float64))], names=[*batch.schema.names, logit])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(logit, T.DoubleType())]))


def predictions(docs: DataFrame, network: Network | float) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    docs = docs.select("doc_id", "text")
    if isinstance(network, float):
        scored = docs.withColumn("score", F.lit(network))
    else:
        scored = logits(docs, network)
        at = F.least(F.lit(30.0), F.greatest(F.lit(-30.0), F.lit(network.a) * F.col("logit") + F.lit(network.b)))
        scored = scored.withColumn("score", 1 / (1 + F.exp(-at)))
    return scored.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
