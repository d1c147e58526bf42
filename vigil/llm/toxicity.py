"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters the network as the learned vector of its hash next to the mean
of the learned vectors of its character n-grams (with marks for its ends). Two
gated recurrent layers read a window of words in both directions, attention
pools their states, and a logistic output scores the window. A document is
scored over all its windows of ``WINDOW`` words that start every ``STRIDE``
words (the last one ends with the text): its score is that of the worst window.

Training is numpy back-propagation with Adam steps on a bounded sample of
labelled documents (up to ``per_class`` documents and ``budget_chars``
characters a class, texts of any length, very long ones by random pieces). Labels belong to documents, so in each epoch a toxic
document is represented by the window the network finds worst, a clean one by
its worst and by a random window. Last, scale and bias of the document score are fitted.

Cases: a null or empty text is one window without words and gets the score of
the bias; with labels of one class or none the score is a constant (1, 0 or
0.5); repeated rows are scored each; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.labelled import held_out, labelled_sample
from vigil.llm.text import Powers, byte_values, column_bytes, mix, text_slices, word_hashes, word_spans

WINDOW, STRIDE = 32, 16
WORD_BITS, GRAM_BITS = 14, 15
GRAMS = (3, 4, 5)  # bytes, ends of the word included
SIDE = 8  # width of each input vector, of each direction's state and of the attention
EPOCHS = 10
PER_CLASS = 1200
BUDGET_CHARS = 6_000_000
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


# --- inputs -----------------------------------------------------------------
class Words:
    """The distinct words of some texts as network inputs: ``ids`` are word
    buckets, and word i has the n-gram buckets grams[first[i]:first[i+1]]."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        uniq, where, self.index = np.unique(hashes, return_index=True, return_inverse=True)
        self.ids = (uniq >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        # each distinct word once more, between two marks that no word holds
        size = ends[where] - starts[where] + 2
        begin = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(begin[-1]) - np.repeat(begin[:-1], size) + np.repeat(starts[where], size) - 1
        inner = np.ones(begin[-1], bool)
        inner[begin[:-1]] = inner[begin[1:] - 1] = False
        lower = np.arange(256, dtype=np.uint64)
        lower[65:91] += np.uint64(32)
        chars = np.full(begin[-1], 32, np.uint64)
        chars[inner] = lower[data[at[inner]]]
        word = np.repeat(np.arange(len(size)), size)
        grams, owner = [], []
        for n in GRAMS:
            last = max(0, len(chars) - n + 1)
            value = np.full(last, n, np.uint64)
            for k in range(n):
                value = (value << np.uint64(8)) | chars[k:k + last]
            keep = word[:last] == word[n - 1:n - 1 + last]
            grams.append(mix(value[keep], 9) >> np.uint64(64 - GRAM_BITS))
            owner.append(word[:last][keep])
        owner = np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        self.grams = np.concatenate(grams)[order].astype(np.int64)
        self.first = np.searchsorted(owner[order], np.arange(len(size) + 1))

    def take(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of some distinct words: word buckets, n-gram buckets, the place of
        each n-gram's word, and the number of n-grams of each word."""
        n = self.first[some + 1] - self.first[some]
        place = np.repeat(np.arange(len(some)), n)
        at = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[some], n)
        return self.ids[some], self.grams[at], place, np.maximum(n, 1)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, number of words) of every window of texts whose
    words are first[i]:first[i+1]; a text without words has one empty window."""
    size = np.diff(first)
    n = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    doc = np.repeat(np.arange(len(size)), n)
    step = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = np.minimum(step * STRIDE, np.maximum(size[doc] - WINDOW, 0))
    return doc, first[:-1][doc] + start, np.minimum(size[doc], WINDOW)


def parse(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, pows: Powers):
    """Distinct words and the windows over a batch of texts."""
    starts, ends, first = word_spans(data, offsets)
    words = Words(data, starts, ends, word_hashes(data, starts, ends, [table], pows)[0])
    return words, *windows(first)


def grid(words: Words, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word at each place of each window, and which places are filled."""
    at = start[:, None] + np.arange(WINDOW)
    filled = np.arange(WINDOW) < size[:, None]
    if not len(words.index):
        return np.zeros(at.shape, np.int64), filled
    return words.index[np.minimum(at, len(words.index) - 1)], filled


# --- network ----------------------------------------------------------------
def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def new_network(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    u = lambda *shape: rng.uniform(-1, 1, shape).astype(np.float32)
    net = {"word": 0.5 * u(1 << WORD_BITS, SIDE), "gram": 0.5 * u(1 << GRAM_BITS, SIDE)}
    for d in "fb":
        net |= {f"in_{d}": 0.4 * u(2 * SIDE, 3 * SIDE), f"bias_{d}": np.zeros(3 * SIDE, np.float32), f"state_{d}": 0.4 * u(SIDE, 3 * SIDE)}
    return net | {"look": 0.4 * u(2 * SIDE, SIDE), "look_bias": np.zeros(SIDE, np.float32), "look_at": u(SIDE),
                  "out": 0.4 * u(2 * SIDE), "out_bias": np.zeros(1, np.float32), "doc": np.array([1, 0], np.float32)}


def word_inputs(net: dict, taken) -> np.ndarray:
    ids, grams, place, n = taken
    mean = np.zeros((len(ids), SIDE), np.float32)
    for k in range(SIDE):
        mean[:, k] = np.bincount(place, net["gram"][grams, k], len(ids)) / n
    return np.concatenate([net["word"][ids], mean], 1)


def recur(net: dict, d: str, gates: np.ndarray, index: np.ndarray, filled: np.ndarray, keep: bool):
    """States of one direction, (places, windows, SIDE). ``gates`` holds the
    input's part of the gates of each distinct word."""
    order = range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1)
    h, u = np.zeros((len(index), SIDE), np.float32), net[f"state_{d}"]
    states, saved = np.empty((WINDOW, len(index), SIDE), np.float32), []
    for t in order:
        x, g = gates[index[:, t]], h @ u
        zr = sigmoid(x[:, :2 * SIDE] + g[:, :2 * SIDE])
        z, r, gn = zr[:, :SIDE], zr[:, SIDE:], g[:, 2 * SIDE:]
        n = np.tanh(x[:, 2 * SIDE:] + r * gn)
        step = z * filled[:, t, None]
        if keep:
            saved.append((t, h, z, r, n, gn))
        h = h + step * (n - h)
        states[t] = h
    return states, saved


def pool(net: dict, states: np.ndarray, filled: np.ndarray):
    """Attention over the places of each window: pooled states, weights, and
    the activations behind them."""
    act = np.tanh(states @ net["look"] + net["look_bias"])
    e = np.where(filled.T, act @ net["look_at"], np.float32(-1e9))
    e = np.exp(e - e.max(0)) * filled.T
    a = e / np.maximum(e.sum(0), 1e-30)
    return np.einsum("tb,tbk->bk", a, states), a, act


def logits(net: dict, words: Words, start: np.ndarray, size: np.ndarray, batch: int = 2048) -> np.ndarray:
    """Score of each window before the logistic function."""
    x = word_inputs(net, words.take(np.arange(len(words.ids)))) if len(words.ids) else np.zeros((1, 2 * SIDE), np.float32)
    gates = {d: x @ net[f"in_{d}"] + net[f"bias_{d}"] for d in "fb"}
    out = np.empty(len(start), np.float32)
    for at in range(0, len(start), batch):
        index, filled = grid(words, start[at:at + batch], size[at:at + batch])
        states = np.concatenate([recur(net, d, gates[d], index, filled, False)[0] for d in "fb"], 2)
        out[at:at + batch] = pool(net, states, filled)[0] @ net["out"] + net["out_bias"]
    return out


def gradients(net: dict, words: Words, start: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray,
              rng: np.random.Generator | None = None):
    """Gradient of the weighted logistic loss of some windows: dense arrays by
    name, and (rows, gradient) for the two vector tables. With ``rng``, the
    word half of the input is dropped for a random half of the words, so that
    the network learns from their characters too."""
    index, filled = grid(words, start, size)
    some, index = np.unique(index, return_inverse=True)
    index = index.reshape(filled.shape)
    taken = words.take(some)
    x = word_inputs(net, taken)
    stay = np.ones((len(some), 1), np.float32) if rng is None else 2 * (rng.random((len(some), 1)) < 0.5).astype(np.float32)
    x[:, :SIDE] *= stay
    runs = {d: recur(net, d, x @ net[f"in_{d}"] + net[f"bias_{d}"], index, filled, True) for d in "fb"}
    states = np.concatenate([runs[d][0] for d in "fb"], 2)
    pooled, a, act = pool(net, states, filled)
    err = (sigmoid(pooled @ net["out"] + net["out_bias"]) - y) * weight
    g = {"out": pooled.T @ err, "out_bias": err.sum(keepdims=True)}
    d_pooled = err[:, None] * net["out"]
    d_a = np.einsum("bk,tbk->tb", d_pooled, states)
    d_e = a * (d_a - (a * d_a).sum(0))
    d_act = d_e[:, :, None] * net["look_at"] * (1 - act ** 2)
    g |= {"look_at": np.einsum("tb,tbk->k", d_e, act), "look": np.einsum("tbi,tbj->ij", states, d_act), "look_bias": d_act.sum((0, 1))}
    d_states = a[:, :, None] * d_pooled + d_act @ net["look"].T
    d_x = np.zeros_like(x)
    for k, d in enumerate("fb"):
        u, d_h = net[f"state_{d}"], np.zeros((len(index), SIDE), np.float32)
        d_gates, d_u = np.zeros((len(some), 3 * SIDE), np.float32), np.zeros_like(u)
        for t, h, z, r, n, gn in reversed(runs[d][1]):
            d_h = d_h + d_states[t][:, k * SIDE:(k + 1) * SIDE]
            m = filled[:, t, None]
            d_n = d_h * z * m * (1 - n ** 2)
            d_z = d_h * (n - h) * m * z * (1 - z)
            d_r = d_n * gn * r * (1 - r)
            d_g = np.concatenate([d_z, d_r, d_n * r], 1)
            d_u += h.T @ d_g
            np.add.at(d_gates, index[:, t], np.concatenate([d_z, d_r, d_n], 1))
            d_h = d_h * (1 - z * m) + d_g @ u.T
        g |= {f"state_{d}": d_u, f"in_{d}": x.T @ d_gates, f"bias_{d}": d_gates.sum(0)}
        d_x += d_gates @ net[f"in_{d}"].T
    ids, grams, place, n = taken
    return g, {"word": (ids, d_x[:, :SIDE] * stay), "gram": (grams, (d_x[:, SIDE:] / n[:, None])[place])}


class Adam:
    """Adam steps; rows of a vector table are stepped when a batch has them."""

    def __init__(self, net: dict, rate: float) -> None:
        self.net, self.rate, self.t = net, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.items()}

    def step(self, dense: dict, rows: dict) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for name, g in dense.items():
            self.m[name] += 0.1 * (g - self.m[name])
            self.v[name] += 0.001 * (g ** 2 - self.v[name])
            self.net[name] -= (scale * self.m[name] / (np.sqrt(self.v[name]) + 1e-8)).astype(np.float32)
        for name, (at, g) in rows.items():
            uniq, place = np.unique(at, return_inverse=True)
            total = np.stack([np.bincount(place, g[:, k], len(uniq)) for k in range(g.shape[1])], 1).astype(np.float32)
            self.m[name][uniq] += 0.1 * (total - self.m[name][uniq])
            self.v[name][uniq] += 0.001 * (total ** 2 - self.v[name][uniq])
            self.net[name][uniq] -= scale * self.m[name][uniq] / (np.sqrt(self.v[name][uniq]) + 1e-8)


def worst(doc: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The first window with the highest score of each document."""
    order = np.lexsort((np.arange(len(doc)), -score, doc))
    return order[np.flatnonzero(np.diff(doc[order], prepend=-1))]


def train(sample: list[tuple[str, int]], seed: int = 9) -> dict[str, np.ndarray]:
    net = new_network(seed)
    y = np.array([label for _, label in sample], np.float32)
    if len(np.unique(y)) < 2:
        net["doc"] = np.array([0, 0 if not len(y) else 30 if y[0] else -30], np.float32)
        return net
    blobs = [t.encode() for t, _ in sample]
    data = np.frombuffer(b"".join(blobs), np.uint8)
    words, doc, start, size = parse(data, np.concatenate([[0], np.cumsum([len(b) for b in blobs])]), byte_values(9, lower=True), Powers())
    rng, adam = np.random.default_rng(seed), Adam(net, 0.01)
    first = np.searchsorted(doc, np.arange(len(y) + 1))
    share = y.mean()
    for epoch in range(EPOCHS):
        adam.rate = 0.01 if epoch < EPOCHS - 3 else 0.003
        drawn = first[:-1] + (rng.random(len(y)) * np.diff(first)).astype(np.int64)
        top = worst(doc, logits(net, words, start, size)) if epoch else drawn
        chosen = np.unique(np.concatenate([top, drawn[y == 0]]))
        rng.shuffle(chosen)
        for at in range(0, len(chosen), 64):
            batch = chosen[at:at + 64]
            target = y[doc[batch]]
            weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32) / len(batch)
            adam.step(*gradients(net, words, start[batch], size[batch], target, weight, rng))
    # scale and bias of the document score: logistic regression by Newton steps
    s = np.maximum.reduceat(logits(net, words, start, size), first[:-1]).astype(float)
    x, w = np.stack([s, np.ones_like(s)], 1), np.array([1.0, 0.0])
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w -= np.clip(np.linalg.solve(h, x.T @ (p - y) + 1e-2 * (w - [1, 0])), -1, 1)
    net["doc"] = w.astype(np.float32)
    return net


def score_slice(net: dict, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, pows: Powers) -> np.ndarray:
    words, doc, start, size = parse(data, offsets, table, pows)
    top = np.maximum.reduceat(logits(net, words, start, size), np.searchsorted(doc, np.arange(len(offsets) - 1)))
    return 1 / (1 + np.exp(-np.clip(top.astype(float) * float(net["doc"][0]) + float(net["doc"][1]), -700, 700)))


def toxicity_scores(docs: DataFrame, net: dict, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), 5, 0).alias("held_out"), "text")
    held = docs.sparkSession.sparkContext.broadcast(net)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        net, table, pows = held.value, byte_values(9, lower=True), Powers()
        for batch in text_slices(batches, "text"):
            score = score_slice(net, *column_bytes(batch.column(2)), table, pows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names)

    return rows.mapInArrow(run, SCHEMA)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, budget_chars: int = BUDGET_CHARS) -> dict:
    """Network from the labels of documents outside the held-out fold."""
    return train(labelled_sample(docs, labels, "toxic", 5, 0, per_class, budget_chars))


def op9_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity_scores(docs, fit_toxicity(docs, labels))


QUERIES = {"op9_toxicity_gru": op9_toxicity_gru}
ORACLE: dict[str, str] = {}
