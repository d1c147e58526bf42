"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors of its words and of its character
n-grams, both hashed into a fixed number of buckets; a word that repeats the
one before it also counts as a marker token with a bucket of its own. Words,
markers and n-grams of each length are averaged apart (markers over the number
of words) and then added, so that none drowns the others. A softmax layer turns the
average into class probabilities. Vectors and weights are trained together by
stochastic gradient descent (AdaGrad steps) in numpy on a bounded sample of
labelled documents: up to ``per_class`` documents and ``budget_chars``
characters a class, texts of any length (very long ones by random pieces). The
bags of the sample are two flat arrays on the driver. Scoring reads every whole text. Since the output is
linear in the average, a bucket's share of the log odds is one number, and a
document's score is a sum of means over its features.

Cases: a null or empty text has no features and is scored by the bias; with no
labels of one class the score is a constant (1 if only good ones are known, 0
if only bad ones, 0.5 if none); repeated rows are scored each; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.labelled import held_out, labelled_sample
from vigil.llm.text import Powers, byte_values, column_bytes, mix, text_slices, word_hashes, word_spans

BITS = 17
BUCKETS = (1 << BITS) + 1  # the last one is the marker of a repeated word
GRAMS = (2, 3, 4)
DIM = 12
EPOCHS = 6
PER_CLASS = 2000
BUDGET_CHARS = 8_000_000
KEEP = 0.7
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def char_values(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number per character (its UTF-8 bytes) and each one's first byte."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    value = data[starts].astype(np.uint64)
    wide = np.flatnonzero(value >= 0xC0)
    for k in (1, 2, 3):
        at = starts[wide] + k
        wide, at = wide[at < len(data)], at[at < len(data)]
        more = (data[at] & 0xC0) == 0x80
        wide, at = wide[more], at[more]
        value[wide] = (value[wide] << np.uint64(8)) | data[at].astype(np.uint64)
    return value, starts


def features(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, pows: Powers) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For words, markers and each n-gram length: bucket of each feature, the
    first feature of each text (one more entry than texts), and the number of
    each text's features that the average is taken over."""
    shift = np.uint64(64 - BITS)
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends, [table], pows)[0]
    again = np.zeros(len(words) + 1, bool)
    again[1:-1] = words[1:] == words[:-1]
    again[first] = False  # a text's first word repeats nothing
    out = [(words >> shift, first, np.diff(first)),
           (np.full(int(again.sum()), BUCKETS - 1, np.uint64), np.concatenate([[0], np.cumsum(again)])[first], np.diff(first))]
    chars, at = char_values(data)
    bounds = np.searchsorted(at, offsets)
    with np.errstate(over="ignore"):
        for n in GRAMS:
            size = max(0, len(chars) - n + 1)
            h = np.full(size, n, np.uint64)
            for k in range(n):
                h = (h ^ chars[k:k + size]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            # n-grams that reach into the next text do not count
            stop = np.maximum(bounds[1:] - n + 1, bounds[:-1])
            inside = np.zeros(size + 1, np.int32)
            np.add.at(inside, np.minimum(bounds[:-1], size), 1)
            np.add.at(inside, np.minimum(stop, size), -1)
            keep = np.cumsum(inside[:size]) > 0
            counts = np.maximum(stop - bounds[:-1], 0)
            out.append(((h * np.uint64(0xD6E8FEB86659FD93))[keep] >> shift, np.concatenate([[0], np.cumsum(counts)]), counts))
    return out


def bag(text: str, table: np.ndarray, pows: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and their weights."""
    data = np.frombuffer(text.encode(), np.uint8)
    found = features(data, np.array([0, len(data)]), table, pows)
    ids, place = np.unique(np.concatenate([f for f, _, _ in found]), return_inverse=True)
    weight = np.concatenate([np.full(len(f), 1 / max(1, int(n[0]))) for f, _, n in found])
    return ids.astype(np.int64), np.bincount(place, weight, len(ids))


def bags(sample: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and weights of all texts, one after the other, and the first of
    each. The arrays are made once, so that they are freed as a whole."""
    table, pows = byte_values(4), Powers()
    most = sum((1 + len(GRAMS)) * len(t) + 1 for t, _ in sample)  # untouched pages cost nothing
    ids, part, first = np.empty(most, np.int32), np.empty(most, np.float32), np.zeros(len(sample) + 1, np.int64)
    for i, (text, _) in enumerate(sample):
        own, weight = bag(text, table, pows)
        first[i + 1] = first[i] + len(own)
        ids[first[i]:first[i + 1]], part[first[i]:first[i + 1]] = own, weight
    return ids, part, first


def train(sample: list[tuple[str, int]], seed: int = 4) -> tuple[np.ndarray, float]:
    """(log-odds of each bucket, bias) from labelled texts."""
    labels = np.array([y for _, y in sample], np.int64)
    if len(set(labels.tolist())) < 2:
        known = {0: -30.0, 1: 30.0}
        return np.zeros(BUCKETS), known[int(labels[0])] if len(labels) else 0.0
    ids_of, part_of, first = bags(sample)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    weights, bias = rng.normal(0, 0.5, (DIM, 2)), np.zeros(2)
    seen, seen_w, seen_b = np.full(BUCKETS, 1e-8), np.full((DIM, 2), 1e-8), np.full(2, 1e-8)
    share = np.bincount(labels, minlength=2) / len(labels)
    for _ in range(EPOCHS):
        order = rng.permutation(len(sample))
        for at in range(0, len(order), 32):
            batch = order[at:at + 32]
            ids = np.concatenate([ids_of[first[i]:first[i + 1]] for i in batch])
            part = np.concatenate([part_of[first[i]:first[i + 1]] for i in batch])
            doc = np.repeat(np.arange(len(batch)), np.diff(first)[batch])
            mean = np.stack([np.bincount(doc, part * vectors[ids, k], len(batch)) for k in range(DIM)], 1)
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            p *= (0.5 / share[labels[batch]])[:, None] / len(batch)  # classes count alike
            back = p @ weights.T
            g_w, g_b = mean.T @ p, p.sum(0)
            seen_w += g_w ** 2
            seen_b += g_b ** 2
            weights -= 0.1 * g_w / np.sqrt(seen_w)
            bias -= 0.1 * g_b / np.sqrt(seen_b)
            uniq, place = np.unique(ids, return_inverse=True)
            g = np.stack([np.bincount(place, part * back[doc, k], len(uniq)) for k in range(DIM)], 1)
            seen[uniq] += (g ** 2).mean(1)
            vectors[uniq] -= 0.1 * g / np.sqrt(seen[uniq])[:, None]
    return vectors @ (weights[:, 1] - weights[:, 0]), float(bias[1] - bias[0])


def score_slice(data: np.ndarray, offsets: np.ndarray, odds: np.ndarray, bias: float, table: np.ndarray, pows: Powers) -> np.ndarray:
    """Score of each text; sums run in text order, so they do not depend on
    the neighbours in the batch."""
    total = np.full(len(offsets) - 1, bias)
    for ids, first, count in features(data, offsets, table, pows):
        some = np.flatnonzero(np.diff(first))
        if len(some):
            total[some] += np.add.reduceat(odds[ids], first[some]) / count[some]
    return 1 / (1 + np.exp(-np.clip(total, -700, 700)))


def quality_scores(docs: DataFrame, model: tuple[np.ndarray, float], keep: float = KEEP, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of (doc_id, text);
    ``carry`` names columns of ``docs`` to hand through as ``carry_<name>``."""
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "text", *(F.col(c).alias(f"carry_{c}") for c in carry if c != "text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "held_out", "score", "predicted", *(f"carry_{c}" for c in carry)]

    def run(batches):
        (odds, bias), table, pows = held.value, byte_values(4), Powers()
        for batch in text_slices(batches, "text"):
            data, offsets = column_bytes(batch.column(2))
            score = score_slice(data, offsets, odds, bias, table, pows)
            handed = [batch.column("text" if c == "text" else f"carry_{c}") for c in carry]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= keep).astype(np.int32)), *handed], names)

    types = dict(docs.dtypes)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, ", ".join([SCHEMA, *(f"carry_{c} {types[c]}" for c in carry)]))


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, budget_chars: int = BUDGET_CHARS) -> tuple[np.ndarray, float]:
    """Model from the labels of documents outside the held-out fold."""
    return train(labelled_sample(docs, labels, "quality", 4, 2, per_class, budget_chars))


def op4_quality_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality_scores(docs, fit_quality(docs, labels))


QUERIES = {"op4_quality_subword": op4_quality_subword}
ORACLE: dict[str, str] = {}
