"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL.

Features are word unigrams and bigrams of the whole lower-cased text (A-Z), hashed to
`BITS` bits, valued 1 + log(count) and scaled to unit length. Follow-the-regularised-
leader (proximal, per-coordinate rates, L1 and L2) goes over the training rows in a
seeded order. A score is the logistic of the sparse dot product.

The classifier is fitted on a bounded sample of labelled rows: in the order of a seeded
hash of their id at most `MOST`, and of these as many as have `FEATURES` features
together. A row counts with all features of its whole text or not at all. Features are
computed on the executors; the driver gets the sample, and a model of 2**BITS weights goes
back. Every row is scored over its whole text.

Defined results: null or empty text has no features and scores the logistic of the
bias; labels other than 0 and 1 and null labels are not learned from; a doc_id with
several labels is learned once per label and one with several texts once per text; rows
and labels that are repeated count once; with no row to learn from every score is 0.5;
repeated rows are scored alike; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import Scratch, gram_hashes, map_rows, text_bytes, text_id, word_hashes

BITS, MOST, FEATURES, EPOCHS, SEED = 18, 8_000, 8_000_000, 3, 17


def features(text: bytes | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Indices (distinct) and values of a text."""
    words = word_hashes((text or b"").lower())
    grams = np.concatenate((words, gram_hashes(words, 2))) >> np.uint64(64 - bits)
    index, count = np.unique(grams, return_counts=True)
    value = 1.0 + np.log(count)
    return index.astype(np.int64), value / (np.linalg.norm(value) or 1.0)


class Ftrl:
    """FTRL-proximal; the last weight is the bias."""

    def __init__(self, size: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, index: np.ndarray | slice) -> np.ndarray:
        z = self.z[index]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[index])) / self.alpha + self.l2))

    def update(self, index: np.ndarray, value: np.ndarray, label: int, weight: float) -> None:
        at, x = np.append(index, len(self.z) - 1), np.append(value, 1.0)
        w = self.weights(at)
        g = (logistic(float(w @ x)) - label) * x * weight
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def logistic(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, x))))


def sample(docs: DataFrame, labels: DataFrame, bits: int, most: int, total: int, seed: int) -> list:
    """Rows (label, idx, val) to learn from, in the order of the seeded hash."""

    def make():
        def step(row):
            index, value = features(row[4], bits)
            return [(*row[:4], len(index), index.astype("<i4").tobytes(), value.astype("<f4").tobytes())]

        return step

    scratch = Scratch(docs.sparkSession)
    known = labels.where(F.col("label").isin(0, 1)).select("doc_id", F.col("label").cast("int")).distinct()
    # ids first: at most ``most`` of them have texts looked up, then texts: at most ``most`` are read
    ids = known.withColumn("at", F.xxhash64("doc_id", F.lit(seed))).orderBy("at", "doc_id", "label").limit(most)
    h1, _ = text_id()
    texts = docs.select("doc_id", h1.alias("h1")).join(F.broadcast(ids), "doc_id").distinct()
    order = ("at", "h1", "label")
    chosen = scratch.table(texts.orderBy(*order).limit(most))
    rows = docs.select("doc_id", text_bytes(), h1.alias("h1")).join(F.broadcast(chosen), ["doc_id", "h1"])
    once = rows.groupBy(*order, "doc_id").agg(F.first("text").alias("text"))
    made = scratch.table(map_rows(once.select(*order, "doc_id", "text"), "at long, h1 long, label int, doc_id long, n int, idx binary, val binary", make))
    held, last = 0, None
    for row in made.select(*order, "n").orderBy(*order).collect():  # ``most`` rows of four numbers
        held += row["n"]
        if held > total:
            break
        last = row
    upto = F.lit(False) if last is None else F.struct(*order) <= F.struct(*(F.lit(last[c]).cast(t) for c, t in zip(order, ("long", "long", "int"), strict=True)))
    out = made.where(upto).orderBy(*order).collect()  # ``total`` features at most
    scratch.keep()
    return out


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, most: int = MOST, total: int = FEATURES, epochs: int = EPOCHS, seed: int = SEED) -> np.ndarray:
    """Weights from texts of ``docs`` and (doc_id, label) of ``labels``; see the module text for the bounds."""
    data = [(np.frombuffer(r["idx"], "<i4"), np.frombuffer(r["val"], "<f4"), r["label"]) for r in sample(docs, labels, bits, most, total, seed)]
    model = Ftrl(1 << bits)
    if not data:
        return np.zeros((1 << bits) + 1)
    ones = sum(label for *_, label in data)
    scale = {1: len(data) / (2 * max(ones, 1)), 0: len(data) / (2 * max(len(data) - ones, 1))}  # both labels weigh alike
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(data)):
            index, value, label = data[k]
            model.update(index, value, label, scale[label])
    return model.weights(slice(None))


def score_documents(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """doc_id, score, predicted per row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        w = shared.value

        def step(row):
            index, value = features(row[1], bits)
            score = logistic(float(w[index] @ value) + float(w[-1]))
            return [(row[0], score, int(score >= 0.5))]

        return step

    return map_rows(docs.select("doc_id", text_bytes()), "doc_id long, score double, predicted int", make)
