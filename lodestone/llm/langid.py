"""Language ID by the nearest of several centroids per language.

A text becomes a vector of hashed letter 1- to 3-grams (lower-cased, everything but
letters one blank), weighted log(1 + count) * idf and scaled to unit length. Spherical
k-means gives each learned language up to `CLUSTERS` centroids; the language of the
centroid with the greatest cosine is predicted. A prediction is marked rejected if its
cosine is below what all but `REJECT` of the training texts of that centroid have.

The classifier is fitted on a bounded sample of rows with a lang, in the order of a seeded
hash of their id and text: `PER_LANGUAGE` a language, `MOST` in all, and of these, the
languages in turns, as many as have `GRAMS` distinct n-grams together. A row counts with
its whole text or not at all. Every row is predicted from its whole text and nothing but
its text.

Defined results: null texts and texts without a letter get `und` with score 0; rows with
null lang are not learned from, an empty one is a language; repeated rows are learned
from once; with nothing to learn from every row is `und`; repeated rows are predicted
alike; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import Scratch, join_groups, map_rows, mix64, text_bytes, text_id

BITS, CLUSTERS, PER_LANGUAGE, MOST, GRAMS, REJECT, SEED = 13, 4, 1_000, 8_000, 12_000_000, 0.002, 29
_PIECE = 1 << 19
_ALPHA: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _ALPHA[0]


def gram_counts(text: bytes, bits: int = BITS) -> np.ndarray | None:
    """Counts by hashed n-gram; None without a letter."""
    code = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), "<u4")
    known = letters()[code]
    if not known.any():
        return None
    code = np.where(known, code, 32)
    code = np.concatenate(([32], code[known | np.concatenate(([True], known[:-1]))], [32]))
    total = np.zeros(1 << bits, np.int64)
    for at in range(0, len(code), _PIECE):
        one = code[at : at + _PIECE + 2].astype(np.uint64)
        gram = one
        for size in (1, 2, 3):
            if size > 1:
                gram = gram[:-1] * np.uint64(0x1F123BB5) + one[size - 1 :]
            own = gram[: min(_PIECE, len(gram))]
            total += np.bincount((mix64(own + np.uint64(size << 60)) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return total


@dataclass
class Centroids:
    languages: list[str]  # by centroid
    vectors: np.ndarray  # centroid x dimension, unit length
    idf: np.ndarray
    least: np.ndarray  # cosine below which a prediction is rejected

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        counts = gram_counts(text) if text else None
        if counts is None or not self.languages:
            return "und", 0.0, True
        at = np.flatnonzero(counts)
        value = np.log1p(counts[at]) * self.idf[at]
        near = self.vectors[:, at] @ value / (np.linalg.norm(value) or 1.0)
        best = int(np.argmax(near))
        return self.languages[best], float(min(1.0, max(0.0, near[best]))), bool(near[best] < self.least[best])


def cluster(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; seeds are drawn apart from each other."""
    seeds = [rows[rng.integers(len(rows))]]
    while len(seeds) < min(k, len(rows)):
        gap = np.maximum(0, 1 - (rows @ np.array(seeds).T).max(1)) ** 2
        if gap.sum() <= 1e-9:
            break
        seeds.append(rows[rng.choice(len(rows), p=gap / gap.sum())])
    centre = np.array(seeds)
    for _ in range(rounds):
        own = (rows @ centre.T).argmax(1)
        means = [rows[own == c].mean(0) for c in np.unique(own)]
        centre = np.array([m / (np.linalg.norm(m) or 1.0) for m in means])
    return centre


def sample(rows: DataFrame, per_language: int, most: int, grams: int, seed: int) -> list:
    """Rows (lang, idx, cnt) to learn from."""

    def make():
        def step(row):
            counts = gram_counts(row[2] or b"")
            if counts is None:
                return []
            at = np.flatnonzero(counts)
            return [(row[0], row[1], len(at), at.astype("<u2").tobytes(), counts[at].astype("<f4").tobytes())]

        return step

    scratch = Scratch(rows.sparkSession)
    h1, _ = text_id()
    order = F.xxhash64(F.col("doc_id"), h1, F.lit(seed))
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), order.alias("at")).distinct()
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    # twice the share of hashes that a language's sample needs, so that the window sees few rows
    share = F.least(F.lit(1.0), F.lit(2.0 * per_language) / F.col("n"))
    near = join_groups(known, counts, ["lang"], "n", max(1, known.count())).where((F.col("at") / F.lit(2.0**64) + 0.5) <= share)
    first = Window.partitionBy("lang").orderBy("at")
    ranked = near.select("lang", "at").withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_language)
    chosen = scratch.table(ranked.orderBy("k", "lang").limit(most))
    texts = rows.select(F.col("lang").cast("string").alias("lang"), order.alias("at"), text_bytes())
    once = texts.join(F.broadcast(chosen), ["lang", "at"]).groupBy("k", "lang", "at").agg(F.first("text").alias("text"))
    made = scratch.table(map_rows(once.select("k", "lang", "text"), "k int, lang string, n int, idx binary, cnt binary", make))
    held, last = 0, None
    for row in made.select("k", "lang", "n").orderBy("k", "lang").collect():  # ``most`` rows
        held += row["n"]
        if held > grams:
            break
        last = row
    upto = F.lit(False) if last is None else F.struct("k", "lang") <= F.struct(F.lit(last["k"]).cast("int"), F.lit(last["lang"]))
    out = made.where(upto).orderBy("k", "lang").collect()  # ``grams`` pairs of numbers at most
    scratch.keep()
    return out


def fit(rows: DataFrame, per_language: int = PER_LANGUAGE, most: int = MOST, clusters: int = CLUSTERS, grams: int = GRAMS, seed: int = SEED) -> Centroids:
    """Centroids from rows of (doc_id, text, lang); see the module text for the bounds."""
    got = sample(rows, per_language, most, grams, seed)
    size = 1 << BITS
    by: dict[str, list] = {}
    seen = np.zeros(size)
    for r in got:
        at = np.frombuffer(r["idx"], "<u2")
        seen[at] += 1
        by.setdefault(r["lang"], []).append((at, np.log1p(np.frombuffer(r["cnt"], "<f4"))))
    idf = np.log((1 + len(got)) / (1 + seen)) + 0.1
    rng = np.random.default_rng(seed)
    names, vectors, least = [], [], []
    for lang in sorted(by):
        dense = np.zeros((len(by[lang]), size), np.float32)
        for k, (at, value) in enumerate(by[lang]):
            dense[k, at] = value * idf[at]
        dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
        centre = cluster(dense, clusters, rng)
        near = dense @ centre.T
        own = near.argmax(1)
        for c in range(len(centre)):
            cosines = near[own == c, c]
            names.append(lang)
            vectors.append(centre[c])
            least.append(float(np.quantile(cosines, REJECT)) if len(cosines) else 0.0)
    return Centroids(names, np.array(vectors, np.float32).reshape(len(names), size), idf, np.array(least))


def predict_languages(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, lang_pred, score (cosine), rejected per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # centroids only, bounded by MOST

    def make():
        predict = shared.value.predict
        return lambda row: [(row[0], *predict(row[1]))]

    return map_rows(docs.select("doc_id", text_bytes()), "doc_id long, lang_pred string, score double, rejected boolean", make)
