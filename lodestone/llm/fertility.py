"""Quality rules on tokeniser fertility.

Two public vocabularies are measured on the words of a whole text, each word taken
with a space before it: characters per token of a byte-level BPE and of a
sentence-piece BPE, byte-fallback share of the latter, and the entropy of the byte-level
tokens in bits. Basic rules on words and lines come first. Then a text is rejected if

* its fallback share or entropy leaves the fixed bands of its script (`BANDS`, the script
  of most words), or
* its characters per token lie too far from what its language usually has: the corpus
  gives each language's median and the spread of the deviations, which shrink with the
  root of a text's tokens; `BELOW` and `ABOVE` say how many spreads are tolerated. A
  language with fewer than `LEAST` texts or without spread, and a text without one, is
  held against all texts of its script, and only if these are as few against `BANDS`.

The corpus figures cover every text that passes the basic rules and the first bands. They
are quantiles of exact counts on a grid (`GRID`), so reruns agree whatever the order of
tasks, and partial aggregation carries them: a row for each language or script and grid cell.

Defined results: null or empty text has zero counts and null measures, and fails the
basic rules; repeated rows give repeated rows; extra columns are ignored; an empty
table gives no rows; texts of any length are read whole. Words and windows of words are told
apart by 64-bit hashes within a batch.
"""

from __future__ import annotations

import itertools
import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lodestone.llm.common import IS_SPACE, Scratch, gram_hashes, join_groups, mix64, resident, text_bytes, text_id, to_batch, without, word_hashes

SYMBOLS = b"#*$%&|<>"
#: By script: characters per token of the byte-level and of the piece vocabulary (least,
#: most), byte-fallback share (most), share of the expected entropy (least).
BANDS = {
    "LATIN": {"byte_cpt": (1.72, 12.0), "piece_cpt": (1.72, 12.0), "fallback": 0.02, "entropy": 0.45},
    "CYRILLIC": {"byte_cpt": (0.7, 8.0), "piece_cpt": (1.2, 10.0), "fallback": 0.05, "entropy": 0.4},
    "GREEK": {"byte_cpt": (0.6, 8.0), "piece_cpt": (0.8, 10.0), "fallback": 0.1, "entropy": 0.4},
    "CJK": {"byte_cpt": (0.25, 4.0), "piece_cpt": (0.3, 4.0), "fallback": 1.0, "entropy": 0.35},
    "HIRAGANA": {"byte_cpt": (0.25, 4.0), "piece_cpt": (0.3, 4.0), "fallback": 1.0, "entropy": 0.35},
    "OTHER": {"byte_cpt": (0.1, 12.0), "piece_cpt": (0.1, 12.0), "fallback": 1.0, "entropy": 0.3},
}
#: By name, as ties go to the first; the last has no letter.
SCRIPTS = [*sorted(BANDS), None]
_SCRIPT_AT = {name: k for k, name in enumerate(SCRIPTS)}
_LATIN = _SCRIPT_AT["LATIN"]
BELOW, ABOVE, LEAST, GRID, MOST_KEYS = 3.25, 6.0, 30, 1_000, 50_000
#: Bytes of text that are measured at once, or one longer text.
BATCH = 6 << 20
CPT = ("byte_cpt", "piece_cpt")
COUNTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
MEASURES = "script string, n_tokens long, byte_cpt double, piece_cpt double, fallback_share double, entropy double, reason string"


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words."""
    solid = ~IS_SPACE[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def repeated_words(words: np.ndarray, doc: np.ndarray, docs: int, window: int = 5) -> np.ndarray:
    """By document, words covered by a window of ``window`` words that occurs twice or more in it.

    words: hashes, one document after another; doc: the document of each.
    """
    grams = gram_hashes(words, window)
    own = doc[: len(grams)]
    inside = np.flatnonzero(own == doc[window - 1 :]) if len(grams) else np.empty(0, np.int64)
    _, inverse, count = np.unique(mix64(grams[inside] + mix64(own[inside].astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
    at = inside[count[inverse] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=docs)


class WordMeasures:
    """Token measures of words, with a space before each."""

    #: Words of one call; in a call that can't be cut into words they go one by one.
    GROUP = 1_024

    def __init__(self, byte_path: str, piece_path: str, pattern: str):
        import base64

        import sentencepiece
        import tiktoken

        with open(byte_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte = tiktoken.Encoding("fertility", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.leads = np.zeros(max(ranks.values()) + 1, bool)  # tokens that start with a space
        self.leads[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        size = self.piece.vocab_size()
        self.byte_pieces = np.array([self.piece.is_byte(i) for i in range(size)])
        self.piece_leads = np.array([self.piece.id_to_piece(i).startswith("\u2581") for i in range(size)])

    def grouped(self, words: list[str], encode, leads: np.ndarray, before: str) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids one after another, and how many each word has. Words are encoded in one
        call a group, as only the space before a word makes a token start with a space."""
        parts, counts = [], []
        for k in range(0, len(words), self.GROUP):
            group = words[k : k + self.GROUP]
            flat = np.array(encode(before + " ".join(group)), np.int64)
            at = np.flatnonzero(leads[flat])
            if len(at) == len(group) and (not len(at) or at[0] == 0):
                counts.append(np.diff(np.append(at, len(flat))))
            else:
                each = [encode(before + w) for w in group]
                flat = np.array([i for ids in each for i in ids], np.int64)
                counts.append(np.array([len(ids) for ids in each], np.int64))
            parts.append(flat)
        return np.concatenate(parts), np.concatenate(counts)

    def of(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Byte-level ids of all, and of each word: byte-level tokens, pieces, fallback pieces, script."""
        texts = [w.decode("utf-8", "replace") for w in words]
        plain = [t.isascii() for t in texts]
        odd = np.array([not a and (any(map(str.isspace, t)) or w != t.encode()) for w, t, a in zip(words, texts, plain, strict=True)])
        order = np.argsort(odd, kind="stable")  # those that may be cut at white space of their own come last
        back = np.argsort(order, kind="stable")
        script = np.array([_LATIN if a and t[0].isalpha() else _SCRIPT_AT[script_of(t)] for t, a in zip(texts, plain, strict=True)])
        if odd.any():
            texts = [texts[k] for k in order.tolist()]
        ids, tokens = self.grouped(texts, self.byte, self.leads, " ")
        pieces, n_pieces = self.grouped(texts, self.piece.encode, self.piece_leads, "")
        fallback = np.add.reduceat(np.append(self.byte_pieces[pieces], False).astype(np.int64), np.minimum(np.cumsum(n_pieces) - n_pieces, len(pieces))) * (n_pieces > 0)
        first = (np.cumsum(tokens) - tokens)[back]
        tokens = tokens[back]
        ids = ids[np.arange(tokens.sum()) + np.repeat(first - (np.cumsum(tokens) - tokens), tokens)]
        return ids, tokens, np.maximum(n_pieces[back], 1), fallback[back], script


def script_of(word: str) -> str | None:
    """Script of the first letter of a word."""
    for c in word:
        if c.isalpha():
            if c < "ɐ":
                return "LATIN"
            name = unicodedata.name(c, "").split(" ")[0]
            return "HIRAGANA" if name == "KATAKANA" else name if name in BANDS else "OTHER"
    return None


def load(*paths: str) -> WordMeasures:
    return resident(("fertility", *paths), lambda: WordMeasures(*paths))


def line_counts(text: bytes) -> tuple[int, int, int]:
    """Code points in words, symbols, and lines equal to an earlier one."""
    solid = text.translate(None, b" \t\n\v\f\r")
    chars = len(solid) if solid.isascii() else len(solid.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\v\f\r")]
    return chars, symbols, len(lines) - len(set(lines))


def measured(texts: list[bytes], measures: WordMeasures, bands: dict, min_tokens: int) -> list[tuple]:
    """Counts, measures and what the basic rules or the fixed bands find wrong, the bands
    of characters per token last: they count only where the corpus gives none.

    All texts are measured at once; each distinct word is tokenised once.
    """
    docs, whole = len(texts), b"\n".join(texts)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    start, end = word_spans(whole)
    doc = np.searchsorted(begins, start, side="right") - 1
    hashes = word_hashes(whole)
    n_words = np.bincount(doc, minlength=docs)
    repeats = repeated_words(hashes, doc, docs)
    _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    if len(index):
        distinct = [whole[a:b] for a, b in zip(start[index].tolist(), end[index].tolist(), strict=True)]
        ids, tokens, pieces, fallback, script = measures.of(distinct)
        n_tokens, n_pieces, n_fallback = (np.bincount(doc, v[inverse], docs).astype(np.int64) for v in (tokens, pieces, fallback))
        letters = np.bincount(doc * len(SCRIPTS) + script[inverse], minlength=docs * len(SCRIPTS)).reshape(docs, -1)[:, :-1]
        # entropy of a document's tokens, from its distinct words
        pair, times = np.unique(doc * len(index) + inverse, return_counts=True)
        word = pair % len(index)
        length = tokens[word]
        first = (np.cumsum(tokens) - tokens)[word]
        flat = ids[np.arange(length.sum()) + np.repeat(first - (np.cumsum(length) - length), length)]
        token, place = np.unique(np.repeat(pair // len(index), length) * (1 << 32) + flat, return_inverse=True)
        owner = token >> 32
        share = np.bincount(place, np.repeat(times, length)) / n_tokens[owner]
        entropies = np.bincount(owner, -share * np.log2(share), docs)
    out = []
    for k, text in enumerate(texts):
        n, repeat = int(n_words[k]), int(repeats[k])
        counts = (n, *line_counts(text), repeat)
        base_failed = n < 10 or 100 * repeat > 20 * n
        if not n:
            out.append((*counts, base_failed, None, 0, None, None, None, None, "base"))
            continue
        name = SCRIPTS[int(letters[k].argmax())] if letters[k].any() else "OTHER"
        total, entropy = int(n_tokens[k]), float(entropies[k])
        byte_cpt, piece_cpt, share_ = counts[1] / total, counts[1] / int(n_pieces[k]), int(n_fallback[k]) / int(n_pieces[k])
        out.append((*counts, base_failed, name, total, byte_cpt, piece_cpt, share_, entropy, reason_of(base_failed, bands[name], total, byte_cpt, piece_cpt, share_, entropy, min_tokens)))
    return out


def reason_of(base_failed: bool, band: dict, tokens: int, byte_cpt: float, piece_cpt: float, fallback_share: float, entropy: float, min_tokens: int) -> str | None:
    if base_failed:
        return "base"
    if fallback_share > band["fallback"]:
        return "fallback"
    if tokens >= min_tokens and entropy < band["entropy"] * min(math.log2(tokens), 9.0):
        return "entropy"
    if not band["byte_cpt"][0] <= byte_cpt <= band["byte_cpt"][1]:
        return "byte_cpt"
    if not band["piece_cpt"][0] <= piece_cpt <= band["piece_cpt"][1]:
        return "piece_cpt"
    return None


def fertility_report(docs: DataFrame, byte_path: str, piece_path: str, pattern: str, bands: dict | None = None, min_tokens: int = 50, scratch: Scratch | None = None) -> DataFrame:
    """Counts, measures, reason (null: none), kept, and h1, h2 (of the text) per row; see the module text."""
    limits = bands or BANDS
    scratch = scratch or Scratch(docs.sparkSession)

    schema = to_arrow_schema(StructType.fromDDL(f"{COUNTS}, {MEASURES}, lang string, h1 long, h2 long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measures = load(byte_path, piece_path, pattern)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            ids, *rest = (batch.column(k).to_pylist() for k in (0, 2, 3, 4))
            edges = [0]
            held = 0
            for k, t in enumerate(texts, 1):
                held += len(t)
                if held >= BATCH or k == len(texts):
                    edges.append(k)
                    held = 0
            for a, b in itertools.pairwise(edges):
                found = measured(texts[a:b], measures, limits, min_tokens)
                yield to_batch([(i, *f, *more) for i, f, *more in zip(ids[a:b], found, *(r[a:b] for r in rest), strict=True)], schema)

    read = docs.select("doc_id", text_bytes(), F.col("lang").cast("string"), *text_id())
    rows = scratch.table(read.mapInArrow(run, StructType.fromDDL(f"{COUNTS}, {MEASURES}, lang string, h1 long, h2 long")))
    total = rows.count()
    judged = with_band(with_band(rows, "lang", total, 0.5, 1.4826, scratch), "script", total, 0.9, 0.6080, scratch)
    far = F.when(F.col("lang_far").isNotNull(), F.col("lang_far")).otherwise(F.col("script_far"))
    judgement = F.when(far, F.lit("corpus band")).when(far.isNull(), F.col("reason"))
    reason = F.when(left_open(), judgement).otherwise(F.col("reason"))
    columns = [x.split(" ")[0] for x in f"{COUNTS}, {MEASURES}".split(", ")]
    return judged.withColumn("reason", reason).select(*columns, F.col("reason").isNull().alias("kept"), "h1", "h2")


def quantiles(rows: DataFrame, key: str, part: float, size: str, scale: float = 1.0) -> DataFrame:
    """key, ``size`` (rows), and of each measure in `CPT` the least value, in steps of 1 / `GRID`,
    that the share ``part`` of the rows does not exceed, times ``scale``."""
    measures = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.round(F.col(c) * GRID).cast("long").alias("cell")) for c in CPT)))
    cells = rows.select(key, measures.alias("m")).groupBy(key, "m.name", "m.cell").agg(F.count("*").alias("n"))
    by = Window.partitionBy(key, "name")
    upto = cells.withColumn("upto", F.sum("n").over(by.orderBy("cell"))).withColumn("all", F.sum("n").over(by))
    reached = upto.where(F.col("upto") >= F.col("all") * part)
    return reached.groupBy(key).agg(F.max("all").alias(size), *((F.min(F.when(F.col("name") == c, F.col("cell"))) * scale / GRID).alias(f"_{c}") for c in CPT))


def with_band(measured: DataFrame, key: str, total: int, part: float, scale: float, scratch: Scratch) -> DataFrame:
    """Adds ``<key>_far``: whether the characters per token lie too far from those of the
    texts with the same ``key``; null if these give no band. The spread is ``scale`` times
    the quantile ``part`` of the deviations: a high one where a key mixes languages."""
    middle = scratch.table(quantiles(measured.where(left_open() & F.col(key).isNotNull()), key, 0.5, "_n"))
    placed = join_keys(measured, middle.withColumnsRenamed({f"_{c}": f"_{c}_mid" for c in CPT}), key, "_n", total)
    off = {c: (F.col(c) - F.col(f"_{c}_mid")) * F.sqrt("n_tokens") for c in CPT}
    spread = scratch.table(quantiles(placed.where(left_open() & F.col(key).isNotNull()).select(key, *(F.abs(v).alias(c) for c, v in off.items())), key, part, "_texts", scale))
    judged = join_keys(placed, spread.withColumnsRenamed({f"_{c}": f"_{c}_spread" for c in CPT}), key, "_texts", total)
    far, known = F.lit(False), F.col("_texts") >= LEAST
    for c, v in off.items():
        width = F.col(f"_{c}_spread")
        far, known = far | (v < -BELOW * width) | (v > ABOVE * width), known & (width > 0)
    return judged.select(*measured.columns, F.when(known, far).alias(f"{key}_far"))


def join_keys(rows: DataFrame, keys: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join to a table of few rows, or as `join_groups` if they are many."""
    if keys.count() <= MOST_KEYS:
        return rows.join(F.broadcast(keys), key, "left")
    return join_groups(rows, keys, [key], size, total)


def left_open():
    """Rows that the corpus bands judge: nothing else is wrong with them."""
    return F.col("reason").isNull() | F.col("reason").isin(*CPT)


def keep_fertile(docs: DataFrame, *paths: str, **options) -> DataFrame:
    """The rows of ``docs`` that pass, found again by doc_id and 128 bits of the text, so that
    nulls, repeated rows and any names of further columns do no harm."""
    scratch = Scratch(docs.sparkSession)
    report = fertility_report(docs, *paths, scratch=scratch, **options)
    gone = scratch.table(report.where(~F.col("kept")).select("doc_id", "h1", "h2"))
    scratch.keep(gone)
    return without(docs, gone)
