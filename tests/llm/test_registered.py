"""The queries as they are registered, over the smallest tables, against plain Python."""

import hashlib
import os
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest

from lodestone.llm import queries
from tests.llm.test_fertility import brute
from tests.llm.test_sharding_mixing import WORD, water

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def rows():
    return {r["doc_id"]: r for r in pq.read_table(f"{DATA}/documents.parquet").to_pylist()}


def run(spark, name):
    out = queries.queries()[name](spark, DATA).collect()
    return {r.doc_id: r for r in out}


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_op1(spark, rows):
    out = run(spark, "op1_quality_rules")
    for doc_id, r in out.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(rows[doc_id]["text"] or "")
        assert not (r.base_failed and r.kept)
    assert out.keys() == rows.keys() and 0.5 < np.mean([r.kept for r in out.values() if not r.base_failed]) < 1


def test_op3(spark, rows):
    out = run(spark, "op3_language_id")
    assert out.keys() == rows.keys() and all(r.held_out == (remainder(k, 4) == 2) and 0 <= r.score <= 1 for k, r in out.items())
    judged = [(r.lang_pred, rows[k]["lang"]) for k, r in out.items() if r.held_out and rows[k]["lang"] and r.lang_pred != "und"]
    assert np.mean([a == b for a, b in judged]) > 0.9


def test_op4(spark, rows):
    out = run(spark, "op4_sharding")
    slots = defaultdict(list)
    for k, r in out.items():
        text = (rows[k]["text"] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(40)]
    assert out.keys() == rows.keys() and max(sizes) - min(sizes) <= 1


def test_op5(spark, rows):
    out = run(spark, "op5_mixing")
    size = {k: len(WORD.findall(r["text"] or "")) for k, r in rows.items()}
    by = Counter()
    for k, r in rows.items():
        by[r["source"]] += size[k]
    targets, taken = water(by, (3, 1, 2)), Counter()
    for k, r in out.items():
        source = rows[k]["source"]
        assert r["size"] == size[k] and r.source_size == by[source] and r.target == pytest.approx(targets[source]) and 0 <= r.taken <= 2 * size[k]
        taken[source] += r.taken
    assert out.keys() == rows.keys() and all(abs(taken[s] - t) <= 1 for s, t in targets.items())


def test_op6(spark, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    out = run(spark, "op6_bpe_codec")
    for k, r in out.items():
        ids = t.encode(rows[k]["text"] or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert out.keys() == rows.keys()


def test_op10(spark, rows):
    out = run(spark, "op10_quality_classifier")
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{DATA}/labels.parquet").to_pylist()}
    assert out.keys() == rows.keys() and all(r.held_out == (remainder(k, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for k, r in out.items())
    assert np.mean([out[k].predicted == q for k, q in labels.items() if remainder(k, 3) != 1 and k in out]) > 0.8
