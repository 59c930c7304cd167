"""The pipeline's stages on a small corpus with planted copies and junk."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from lodestone.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def corpus(spark, docs, prose, tmp_path):
    rows = [(k, prose(120, k), "xx", f"s{k % 3}") for k in range(45)]
    rows += [(100, rows[3][1], "xx", "s0"), (101, rows[4][1][:12].upper() + rows[4][1][12:], "xx", "s1")]
    near = rows[7][1].split(" ")
    near[60] = "changed"
    rows += [(102, " ".join(near), "xx", "s2"), (103, "too short", "xx", "s0"), (104, "again and again " * 40, "xx", "s0"), (105, None, None, None)]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    return rows, str(tmp_path)


def test_stages(spark, corpus):
    rows, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs.write.parquet(f"{folder}/{len(kept)}")
        docs = spark.read.parquet(f"{folder}/{len(kept)}")
        kept.append({r.doc_id for r in docs.collect()})
    clean = set(range(45))
    assert kept[0] == clean | {100, 101, 102}
    assert kept[1] == clean - {3, 4} | {100, 101, 102}
    assert kept[2] == clean - {3, 4} | {100, 101}
    words = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    mixed = sum(len(WORD.findall(r.text)) for r in docs.collect())
    assert abs(mixed - 1.5 * sum(words[k] for k in kept[2])) <= 3
    coded = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert len(coded) == docs.count() and all(r.n_tokens == len(r.ids) // 4 > 0 for r in coded)


CLASHES = ("text_hash", "passes", "_copy", "h1", "h2", "_gone_id", "_passes", "digest", "node", "n", "lang_far", "kept", "ranges")


def test_stages_with_odd_rows_and_clashing_columns(spark, docs, prose):
    """Null and repeated ids, repeated rows, empty and null texts; columns come through as they are."""
    one, two, three = (prose(120, k) for k in (50, 51, 52))
    rows = [(1, one), (1, one), (None, one), (1, two), (None, three), (None, three + " end"), (7, None), (8, ""), (9, prose(30_000, 9))]
    rows += [(100 + k, prose(120, k)) for k in range(30)]
    full = docs([(k, t, "xx", "s") for k, t in rows])
    for name in CLASHES:
        full = full.withColumn(name, F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    kept = full
    for _, stage in pipeline.STAGES[:3]:
        kept = stage(spark, kept, "")
        assert kept.columns == full.columns
    got = kept.collect()
    assert all(r[name] == f"{name}{'none' if r.doc_id is None else r.doc_id}" for r in got for name in CLASHES)
    assert sorted((r.doc_id or 0, r.text) for r in got if (r.doc_id or 0) < 100 and r.doc_id != 9) in [sorted([(1, one), (1, two), (0, t)]) for t in (three, three + " end")]
    assert {r.doc_id for r in got} >= {*range(100, 130)}
    mixed = pipeline.STAGES[3][1](spark, full, "")
    assert mixed.columns == full.columns
    out = mixed.collect()
    assert all(r[name] == f"{name}{'none' if r.doc_id is None else r.doc_id}" for r in out for name in CLASHES)
    assert {r.doc_id for r in out} == {k for k, t in rows if t}
    total = sum(len(WORD.findall(t or "")) for _, t in rows)
    assert abs(sum(len(WORD.findall(r.text)) for r in out) - 1.5 * total) <= 1
    assert pipeline.STAGES[4][1](spark, full, "").count() == len(rows)


def test_run(spark, corpus):
    out = pipeline.run(spark, corpus[1])
    assert {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"} <= set(out.columns) and out.count() > 0
    assert pipeline.ORACLE_SQL is None and 4 <= len(pipeline.STAGES) <= 5


def test_empty(spark, docs, tmp_path):
    docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
