import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import common


def test_word_hashes_agree_with_split():
    r = random.Random(1)
    for _ in range(200):
        text = "".join(r.choice(["a", "bc", " ", "\n", "\x0b", "é", "\x1c", " "]) for _ in range(40)).encode()
        words = text.split()
        hashes = common.word_hashes(text)
        assert len(hashes) == len(words)
        seen = {}
        assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes.tolist(), strict=True))
        assert len(set(seen.values())) == len(seen)


def test_word_hashes_in_chunks(monkeypatch):
    text = b" ".join(str(k % 37).encode() for k in range(500))
    whole = common.word_hashes(text)
    monkeypatch.setattr(common, "_CHUNK", 11)
    assert np.array_equal(whole, common.word_hashes(text))


def test_grams():
    words = common.word_hashes(b"a b c a b c b")
    grams = common.gram_hashes(words, 3)
    assert len(grams) == 5 and grams[0] == grams[3] and len(set(grams.tolist())) == 4
    assert len(common.gram_hashes(words[:2], 3)) == 0


def test_running_sum(spark):
    rows = [(k % 2, k, k * k) for k in range(60)]
    df = common.running_sum(spark.createDataFrame(rows, "g int, o long, v long"), ["g"], "o", "v", "s", chunk=7)
    for r in df.collect():
        assert r.s == sum(v for g, o, v in rows if g == r.g and o < r.o)


def test_numbered(spark):
    df = common.numbered(spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (1, "a"), (2, "a")], "k int, t string"), ["k", "t"])
    assert sorted(((r.k or 0), r.copy, r.copies) for r in df.collect()) == [(0, 0, 1), (1, 0, 3), (1, 1, 3), (1, 2, 3), (2, 0, 1)]


def test_numbered_in_runs(spark):
    df = common.numbered(spark.createDataFrame([(k % 2,) for k in range(41)], "k int"), ["k"], run=6)
    assert sorted((r.k, r.copy) for r in df.collect()) == [(k, n) for k, m in ((0, 21), (1, 20)) for n in range(m)]


def test_join_groups_with_a_hot_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    groups = rows.where("k != 1").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    out = common.join_groups(rows, groups, ["k"], "n", 5000).collect()
    assert len(out) == 5000
    assert {r.top for r in out if r.k == 0} == {4998}
    assert [r.top for r in out if r.k == 1] == [None]
    assert all(r.top == r.id for r in out if r.k > 1)


def test_scratch_tables_are_deleted(spark):
    import os

    scratch = common.Scratch(spark)
    first = scratch.table(spark.range(10))
    second = scratch.table(first.groupBy((F.col("id") % 3).alias("k")).count(), drop=[first])
    paths = [p for _, p in scratch.paths.values()]
    assert len(paths) == 1 and second.count() == 3 and os.path.exists(paths[0])
    scratch.keep()
    assert not os.path.exists(paths[0]) and spark.conf.get(common.CLEANUP) == "false"


def test_fresh_names(spark):
    df = spark.range(1).withColumn("_a", F.lit(1)).withColumn("__A", F.lit(1))
    assert common.fresh(df, "_a", "b") == ["___a", "b"]


def test_without_matches_nulls(spark):
    df = spark.createDataFrame([(1, "a", 5), (None, "a", 5), (1, None, 5), (None, None, 5), (1, "a", 6)], "doc_id long, text string, h1 int")
    h1, h2 = common.text_id()
    keys = spark.createDataFrame([(None, "a"), (1, None)], "doc_id long, text string").select("doc_id", h1.alias("h1"), h2.alias("h2"))
    left = common.without(df, keys)
    assert left.columns == df.columns and sorted((r.doc_id or 0, r.text or "", r.h1) for r in left.collect()) == [(0, "", 5), (1, "a", 5), (1, "a", 6)]


def test_resident_keeps_one():
    made = []
    for key in ("a", "a", "b", "a"):
        assert common.resident((key,), lambda: made.append(key) or key) == key
    assert made == ["a", "b", "a"]


def test_cache_generations():
    made = []
    cache = common.TwoGenerations(lambda k: made.append(k) or k.upper(), 2)
    assert [cache[k] for k in "abac"] == ["A", "B", "A", "C"]
    assert cache["a"] == "A" and made == ["a", "b", "c"]  # from the old generation
    assert len(cache) <= 2


@pytest.mark.parametrize("doc_id", [0, 7, None])
def test_key_mod(spark, doc_id):
    import zlib

    got = spark.createDataFrame([(doc_id,)], "doc_id long").select(common.key_mod(4)).first()[0]
    assert got == zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4


def test_join_tasks_release_what_other_stages_keep():
    """A worker process outlives its stage: the join's tasks must not hold a tokenizer beside their arrays."""
    from lodestone.llm import jaccard_join

    class Taken(Exception):
        pass

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, f, schema):  # noqa: N802
            raise Taken(f)

    with pytest.raises(Taken) as taken:
        jaccard_join.live_cells(Rows(), 4, 80)
    common.resident(("vocabulary",), lambda: [0] * 1000)
    assert list(taken.value.args[0](iter(()))) == []
    assert not common._RESIDENT
    assert common.resident(("vocabulary",), lambda: "made anew") == "made anew"
    common.released()
