import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lodestone.llm import mixing, sharding
from lodestone.llm.common import Scratch
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sharded(docs, rows, shards):
    out = sharding.shard_documents(docs(rows, extra=True), shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in rows)
    slots = defaultdict(list)
    for r in out:
        assert (r.law, r.grown_shard) == ("rows", None) and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    return out


@pytest.mark.parametrize(("n", "shards"), [(0, 3), (1, 3), (2, 3), (41, 40), (1000, 7)])
def test_law(docs, n, shards):
    sharded(docs, [(k, f"text {k}") for k in range(n)], shards)


def test_odd_and_repeated_rows(docs):
    sharded(docs, [(k, t) for k, t in enumerate(ODD)] + [(None, None), (None, "a"), (1, "x"), (1, "x"), (1, "x")], 4)


def test_several_buckets_and_scatter(docs):
    rows = docs([(k, "same" if k % 3 == 0 else str(k)) for k in range(3000)])

    def at(seed):
        return sorted((r.record.doc_id, r.shard, r.slot) for r in sharding.placed(rows, 10, seed, Scratch(rows.sparkSession), bucket_rows=100).collect())

    out = at(1)
    assert [k for k, *_ in out] == list(range(3000)) and {s for k, s, _ in out if k < 100} == set(range(10))
    hot = Counter(s for k, s, _ in out if k % 3 == 0)
    assert all(60 < hot[s] < 140 for s in range(10))
    assert out == at(1) != at(5)


def test_repeated_records_are_scattered(docs):
    rows = docs([(1, "again")] * 1000 + [(k, f"t{k}") for k in range(10, 1010)])
    shards = Counter(r.shard for r in sharding.placed(rows, 10, 1, Scratch(rows.sparkSession), bucket_rows=50).collect() if r.record.doc_id == 1)
    assert sum(shards.values()) == 1000 and all(50 < shards[s] < 150 for s in range(10))


def test_writing_keeps_any_columns(spark, docs, tmp_path):
    rows = docs([(1, "a"), (1, "a"), (None, None)] + [(k, str(k)) for k in range(10, 30)])
    for name in ("mark", "bucket", "copy", "_id", "record", "first", "at"):
        rows = rows.withColumn(name, F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("slot", F.lit(-1))
    sharding.write_shards(rows, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*rows.columns, "shard"} and -1 not in {r.slot for r in back.collect()}
    same = [c for c in rows.columns if c != "slot"]
    assert Counter(map(tuple, back.select(same).collect())) == Counter(map(tuple, rows.select(same).collect()))


def test_write(spark, docs, tmp_path):
    sharding.write_shards(docs([(k, f"t{k}") for k in range(50)]), str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and Counter(r.shard for r in back.collect()) == {k: 10 for k in range(5)}


def water(sizes, weights, share=1.5, cap=2.0):
    """Targets by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, full, left = dict.fromkeys(order, 0.0), set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        total = sum(weight[s] for s in free)
        if not free:
            return target
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            full.add(s)
            left -= target[s]


def mixed(docs, rows):
    out = mixing.mix_report(docs(rows, extra=True)).collect()
    size = {k: len(WORD.findall(t or "")) for k, t, *_ in rows}
    by = defaultdict(int)
    for _, t, _, s in rows:
        by[s] += len(WORD.findall(t or ""))
    targets = water(by, (3, 1, 2))
    source, taken = {k: s for k, _, _, s in rows}, defaultdict(int)
    assert Counter((r.doc_id, r.size) for r in out) == Counter((k, len(WORD.findall(t or ""))) for k, t, *_ in rows)
    for r in out:
        assert r.source_size == by[source[r.doc_id]]
        assert r.target == pytest.approx(targets[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * size[r.doc_id]
        taken[source[r.doc_id]] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 0.5 + 1e-6
    return out


def test_mix(docs, prose):
    r = random.Random(1)
    rows = [(k, prose(r.choice([0, 1, 40, 300, 900]), k), None, r.choice(["a", "b", "b", "b", "ä", None, "Z"])) for k in range(150)]
    first = mixed(docs, rows)
    assert sorted(first) == sorted(mixing.mix_report(docs(rows)).collect())


def test_mix_of_odd_rows(docs):
    mixed(docs, [(k, t, None, "s" if k % 2 else None) for k, t in enumerate(ODD)])
    mixed(docs, [(1, None, None, "a"), (2, "", None, "b")])
    assert mixing.mix_report(docs([])).collect() == []
    assert mixing.mixed_documents(docs([])).collect() == []


def test_repeated_rows_take_their_own_parts(docs, prose):
    text = prose(700, 1)
    out = mixing.mix_report(docs([(1, text, None, "a")] * 3 + [(2, prose(400, 2), None, "b")])).collect()
    assert len(out) == 4 and all(r.taken <= 2 * r.size for r in out)
    assert sum(r.taken for r in out if r.doc_id == 1) == round(next(r.target for r in out if r.doc_id == 1))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1001])
def test_permutation(spark, n):
    key = [F.lit(5), F.lit(1)]
    df = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n).cast("long"), *key).alias("p"))
    rows = df.select("id", "p", mixing.permuted(F.col("p"), F.lit(n).cast("long"), *key, back=True).alias("q")).collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.q == r.id for r in rows)


def test_slots_of_shards_are_near_the_shares(docs, prose):
    rows = [(k, prose(3000, k), None, "abc"[k % 3]) for k in range(120)]
    _, sources, slots = mixing.plan(docs(rows))
    total = sum(r.n_slots for r in sources.collect())
    share = {r.sid: r.n_slots / total for r in sources.collect()}
    full = Counter((r.shard, r.sid) for r in slots.collect())
    per = Counter(r.shard for r in slots.collect())
    assert sum(per.values()) == total and all(v == mixing.SLOTS for s, v in per.items() if s != max(per))
    for (shard, sid), n in full.items():
        if per[shard] == mixing.SLOTS:
            assert abs(n / mixing.SLOTS - share[sid]) < 0.12
    used = Counter((r.sid, r["pass"], r.block) for r in slots.collect())
    assert set(used.values()) == {1}


def test_mixed_texts(docs, prose):
    rows = [(k, prose(500, k), "en", "ab"[k % 2]) for k in range(30)] + [(99, "two  words", None, None)]
    taken = {r.doc_id: r.taken for r in mixing.mix_report(docs(rows)).collect()}
    text, got = {k: t for k, t, *_ in rows}, defaultdict(int)
    out = mixing.mixed_documents(docs(rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    for r in out.collect():
        words, all_ = WORD.findall(r.text), WORD.findall(text[r.doc_id])
        got[r.doc_id] += len(words)
        assert r.n_chars == len(r.text) and (len(words) < len(all_) or r.text == text[r.doc_id])
        assert not Counter(words) - Counter(all_)
    assert {k: v for k, v in taken.items() if v} == dict(got)


def test_report_is_that_of_the_written_shards(spark, docs, tmp_path):
    rows = docs([(k, f"text {k} " * (k % 50)) for k in range(300)])
    sharding.write_shards(rows, str(tmp_path / "out"), 7)
    back = {(r.doc_id, r.shard, r.slot) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert back == {(r.doc_id, r.shard, r.slot) for r in sharding.shard_documents(rows, 7).collect()}
