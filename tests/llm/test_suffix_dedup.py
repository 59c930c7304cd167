import hashlib
import random

import numpy as np
import pytest

from lodestone.llm import induced_sort, suffix_dedup
from tests.llm.conftest import ODD


def order(text, cap):
    n, t = len(text), text.tolist()
    sa = sorted(range(n), key=lambda i: t[i:])
    lcp = [0]
    for a, b in zip(sa, sa[1:], strict=False):
        k = 0
        while k < cap and a + k < n and b + k < n and t[a + k] == t[b + k]:
            k += 1
        lcp.append(k)
    return sa, lcp


def suffixes(text, *options):
    parts = list(induced_sort.suffix_order(text, *options))
    return [np.concatenate([p[k] for p in parts]).tolist() for k in (0, 1)]


@pytest.mark.parametrize("memory", [24, 1 << 20])
@pytest.mark.parametrize("base", [0, 1 << 20])
@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_induced_sort(monkeypatch, memory, base, chunk):
    monkeypatch.setattr(induced_sort, "CHUNK", chunk)
    r = random.Random(1)
    for turn in range(200):
        n, kinds = r.randint(1, 70), r.choice([1, 2, 3, 10])
        text = [r.randint(1, kinds) for _ in range(n)]
        text = (text[:7] * 11)[:n] if turn % 3 == 0 else text
        text = np.array([*text, 0], np.uint8 if turn % 2 else np.int64)
        assert tuple(suffixes(text, 200, memory, base)) == order(text, 200)


def test_capped_prefixes_group_alike():
    r = random.Random(2)
    piece = [r.randint(1, 3) for _ in range(60)]
    text = np.array([*piece, 1, 2, *piece, 3, *piece, 0])
    sa, lcp = suffixes(text, 20)
    assert sorted(sa) == list(range(len(text)))
    for k in range(1, len(text)):
        a, b = text[sa[k - 1] :][:20], text[sa[k] :][:20]
        same = len(a) == len(b) == 20 and (a == b).all()
        assert (lcp[k] >= 20) == same


def test_queue_spills():
    queue = induced_sort.BucketQueue(64)
    for k in range(20):
        queue.push(k % 3, np.array([k, k + 100]), np.array([1, 2], np.int32))
    assert queue.written
    parts = list(queue.pop(1))
    assert np.concatenate([p for p, _ in parts]).tolist() == [v for k in range(1, 20, 3) for v in (k, k + 100)]
    assert not list(queue.pop(1))
    queue.close()


def test_spool_reads_back():
    spool, r = induced_sort.Spool(100), np.random.default_rng(1)
    pos, lcp = np.arange(60), r.integers(0, 9, 60).astype(np.int32)
    for at in range(0, 60, 7):
        spool.append(pos[at : at + 7], lcp[at : at + 7])
    assert spool.written and np.array_equal(np.concatenate([p for p, _ in spool.forth()]), pos)
    back = list(spool.back())
    assert np.array_equal(np.concatenate([p for p, _ in back]), pos[::-1])
    assert np.array_equal(np.concatenate([c for _, c in back])[1:], lcp[:0:-1])


def test_a_shard_beyond_memory(monkeypatch):
    """Queues spill, names recurse, and what is held stays below one array of tuples."""
    import tracemalloc

    monkeypatch.setattr(induced_sort, "CHUNK", 1024)
    r = np.random.default_rng(3)
    words = [bytes(r.integers(97, 123, r.integers(2, 8)).astype(np.uint8)) for _ in range(20)]
    text = np.frombuffer(b" ".join(words[k] for k in r.integers(0, 20, 25_000)) + b"\0", np.uint8)
    sa, lcp = map(np.array, suffixes(text, 56))
    memory, depth, seen = 1 << 14, [], 0
    tracemalloc.start()
    level = induced_sort.Inducer(text, 56, memory)
    for pos, low, _ in level.induce(induced_sort.ordered_minima(level, 12_000, depth)):
        assert np.array_equal(low, lcp[seen : seen + len(low)])
        seen += len(pos)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == len(text) and depth and level.spilled > 100 * memory
    assert peak < 16 * len(text)


def segment_values(bodies, ords, length):
    """For each window of each segment the smallest id of the segments that have it."""
    first = {}
    for body, k in zip(bodies, ords, strict=True):
        for i in range(len(body) - length + 1):
            first[body[i : i + length]] = min(first.get(body[i : i + length], k), k)
    return [[first[b[i : i + length]] for i in range(len(b) - length + 1)] for b in bodies]


@pytest.mark.parametrize(("memory", "block"), [(64, 50), (1 << 20, 1 << 20), (500, 1000)])
def test_profiles_in_bounded_memory(monkeypatch, memory, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    r = random.Random(4)
    base = bytes(r.choice(b"abc") for _ in range(60))
    bodies = []
    for _ in range(120):
        at = r.randrange(30)
        body = bytearray(base[at : at + r.randrange(10, 30)])
        body[r.randrange(len(body))] = r.choice(b"abcx")
        bodies.append(bytes(body))
    ords, length = [r.randrange(50) for _ in bodies], 8
    last = np.full(len(bodies), 60)
    text = np.frombuffer(b"\1".join(bytes(c + 2 for c in b) for b in bodies) + b"\1\0", np.uint8)
    got = {}
    for k, packed in suffix_dedup.profiles_by_segment(text, np.array([len(b) for b in bodies]), np.array(ords), last, length, memory):
        at, values = 0, []
        for end, least in np.frombuffer(packed, "<i8").reshape(-1, 2).tolist():
            values += [least] * (end - at)
            at = end
        got[k] = values
    assert got == dict(enumerate(segment_values(bodies, ords, length)))


def test_anchors_are_the_same_in_equal_windows(monkeypatch):
    r = random.Random(3)
    shared = bytes(r.choice(b"abcd ") for _ in range(90))
    one, two = bytes(r.choice(b"xyz") for _ in range(33)) + shared, shared + bytes(r.choice(b"uvw") for _ in range(41))

    def at(text):
        start, value = suffix_dedup.anchors(text, 50)
        return np.repeat(value, np.diff(np.append(start, len(text) - 49)))

    assert np.array_equal(at(one)[33:74], at(two)[:41])
    whole = at(one)
    monkeypatch.setattr(suffix_dedup, "PIECE", 7)
    assert np.array_equal(whole, at(one))
    assert len(suffix_dedup.anchors(b"short", 50)[0]) == 0


def brute(rows, length):
    far = suffix_dedup.LAST
    first = {}
    for k, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            g = b[i : i + length]
            first[g] = min(first.get(g, far), far if k is None else k)
    out = []
    for k, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (far if k is None else k):
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        out.append((-1 if k is None else k, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def check(docs, rows, **options):
    out = suffix_dedup.dedup_substrings(docs(rows, extra=True), **options).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, *tuple(r)[1:]) for r in out) == brute(rows, options.get("length", 50))


def test_odd_rows(docs):
    long = "é" * 60
    check(docs, [*enumerate(ODD), (20, "A" * 49), (21, "A" * 50), (22, "A" * 5000), (5, "other text with the same id " * 4), (None, long), (30, long), (None, long), (31, long), (31, long)])
    assert suffix_dedup.dedup_substrings(docs([])).collect() == []


def test_shared_passages(docs, prose):
    r = random.Random(5)
    passages = [prose(14, 900 + k) for k in range(6)]
    rows = []
    for k in range(90):
        parts = [prose(r.randrange(1, 30), k * 10 + j) if r.random() < 0.6 else r.choice(passages)[r.randrange(4) :] for j in range(4)]
        rows.append((k, " ".join(parts)))
    rows += [(100 + k, rows[k][1]) for k in range(0, 20, 3)] + [(200, rows[3][1][: len(rows[3][1]) // 2])]
    r.shuffle(rows)
    check(docs, rows)


@pytest.mark.parametrize("hot", [3, 4_000])
def test_hot_anchors_and_small_shards(docs, prose, monkeypatch, hot):
    """One phrase with many contexts, whose anchors are split, and many shards."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SLICE", 5)
    phrase = prose(12, 77)[:56]
    rows = [(k, f"{prose(2, k % 9)} {phrase} {prose(2, 500 + k % 7)} {prose(3, k)}") for k in range(60)] + [(70, "ab" * 90), (71, "x" + "ab" * 80), (72, "=" * 300), (73, "= " + "=" * 120)]
    check(docs, rows, shard_bytes=500)


def test_left_over_texts(docs, prose):
    a, b = prose(40, 1), prose(40, 2)
    rows = [(1, a), (2, f"{b} {a} end"), (3, a), (4, None)]
    got = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.deduped_texts(docs(rows)).collect()}
    assert got[1] == a and got[3] == "" and got[4] == ""
    assert got[2] == f"{b} {a} end".replace(a, "")


@pytest.mark.parametrize("size", [1, 63, 64, 65, 1 << 20, (1 << 20) + 1, 3_000_000])
def test_ranks_agree_with_bisection(size):
    rng = np.random.default_rng(size)
    places = np.unique(rng.integers(0, size, size // 3 + 1))
    pos = np.concatenate((rng.integers(0, size + 1, 1_000), [0, size]))
    assert np.array_equal(induced_sort.Ranks(places, size).below(pos), np.searchsorted(places, pos))


def test_names_are_sorted_by_no_more_than_decide(monkeypatch):
    """A name has two characters at least, so 28 of them tell suffixes apart up to a cap of 56."""
    sorts = []
    argsort = np.argsort
    monkeypatch.setattr(induced_sort.np, "argsort", lambda *a, **b: sorts.append(1) or argsort(*a, **b))
    names = np.append(np.tile([3, 1, 2], 1_000), 0)
    order = induced_sort.doubled(names, 56)
    assert len(sorts) == 5
    keys = [names[k : k + 28].tolist() for k in order]
    assert keys == sorted(keys)
