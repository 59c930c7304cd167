import random
import re

import numpy as np
import pytest

from lodestone.llm import components as links_module
from lodestone.llm import jaccard_join
from lodestone.llm.common import Scratch
from lodestone.llm.components import connected_components
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(zip(*(w[k:] for k in range(size)), strict=False)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def components(rows, size, percent):
    sets = [(k, shingles(t, size)) for k, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    out = {}
    for i, (k, s) in enumerate(sets):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.setdefault((k, len(s), min(ids) if ids else None), 0)
        out[k, len(s), min(ids) if ids else None] += 1
    return out


def check(docs, rows, size=3, percent=90):
    got = {}
    for r in jaccard_join.link_components(docs(rows, extra=True), size, percent).collect():
        got[r.doc_id, r.n_shingles, r.component_id] = got.get((r.doc_id, r.n_shingles, r.component_id), 0) + 1
    assert got == components(rows, size, percent)


def edited(text, r, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return " ".join(words)


def test_odd_rows(docs):
    check(docs, [*enumerate(ODD), (3, "the end"), (3, "the end"), (None, "THE END"), (None, "lonely words here"), (70, "a b"), (71, "a b"), (72, "b a")])
    assert jaccard_join.link_components(docs([])).collect() == []


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_near_copies(docs, prose, size, percent):
    r = random.Random(7)
    rows = []
    for g in range(12):
        base = prose(r.choice([12, 40, 120, 400]), g)
        rows += [(len(rows) + k, edited(base, r, r.randrange(1 + len(base.split()) // 25))) for k in range(r.randrange(1, 9))]
    shared = prose(60, 99)
    rows += [(1000 + k, f"{prose(50, 200 + k)} {shared} {prose(30, 300 + k)}") for k in range(10)]
    r.shuffle(rows)
    check(docs, rows, size, percent)


def test_a_cell_of_several_leaves(docs, prose):
    """More members than a leaf holds, in components that only some pairs join."""
    r = random.Random(9)
    base = prose(60, 5)
    rows = [(k, edited(base, r, r.choice([0, 1, 1, 2]))) for k in range(2 * jaccard_join.LEAF + 40)]
    check(docs, rows)


@pytest.mark.parametrize("each", [0, 32])
def test_trees_of_several_levels(docs, prose, monkeypatch, each):
    """Pairs of large cells in rounds, and all at once."""
    for name, value in (("SMALL", 4), ("LEAF", 4), ("FAN", 3), ("EACH", each)):
        monkeypatch.setattr(jaccard_join, name, value)
    r = random.Random(11)
    bases = [prose(40, 5), prose(45, 6)]
    rows = [(k, edited(bases[k % 2], r, r.choice([1, 2, 3, 5]))) for k in range(90)]
    check(docs, rows, 2, 80)


def test_packed_entries(monkeypatch):
    r = np.random.default_rng(1)
    rows = np.zeros(50, jaccard_join.ENTRY)
    rows["token"], rows["node"], rows["at"], rows["more"] = r.integers(0, 1 << 48, 50), r.integers(-5, 5, 50), r.integers(0, 65_535, 50), r.integers(0, 2, 50)
    rows["n"] = rows["node"] + 9
    assert np.array_equal(jaccard_join.unpacked_entries(jaccard_join.packed_entries(rows)), rows)
    order = r.integers(0, 1 << 63, 9).astype(np.uint64)
    assert np.array_equal(jaccard_join.unpacked_prefix(jaccard_join.packed_prefix(order)), order >> np.uint64(16))
    for top in (9, 300, 70_000):
        counts = np.arange(jaccard_join.GROUPS) % 7 + top - 8
        assert np.array_equal(jaccard_join.unpacked(jaccard_join.packed(counts)), counts)


def test_shards_in_passes(docs, prose, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PASS", 50)
    monkeypatch.setattr(jaccard_join, "BATCH", 60)
    r = random.Random(13)
    check(docs, [(k, edited(prose(40, k // 6), r, 1)) for k in range(40)])


def test_chain(docs):
    words = [f"v{k}" for k in range(80)]
    rows = [(100 - k, " ".join(words[k : k + 60])) for k in range(20)]
    check(docs, rows)


def test_bound_never_prunes_links():
    for a, b in [(10, 10), (10, 11), (19, 20), (100, 111)]:
        need = jaccard_join.least_common(a, b, 90)
        assert all((100 * c >= 90 * (a + b - c)) == (c >= need) for c in range(min(a, b) + 1))


def test_components(spark):
    scratch = Scratch(spark)
    r = random.Random(2)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 360)] + [(5, 5)]
    up = {x: x for pair in links for x in pair}
    for _ in range(400):
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    got = connected_components(spark.createDataFrame(links, "a long, b long"), scratch).collect()
    single = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert {x.node: x.comp for x in got} == {k: v for k, v in up.items() if k not in single}
    assert connected_components(spark.createDataFrame([], "a long, b long"), scratch).collect() == []


def test_keep_one(docs, prose):
    base = prose(100, 1)
    rows = [(5, base), (3, "".join(c.upper() if c.isascii() else c for c in base)), (9, prose(50, 2)), (None, ""), (8, base + " x")]
    assert sorted(r.doc_id or 0 for r in jaccard_join.keep_one(docs(rows)).collect()) == [0, 3, 9]


def test_keep_one_with_null_and_repeated_ids(docs, prose):
    a, b, c = (prose(100, k) for k in (1, 2, 3))
    rows = [(1, a), (7, a + " x"), (7, b), (None, a + " y"), (None, c), (None, c + " z")]
    out = [(r.doc_id, r.text) for r in jaccard_join.keep_one(docs(rows)).collect()]
    assert (1, a) in out and (7, b) in out and len(out) == 3
    assert sum(r in ((None, c), (None, c + " z")) for r in out) == 1


def test_few_links_take_no_rounds_of_joins(spark, monkeypatch):
    """Few links go through two tables, whatever their paths; joins find the same."""
    links = [(k, k + 1) for k in range(40)] + [(k, k - 3) for k in range(100, 160, 3)] + [(7, 7), (None, 3), (9, 8), (8, 9)]
    df = spark.createDataFrame(links, "a long, b long")
    scratch = Scratch(spark)
    here = {tuple(r) for r in connected_components(df, scratch).collect()}
    assert scratch.written == 2
    assert {c for k, c in here if k <= 40} == {0} and {c for k, c in here if k > 40} == {97}
    monkeypatch.setattr(links_module, "LOCAL", 0)
    assert {tuple(r) for r in connected_components(df, Scratch(spark)).collect()} == here


def test_links_beyond_the_drivers_arrays(docs, prose, monkeypatch):
    monkeypatch.setattr(links_module, "LOCAL", 0)
    r = random.Random(21)
    check(docs, [(k, edited(prose(40, k // 8), r, 1)) for k in range(48)])


def test_one_node_with_pairs_in_several_parts(docs, prose):
    base = prose(80, 3).split(" ")
    check(docs, [(0, " ".join(base))] + [(k, " ".join([*base, f"z{k}"])) for k in range(1, 320)])


def test_few_pairs_of_many_members_take_one_tree(docs, prose, monkeypatch):
    """Large cells whose points leave few pairs are tried at once, not in rounds."""
    for name, value in (("SMALL", 4), ("LEAF", 4), ("FAN", 3), ("EACH", 3)):
        monkeypatch.setattr(jaccard_join, name, value)
    trees, make = [], jaccard_join.tree_of
    monkeypatch.setattr(jaccard_join, "tree_of", lambda *a: trees.append(a) or make(*a))
    r = random.Random(11)
    base = prose(60, 5)
    check(docs, [(k, edited(base, r, r.choice([1, 2, 3, 5]))) for k in range(90)])
    assert len(trees) == 1


def test_few_links_merge_in_one_table(spark, monkeypatch):
    """Further links of few nodes go through the driver's arrays; joins find the same."""
    first = spark.createDataFrame([(1, 1), (4, 1), (5, 5), (9, 5), (20, 20), (30, 20)], "node long, comp long")
    links = spark.createDataFrame([(4, 9), (2, 30), (40, 41), (40, 41)], "a long, b long")
    scratch = Scratch(spark)
    here = {tuple(r) for r in links_module.merged(first, links, scratch).collect()}
    assert scratch.written == 1
    assert here == {(1, 1), (4, 1), (5, 1), (9, 1), (2, 2), (20, 2), (30, 2), (40, 40), (41, 40)}
    monkeypatch.setattr(links_module, "LOCAL", 0)
    assert {tuple(r) for r in links_module.merged(first, links, Scratch(spark)).collect()} == here


def test_point_pairs_say_how_many_they_leave_out():
    r = np.random.default_rng(3)
    block = np.zeros(30, jaccard_join.MEMBER)
    block["node"], block["comp"] = np.arange(30), r.integers(0, 12, 30)
    block["counts"] = r.integers(0, 3, (30, jaccard_join.GROUPS)) + 4
    block["n"] = block["room"] = block["counts"].sum(1)
    a, b = block[:14], block[14:]
    for one, two, own in ((a, b, False), (block, block, True)):
        every = {}
        for x in one:
            for y in two:
                bound = int(np.minimum(x["counts"], y["counts"]).sum())
                if x["comp"] != y["comp"] and x["node"] < y["node"] and bound >= jaccard_join.least_common(int(x["n"]), int(y["n"]), 78):
                    every.setdefault(int(x["node"]), []).append((-bound, int(y["node"])))
        count = sum(map(len, every.values()))
        got, more = jaccard_join.point_pairs(one, two, own, 78, None)
        assert sorted(got) == sorted((x, y) for x, near in every.items() for _, y in near) and more == 0
        got, more = jaccard_join.point_pairs(one, two, own, 78, 2)
        assert sorted(got) == sorted((x, y) for x, near in every.items() for _, y in sorted(near)[:2]) and more == count - len(got) > 0
