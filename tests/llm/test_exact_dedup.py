import hashlib
import random

from lodestone.llm import exact_dedup
from tests.llm.conftest import ODD

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(LOW), []).append(doc_id)
    out = {}
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            out.setdefault((i, hashlib.sha256(text.encode()).hexdigest()), []).append((max(known) if known else None, len(ids)))
    return out


def check(docs, rows):
    got, kept = {}, {}
    for r in exact_dedup.exact_groups(docs(rows, extra=True), digest_all=True).collect():
        got.setdefault((r.doc_id, r.digest.hex()), []).append((r.keep_id, r.group_size))
        kept[r.digest] = kept.get(r.digest, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert got == brute(rows)
    assert set(kept.values()) <= {1}


def test_odd_rows(docs):
    check(docs, [(k, t) for k, t in enumerate(ODD)] + [(3, "THE end"), (3, "THE end"), (None, "the end"), (None, None), (50, "É"), (51, "é")])


def test_random_rows(docs):
    r = random.Random(1)
    check(docs, [(k, "".join(r.choice("aAbé") for _ in range(r.randint(0, 3))) + "tail" * 30 + r.choice("xyz")) for k in range(300)])


def test_hot_group(docs):
    check(docs, [(k, "same text" if k % 3 == 0 else f"text {k}") for k in range(3000)])


def test_digests_only_of_survivors(docs):
    out = {r.doc_id: r.digest for r in exact_dedup.exact_groups(docs(["one", "two!", "three", "THREE"])).collect()}
    assert out[0] is None and out[1] is None and out[2] == out[3] == hashlib.sha256(b"three").digest()


def test_keep(docs):
    rows = [(1, "a"), (2, "A"), (2, "A"), (3, "b"), (None, "c"), (None, "c")]
    out = exact_dedup.keep_exact(docs(rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "c"), (2, "A"), (3, "b")]
    assert exact_dedup.exact_groups(docs([])).collect() == []


def test_keep_with_null_and_repeated_ids(docs):
    rows = [(5, "same"), (None, "Same"), (7, "other"), (7, "lost one"), (9, "LOST one"), (None, "c"), (None, "C")]
    out = sorted((r.doc_id or 0, r.text.lower()) for r in exact_dedup.keep_exact(docs(rows)).collect())
    assert out == [(0, "c"), (5, "same"), (7, "other"), (9, "lost one")]


def test_repeated_rows_with_other_columns(docs):
    """Of rows equal in id and text one stays; of an id's texts the greatest hash."""
    rows = [(5, "u"), (5, "t"), (9, "t"), (1, "v", "b"), (1, "v", "a"), (None, "w"), (3, "w")]
    out = exact_dedup.keep_exact(docs(rows)).collect()
    assert sorted((r.doc_id, r.text, r.lang or "") for r in out) == [(1, "v", "a"), (3, "w", ""), (5, "u", ""), (9, "t", "")]
    assert sum(r.doc_id == 4 for r in exact_dedup.keep_exact(docs([(4, "Same"), (4, "sAME"), (4, "same")])).collect()) == 1
