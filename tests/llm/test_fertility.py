import re

import numpy as np
import public_tokenizers as P
import pytest

from lodestone.llm import fertility
from tests.llm.conftest import ODD

PATHS = (P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model"), P.PATTERN)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def measures():
    return fertility.load(*PATHS)


def brute(text):
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    covered = {p for k, w in enumerate(windows) if windows.count(w) > 1 for p in range(k, k + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


TEXTS = [*(t or "" for t in ODD), "a b c d e f " * 4, "x y z w v\n" * 3 + "q", "a a a a a a", "l1 é\nl1 é\n\nl2 #$\nl1 é", "u\u00a0v w\x1cx", "The The The " * 9 + "1 2 3 4"]


def test_base_counts(measures):
    """One by one and all at once."""
    for texts in ([t] for t in TEXTS):
        (row,) = fertility.measured([texts[0].encode()], measures, fertility.BANDS, 50)
        assert row[:6] == brute(texts[0]), texts
    rows = fertility.measured([t.encode() for t in TEXTS], measures, fertility.BANDS, 50)
    assert [r[:6] for r in rows] == [brute(t) for t in TEXTS]
    assert fertility.measured([], measures, fertility.BANDS, 50) == []


def test_repeated_words_with_many_distinct():
    words = np.array([*range(9000), *range(100, 120)], np.uint64)
    assert fertility.repeated_words(words, np.zeros(len(words), np.int64), 2).tolist() == [40, 0]
    assert fertility.repeated_words(words, (np.arange(len(words)) >= 9000).astype(np.int64), 2).tolist() == [0, 0]


@pytest.mark.parametrize("group", [2, 1024])
def test_words_at_once(measures, monkeypatch, group):
    """As each word by itself, white space of other kinds and odd bytes included."""
    monkeypatch.setattr(measures, "GROUP", group)
    words = ["a", "the", "中é", "x\u00a0y", "\u00a0", "b\u00a0", "!", "'s", "😀", "\u2581", "a\u2581b", "x\x1cy", "\u3000z", "naïve", "Москва", "12%", "a\u200bb", "¨", "ﬁ"]
    ids, tokens, pieces, fallback, script = measures.of([w.encode() for w in words] + [b"\xff\xfe"])
    words.append("\ufffd\ufffd")
    assert ids.tolist() == [i for w in words for i in measures.byte(" " + w)]
    assert tokens.tolist() == [len(measures.byte(" " + w)) for w in words]
    each = [measures.piece.encode(w) for w in words]
    assert pieces.tolist() == [len(p) or 1 for p in each]
    assert fallback.tolist() == [sum(measures.piece.is_byte(i) for i in p) for p in each]
    assert [fertility.SCRIPTS[k] for k in script] == [fertility.script_of(w) for w in words]


def test_measures(measures):
    text = "The quick brown fox jumps over the lazy dog near the river bank today 中"
    (row,) = fertility.measured([text.encode()], measures, fertility.BANDS, 50)
    *_, script, n, byte_cpt, piece_cpt, fallback, entropy, reason = row
    words = text.split()
    tokens = [i for w in words for i in measures.byte(" " + w)]
    pieces = [i for w in words for i in measures.piece.encode(w)]
    share = np.unique(tokens, return_counts=True)[1] / len(tokens)
    chars = sum(map(len, words))
    assert (script, n, reason) == ("LATIN", len(tokens), None)
    assert byte_cpt == chars / len(tokens) and piece_cpt == chars / len(pieces)
    assert entropy == pytest.approx(-(share * np.log2(share)).sum())
    assert fallback == sum(measures.piece.is_byte(i) for i in pieces) / len(pieces)


def test_report(docs, prose):
    rows = [(k, prose(120, k), "xx") for k in range(60)]
    junk = [(100 + k, " ".join(w + "#$%" for w in prose(120, k).split()), "xx") for k in range(5)]
    odd = [(200 + k, t, None) for k, t in enumerate(TEXTS)] + [(None, None, "xx"), (0, rows[0][1], "xx")]
    all_ = rows + junk + odd
    out = fertility.fertility_report(docs(all_, extra=True), *PATHS).collect()
    assert len(out) == len(all_)
    for doc_id, text, _ in all_:
        r = next(r for r in out if r.doc_id == doc_id)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text or "")
        assert r.kept == (r.reason is None) and not (r.base_failed and r.kept)
    kept = {r.doc_id for r in out if r.kept}
    assert {k for k, *_ in rows} <= kept and not kept & {k for k, *_ in junk}
    left = fertility.keep_fertile(docs(all_), *PATHS)
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in out if r.kept)
    assert fertility.fertility_report(docs([]), *PATHS).collect() == []


ES = "ciónñ ñmií ezllie rezrr osñez rrgañ cionñí ñezll íñco queñu ciónll rrje ñóte llñad bñez asñó rrñi ezñque óiez írrñ".split()


def test_bands_come_from_the_language(docs, prose):
    """Clean texts of a language below the fixed floor stay, short junk of another one goes."""
    r = np.random.default_rng(1)
    rows = [(k, " ".join(r.choice(ES, 90)), lang) for k, lang in enumerate(["es"] * 60 + ["small", None])]
    clean = [(100 + k, prose(120, k), "xx") for k in range(60)]
    junk = [(200 + k, " ".join(w + " |" for w in prose(80, k).split()), "xx") for k in range(5)]
    out = {r.doc_id: r for r in fertility.fertility_report(docs(rows + clean + junk), *PATHS).collect()}
    assert max(out[k].byte_cpt for k in range(62)) < fertility.BANDS["LATIN"]["byte_cpt"][0]
    assert sum(out[k].kept for k in range(60)) >= 58 and out[60].kept and out[61].kept
    assert not any(out[k].kept for k in range(200, 205))
