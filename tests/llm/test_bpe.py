import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lodestone.llm import bpe
from tests.llm.conftest import ODD

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def pair():
    return bpe.load(PATH, P.PATTERN), Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_against_the_library(pair):
    own, library = pair
    r = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "the", "ing", "é", "中", "1", "12", "!", "'s", "'re", "<|endoftext|>", "\U00010940", "😀", "\x1c", "\x85", "\u180e", "THE", "%%%", "\u0558", "\u200b", "\u0300", "\x00"]
    for _ in range(5000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        ids = own.encode(text)
        assert (ids, own.decode(ids)) == expected(library, text), text


def test_backtracking_on_hard_words(pair):
    own, library = pair
    r = random.Random(4)
    for _ in range(3000):
        text = "".join(r.choice("aehtionrsdSTE") for _ in range(r.randint(1, 40)))
        assert own.encode(text) == expected(library, text)[0], text
    for text in ("a" * 50_000, "ab" * 20_000, "hellohello" * 3000):
        assert own.encode(text) == expected(library, text)[0]


def test_compatible_pairs_are_merge_results(pair):
    """The pair table against plain merging."""
    bpe_ = pair[0].bpe

    def merged(word):
        tokens = [bpe_.tokens.index(bytes([b])) for b in word]
        while True:
            ranks = [bpe_.rank.get(p, 1 << 30) for p in zip(tokens, tokens[1:], strict=False)]
            if not ranks or min(ranks) == 1 << 30:
                return tokens
            k = ranks.index(min(ranks))
            tokens[k : k + 2] = [bpe_.tokens.index(bpe_.tokens[tokens[k]] + bpe_.tokens[tokens[k + 1]])]

    r = random.Random(5)
    plain = [t for t in range(256, 3000) if bpe_.tokens[t].isalpha()]
    for _ in range(300):
        a, b = r.choice(plain), r.choice(plain)
        assert bpe_.compatible(a, b) == (merged(bpe_.tokens[a] + bpe_.tokens[b]) == [a, b])


def test_query(spark, docs, pair):
    rows = [*ODD, "the end", "x <|endoftext|> y"]
    got = sorted(map(tuple, bpe.digest_documents(docs(rows, extra=True), PATH, P.PATTERN).collect()))
    for (doc_id, n, ids_hash, text_hash), text in zip(got, rows, strict=True):
        ids, decoded = expected(pair[1], text or "")
        assert (n, ids_hash, text_hash) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()), doc_id
    assert bpe.digest_documents(docs([]), PATH, P.PATTERN).collect() == []


def test_round_trip(spark, docs):
    rows = [(1, "Grüße, 世界!"), (None, None), (1, "Grüße, 世界!")]
    coded = bpe.encode_documents(docs(rows), PATH, P.PATTERN)
    assert sorted((r.text) for r in bpe.decode_ids(coded, PATH, P.PATTERN).collect()) == ["", "Grüße, 世界!", "Grüße, 世界!"]
