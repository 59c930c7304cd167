"""Byte-pair encoding by longest match and backtracking, decoding by offset table.

``BacktrackingBpe`` never replays merges over a text. For each start position an
Aho-Corasick automaton over the vocabulary gives the tokens that begin there, longest
first. Tokens are laid down left to right; a token may follow its predecessor only if
the pair is compatible, that is if merging their joint bytes would end in just these
two tokens. Since a token sequence is the merge result exactly when every adjacent pair
is compatible, the first complete sequence found is the exact answer. A dead end steps
back over the previous token and marks the position, so each position is left at most
once and the work is linear in the text.

Decoding concatenates the vocabulary into one blob and gathers ``blob[off[id]:off[id+1]]``.

Defined results: null text is the empty text (no tokens, empty decoded text); texts of
any length are encoded whole; repeated rows give repeated rows; extra columns are
ignored by ``encode_documents`` whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import TwoGenerations, map_rows, resident, text_bytes

#: Entries in a generation of each of a worker's caches.
CACHE = 150_000
#: Pairs of tokens whose compatibility a worker remembers at a time.
PAIRS = 1_000_000
#: Below this code point the classes of the two pattern libraries agree.
_AGREED = "԰"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            table[chr(spare)] = b
            spare += 1
    return table


class BacktrackingBpe:
    """Exact BPE of single pre-tokens; see the module text."""

    def __init__(self, tokens: list[bytes], merges: list[tuple[int, int, int]]):
        """tokens: bytes by id. merges: (left, right, made) in order of priority."""
        import ahocorasick

        self.tokens = tokens
        self.rank = {(a, b): k for k, (a, b, _) in enumerate(merges)}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        for k, (a, b, made) in enumerate(merges):
            if made not in self.parts:
                self.parts[made], self.born[made] = (a, b), k
        self.fits: dict[int, bool] = {}  # by left << 20 | right
        self.trie = ahocorasick.Automaton()
        for token, word in enumerate(tokens):
            if word and (len(word) == 1 or self.reachable(token)):
                self.trie.add_word(word.decode("latin-1"), (token, len(word)))
        self.trie.make_automaton()
        #: The next shorter token that a token starts with.
        self.shorter: list[tuple[int, int] | None] = [None] * len(tokens)
        for word, (token, _) in self.trie.items():
            for size in range(len(word) - 1, 0, -1):
                if (found := self.trie.get(word[:size], None)) is not None:
                    self.shorter[token] = found
                    break

    def reachable(self, token: int) -> bool:
        """Whether merging a token's own bytes ends in that token."""
        if token not in self.parts:
            return False
        a, b = self.parts[token]
        return self.compatible(a, b, self.born[token])

    def compatible(self, left: int, right: int, limit: int | None = None) -> bool:
        """Whether no merge across the border comes before the merges that made both sides.

        Walks back the history of both tokens, latest merge first. At any moment the
        border lies between one suffix of the left and one prefix of the right token; if
        that pair has a merge of an earlier rank than the step that next replaced one of
        them, it would have happened, and the pair is not what merging ends in. Equal
        ranks go to the leftmost occurrence.
        """
        key = left << 20 | right
        if limit is None and key in self.fits:
            return self.fits[key]
        a, b, bar, fine = left, right, float("inf") if limit is None else limit, True
        while True:
            rank = self.rank.get((a, b))
            if rank is not None and rank < bar:
                fine = False
                break
            made_a, made_b = self.born.get(a, -1), self.born.get(b, -1)
            if made_a < 0 and made_b < 0:
                break
            if made_a > made_b:
                # of equal ranks the left one is earlier, so a merge across waits for the left side's
                a, bar = self.parts[a][1], made_a
            else:
                # ... but comes before the right side's
                b, bar = self.parts[b][0], made_b + 0.5
        if limit is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[key] = fine
        return fine

    def encode(self, piece: bytes) -> list[int]:
        """The automaton's leftmost-longest cover if all its pairs fit, else the search."""
        text = piece.decode("latin-1")
        out, last, reach, fits = [], -1, -1, self.fits
        for end, (token, size) in self.trie.iter_long(text):
            fine = end - size == reach
            if fine and last >= 0:
                fine = fits.get(last << 20 | token)
                if fine is None:
                    fine = self.compatible(last, token)
            if not fine:
                return self.search(text)
            out.append(token)
            last, reach = token, end
        return out if reach == len(text) - 1 else self.search(text)

    def search(self, text: str) -> list[int]:
        n = len(text)
        longest: list = [None] * n
        for end, found in self.trie.iter(text):
            longest[end + 1 - found[1]] = found  # ends ascend, so the longest comes last
        out: list[tuple[int, int]] = []
        dead = bytearray(n + 1)
        at, last, fits, shorter, compatible = 0, -1, self.fits, self.shorter, self.compatible
        while at < n:
            found = longest[at]
            while found is not None:
                token, size = found
                if not dead[at + size]:
                    if last < 0:
                        break
                    key = last << 20 | token
                    if fits[key] if key in fits else compatible(last, token):
                        break
                found = shorter[token]
            if found is not None:
                out.append(found)
                at += size
                last = token
                continue
            if not out:
                raise ValueError("the vocabulary lacks a byte of this text")
            dead[at] = 1
            at -= out.pop()[1]
            last = out[-1][0] if out else -1
        return [token for token, _ in out]


_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]


class UnusualGap(Exception):
    """A space that starts or ends a text or stands beside other white space."""


class ByteLevelTokenizer:
    """A byte-level vocabulary file with its pattern, special strings and caches."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for word, token in vocab.items():
            tokens[token] = bytes(alphabet[c] for c in word)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.bpe = BacktrackingBpe(tokens, [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])
        for word, token in special.items():
            tokens[token] = word.encode()
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
        self.pieces = regex.compile(pattern).findall
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.special_ids = special
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.led = TwoGenerations(self.led_ids, CACHE)
        self.by_piece = TwoGenerations(self.piece_ids, CACHE)

    def led_ids(self, part: str) -> bytes:
        """Ids of a part together with the single space before it."""
        if part.isalpha() and part.isascii():  # letters after a space are one piece, which this cache holds
            return self.piece_ids(" " + part)
        if not part or part[0].isspace() or part[-1].isspace():
            raise UnusualGap
        return self.chunk_ids(" " + part)

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of one chunk as little-endian 32-bit integers."""
        pieces = self.pieces(chunk) if max(chunk) < _AGREED else self.library_pieces(chunk)
        return self.by_piece[pieces[0]] if len(pieces) == 1 else b"".join(map(self.by_piece.__getitem__, pieces))

    def library_pieces(self, text: str) -> list[str]:
        """With newer characters the library's own pattern decides their class."""
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def piece_ids(self, piece: str) -> bytes:
        ids = self.bpe.encode(piece.encode())
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if self.special is None:
            return self.plain(text)
        parts = self.special.split(text)
        if len(parts) == 1:
            return self.plain(text)
        return b"".join(np.array([self.special_ids[p]], "<u4").tobytes() if p in self.special_ids else self.plain(p) for p in parts if p)

    def plain(self, text: str) -> bytes:
        """The pattern never matches across a border before a single space that stands
        between two characters other than white space, so a text without other gaps is
        cut there and the ids of the parts come from a cache."""
        if not text:
            return b""
        first, *rest = text.split(" ")
        try:
            if not first or first[-1].isspace():
                raise UnusualGap
            head = self.chunk_ids(first)
            return head + b"".join(map(self.led.__getitem__, rest)) if rest else head
        except UnusualGap:
            return self.chunk_ids(text)

    def decode(self, ids: bytes) -> str:
        token = np.frombuffer(ids, "<u4").astype(np.int64)
        parts = []
        for k in range(0, len(token), 1 << 16):
            t = token[k : k + (1 << 16)]
            length = self.offsets[t + 1] - self.offsets[t]
            ends = np.cumsum(length)
            where = np.arange(ends[-1]) + np.repeat(self.offsets[t] - ends + length, length)
            parts.append(self.blob[where].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


def load(path: str, pattern: str) -> ByteLevelTokenizer:
    """One tokenizer per worker process, until another is asked for."""
    return resident(("bpe", path, pattern), lambda: ByteLevelTokenizer(path, pattern))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit), decoded (string) per row."""

    def make():
        tokenizer = load(path, pattern)

        def step(row):
            ids = tokenizer.encode((row[1] or b"").decode("utf-8", "replace"))
            return [(row[0], ids, tokenizer.decode(ids))]

        return step

    return map_rows(docs.select("doc_id", text_bytes()), "doc_id long, ids binary, decoded string", make)


def digest_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """What op6 returns: ``token_documents`` without the ids."""
    return token_documents(docs, path, pattern).drop("ids")


def token_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids and the hashes of ids and decoded text: the codec with its proof."""

    def make():
        tokenizer = load(path, pattern)

        def step(row):
            ids = tokenizer.encode((row[1] or b"").decode("utf-8", "replace"))
            return [(row[0], len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256(tokenizer.decode(ids).encode()).hexdigest())]

        return step

    return map_rows(docs.select("doc_id", text_bytes()), "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string", make)


def decode_ids(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text from rows of doc_id, ids."""

    def make():
        tokenizer = load(path, pattern)
        return lambda row: [(row[0], tokenizer.decode(row[1] or b""))]

    return map_rows(rows.select("doc_id", F.col("ids")), "doc_id long, text string", make)
