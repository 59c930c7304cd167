"""Suffix order and common prefixes of a text by external induced sorting.

The text is cut at its local minima (suffixes of type S whose predecessor has type L).
The substrings between them are sorted by one induction, get names by rank, and the
string of names is sorted recursively; the order of these suffixes then induces the order
of all others: type L in ascending, type S in descending scans of the characters.

A scan never visits a suffix array at random. It pops from `BucketQueue`, a priority
queue by first character that gives equal characters back in the order they came, a chunk
of tuples at a time, and pushes the tuples of the suffixes one longer. A tuple is (position,
common prefix with the tuple popped before it); the common prefix of a pushed tuple is one
more than the least over the tuples popped since the last push to its character, so
common-prefix values travel along with the induction. Of a recursion the common prefixes
in names come back as well: texts are compared beyond them only.

Nothing but chunks is held. Queues and scan results (`Spool`) keep ``memory`` bytes each and
write the rest to unlinked scratch files of the task; arrays in text order (local minima,
names) beyond that are mapped from such files, and so may be the text that the caller gives.
`Ranks` holds a quarter of a byte for each character.
Name strings of up to ``base`` entries are the recursion's base and sorted by prefix doubling.

Common prefixes are exact below ``cap`` and capped there; suffixes that agree on ``cap``
characters may stand in any order, which no caller can see.
"""

from __future__ import annotations

import tempfile
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np

MEMORY, CHUNK = 16 << 20, 1 << 16
#: Name strings up to this length are sorted in memory; longer ones recurse.
BASE = 8 << 20
Chunk = tuple[np.ndarray, np.ndarray]


class Pairs:
    """Blocks of (position, number) in an unlinked scratch file."""

    def __init__(self):
        self.file, self.written = None, 0

    def write(self, pos: np.ndarray, number: np.ndarray) -> list[tuple[int, int]]:
        """Where the blocks are, as (offset, length)."""
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        blocks = []
        for at in range(0, len(pos), CHUNK):
            blocks.append((self.file.tell(), len(pos[at : at + CHUNK])))
            self.file.write(pos[at : at + CHUNK].astype("<i8").tobytes())
            self.file.write(number[at : at + CHUNK].astype("<i4").tobytes())
        self.written += 12 * len(pos)
        return blocks

    def read(self, at: int, n: int) -> Chunk:
        self.file.seek(at)
        return np.frombuffer(self.file.read(8 * n), "<i8"), np.frombuffer(self.file.read(4 * n), "<i4")

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class BucketQueue(Pairs):
    """Tuples by character; ``pop`` gives a character's tuples in the order of pushing."""

    def __init__(self, memory: int):
        super().__init__()
        self.memory, self.held = memory, 0
        self.buckets: dict[int, list[Chunk]] = {}
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def push(self, char: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.buckets.setdefault(char, []).append((pos, lcp))
        self.held += 12 * len(pos)
        if self.held > self.memory:
            for c, parts in self.buckets.items():
                self.runs.setdefault(c, []).extend(self.write(*joined(parts)))
            self.buckets, self.held = {}, 0

    def pop(self, char: int) -> Iterator[Chunk]:
        """Chunks until none is left, those pushed meanwhile included."""
        while char in self.runs or char in self.buckets:
            runs, parts = self.runs.pop(char, []), self.buckets.pop(char, [])
            self.held -= 12 * sum(len(p) for p, _ in parts)
            for at, n in runs:
                yield self.read(at, n)
            if parts:
                pos, lcp = joined(parts)
                for at in range(0, len(pos), CHUNK):
                    yield pos[at : at + CHUNK], lcp[at : at + CHUNK]


class Spool(Pairs):
    """A scan's tuples in order, read forth or back."""

    def __init__(self, memory: int):
        super().__init__()
        self.memory, self.held = memory, 0
        self.blocks: list[tuple[int, int]] = []
        self.parts: list[Chunk] = []

    def append(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.parts.append((pos, lcp))
        self.held += 12 * len(pos)
        if self.held > self.memory:
            self.blocks += self.write(*joined(self.parts))
            self.parts, self.held = [], 0

    def forth(self) -> Iterator[Chunk]:
        for at, n in self.blocks:
            yield self.read(at, n)
        yield from self.parts

    def back(self) -> Iterator[Chunk]:
        """From the end; a tuple has the common prefix with the one read before it."""
        carry = np.zeros(1, np.int32)
        for source in (reversed(self.parts), (self.read(*b) for b in reversed(self.blocks))):
            for pos, lcp in source:
                down = lcp[::-1]
                yield pos[::-1], np.concatenate((carry, down[:-1]))
                carry = down[-1:]


class Reader:
    """Takes a stream of chunks in portions of given lengths."""

    def __init__(self, chunks: Iterator[Chunk]):
        self.chunks, self.pos, self.lcp = chunks, np.empty(0, np.int64), np.empty(0, np.int32)

    def take(self, n: int) -> Iterator[Chunk]:
        while n:
            if not len(self.pos):
                self.pos, self.lcp = next(self.chunks)
            k = min(n, len(self.pos))
            yield self.pos[:k], self.lcp[:k]
            self.pos, self.lcp, n = self.pos[k:], self.lcp[k:], n - k


def joined(parts: list[Chunk]) -> Chunk:
    if len(parts) == 1:
        return parts[0]
    return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])


def gathered(parts: Iterable[np.ndarray], dtype: str, memory: int) -> np.ndarray:
    """One array of the parts, mapped from a scratch file if it is beyond ``memory`` bytes."""
    held, size, file = [], 0, None
    for part in parts:
        held.append(part.astype(dtype, copy=False))
        size += held[-1].nbytes
        if size > memory:
            file = file or tempfile.TemporaryFile()
            for p in held:
                file.write(p.tobytes())
            held = []
    if file is None:
        return np.concatenate(held) if held else np.empty(0, dtype)
    for p in held:
        file.write(p.tobytes())
    file.flush()
    return np.memmap(file, dtype, "r+")


def blank(n: int, memory: int) -> np.ndarray:
    """An array of n integers, mapped from a scratch file if it is beyond ``memory`` bytes."""
    if 8 * n <= memory:
        return np.empty(n, np.int64)
    return np.memmap(tempfile.TemporaryFile(), np.int64, "w+", shape=(n,))


class Ranks:
    """How many of some ascending distinct places lie below a position: a bit for each position and
    a count every 64, far faster than bisection for positions in no order."""

    def __init__(self, places: np.ndarray, size: int):
        parts, block = [], 1 << 20
        for at in range(0, size + 1, block):
            marks = np.zeros(block, np.uint8)
            low, high = np.searchsorted(places, (at, at + block))
            marks[np.asarray(places[low:high]) - at] = 1
            parts.append(np.packbits(marks, bitorder="little").view("<u8"))
        self.words = np.concatenate(parts)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]))

    def below(self, pos: np.ndarray) -> np.ndarray:
        word = pos >> 6
        mask = (np.uint64(1) << (pos & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Inducer:
    """One level of the recursion over an integer text whose last element is its unique least."""

    def __init__(self, text: np.ndarray, cap: int, memory: int = MEMORY):
        self.text, self.cap, self.memory = text, cap, memory
        self.spilled = 0
        self.minima = gathered(reversed(list(self.local_minima())), "<i8", memory)
        self.chars = np.unique(np.concatenate([np.unique(text[at : at + (CHUNK << 4)]) for at in range(0, len(text), CHUNK << 4)])).tolist()

    def local_minima(self) -> Iterator[np.ndarray]:
        """Positions by blocks of the text, from its end."""
        text, high, after = self.text, len(self.text) - 1, True  # after: whether ``high`` has type S
        while high > 0:
            low = max(0, high - (CHUNK << 4))
            own = text[low : high + 1].astype(np.int64)
            step = np.sign(np.diff(own))
            n = high - low
            known = np.where(step != 0, np.arange(n), n)
            next_ = np.minimum.accumulate(known[::-1])[::-1]
            rising = np.append(np.where(next_ < n, step[np.minimum(next_, n - 1)] > 0, after), after)
            yield np.flatnonzero(rising[1:] & ~rising[:-1]) + 1 + low
            high, after = low, bool(rising[0])

    def head_run(self, pos: int) -> int:
        """How often the first character of a suffix repeats, up to the cap."""
        own = np.asarray(self.text[pos : pos + self.cap])
        other = np.flatnonzero(own != own[0])
        return int(other[0]) if len(other) else len(own)

    def scan(self, seeds: Callable[[int], Iterator[Chunk]], rising: bool) -> tuple[Spool, dict[int, int]]:
        """Induces the suffixes of one type, in scan order, and how many each character has.

        seeds: the suffixes of the other type with a character, in scan order.
        """
        queue, out, counts = BucketQueue(self.memory), Spool(self.memory), {}
        text, cap = self.text, self.cap
        pushed: dict[int, tuple[int, int]] = {}  # by character: visit of the last push, least prefix after it
        at_, least_ = [], []  # visits with a prefix below all later ones
        visits = 0

        def since(char: int) -> int:
            visit_, low = pushed[char]
            k = bisect_left(at_, visit_ + 1)
            return min(low, least_[k]) if k < len(at_) else low

        def visit(char: int, pos: np.ndarray, lcp: np.ndarray, seed: bool) -> None:
            """Pushes what precedes the given suffixes; lcp[0] is to the suffix visited last."""
            nonlocal visits
            visits += 1
            before = pos - 1
            target = text[before]
            fits = (target >= char if not rising else target < char if seed else target <= char) & (pos > 0)
            at = np.flatnonzero(fits)
            touched = []
            if len(at):
                order = at[np.argsort(target[at], kind="stable")]
                keys = target[order]
                cut = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))).tolist()
                for a, b in zip(cut, [*cut[1:], len(order)], strict=True):
                    mine, c = order[a:b], int(keys[a])
                    if b - a > 1:
                        low = np.minimum.reduceat(lcp, np.concatenate(([0], mine[:-1] + 1)))
                        low[-1] = lcp[mine[-2] + 1 : mine[-1] + 1].min()
                    else:
                        low = lcp[: mine[0] + 1].min(keepdims=True)
                    new = np.minimum(low + 1, cap).astype(np.int32)
                    new[0] = min(int(low[0]), since(c)) + 1 if c in pushed else 0
                    new[0] = min(int(new[0]), cap)
                    queue.push(c, before[mine], new)
                    rest = lcp[mine[-1] + 1 :]
                    touched.append((c, int(rest.min()) if len(rest) else cap))
            floor = int(lcp.min())
            while least_ and least_[-1] >= floor:
                at_.pop()
                least_.pop()
            at_.append(visits)
            least_.append(floor)
            for c, low in touched:
                pushed[c] = (visits, low)

        for char in reversed(self.chars) if rising else self.chars:
            n, last = 0, None
            for pos, lcp in queue.pop(char):
                out.append(pos, lcp)
                if not n:
                    lcp = lcp.copy()
                    lcp[0] = 0
                n, last = n + len(pos), int(pos[-1])
                visit(char, pos, lcp, False)
            if n:
                counts[char] = n
            head = True
            for pos, lcp in seeds(char):
                if head:
                    lcp = lcp.copy()
                    lcp[0] = 0 if last is None else min(self.cap, self.head_run(last), self.head_run(int(pos[0])))
                    head = False
                visit(char, pos, lcp, True)
        self.spilled += queue.written
        queue.close()
        return out, counts

    def seeded(self, chunks: Iterator[Chunk]) -> BucketQueue:
        """Local minima by first character, in the order given."""
        queue = BucketQueue(self.memory)
        for pos, lcp in chunks:
            first = self.text[pos]
            order = np.argsort(first, kind="stable")
            pos, lcp, first = pos[order], lcp[order], first[order]
            cut = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1]))).tolist()
            for a, b in zip(cut, [*cut[1:], len(pos)], strict=True):
                queue.push(int(first[a]), pos[a:b], lcp[a:b])
        return queue

    def induce(self, minima: Iterator[Chunk]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """All suffixes in order with common prefixes, and whether a chunk has type S."""
        queue = self.seeded(minima)
        falling, n_falling = self.scan(queue.pop, rising=False)
        queue.close()
        back = Reader(falling.back())
        rising, n_rising = self.scan(lambda c: back.take(n_falling.get(c, 0)), rising=True)
        self.spilled += queue.written + falling.written + rising.written
        # the last suffix has no successor that could induce it
        yield np.array([len(self.text) - 1], np.int64), np.zeros(1, np.int32), True
        low, high = Reader(falling.forth()), Reader(rising.back())
        for c in self.chars[1:]:
            last = None
            for reader, n, kind in ((low, n_falling.get(c, 0), False), (high, n_rising.get(c, 0), True)):
                head = True
                for pos, lcp in reader.take(n):
                    if head:
                        lcp = lcp.copy()
                        lcp[0] = 0 if last is None else min(self.cap, self.head_run(last), self.head_run(int(pos[0])))
                        head = False
                    last = int(pos[-1])
                    yield pos, lcp, kind
        falling.close()
        rising.close()


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int, known: np.ndarray | None = None) -> np.ndarray:
    """Common prefixes of pairs of suffixes, up to the cap; the pairs still equal go on.

    Bytes are compared eight at a time, from the ``known`` prefix on. Past its end a text counts
    as different from itself, which its unique last element has settled before.
    """
    out = np.zeros(len(a), np.int32) if known is None else np.minimum(known, cap).astype(np.int32)
    width = 8 // text.itemsize
    if len(text) < width:
        text = np.concatenate((text, np.zeros(width, text.dtype)))
    words, end = np.lib.stride_tricks.sliding_window_view(text, width), len(text) - width

    def at(x: np.ndarray) -> np.ndarray:
        got = np.ascontiguousarray(words[np.minimum(x, end)])
        for k in np.flatnonzero(x > end).tolist():  # the few at the end of the text
            own = np.asarray(text[x[k] :])
            got[k] = 0
            got[k, : len(own)] = own
        return got.view("<u8").ravel()

    live = np.flatnonzero(out < cap)
    while len(live):
        differ = at(a[live] + out[live]) ^ at(b[live] + out[live])
        equal = differ == 0
        lowest = differ & (~differ + np.uint64(1))
        bits = np.log2(np.where(equal, np.uint64(1), lowest).astype(np.float64)).astype(np.int32)
        out[live] += np.where(equal, width, bits // (8 * text.itemsize)).astype(np.int32)
        live = live[equal & (out[live] < cap)]
    return np.minimum(out, cap)


def names_of(level: Inducer) -> tuple[np.ndarray, int]:
    """Ranks of the substrings from each local minimum to the next, in text order."""
    text, minima = level.text, level.minima
    rank, ranks = blank(len(minima), level.memory), Ranks(minima, len(text))
    before, name = None, -1

    def unsorted() -> Iterator[Chunk]:
        for at in range(0, len(minima), CHUNK):
            own = np.asarray(minima[at : at + CHUNK])
            yield own, np.zeros(len(own), np.int32)

    for pos, _, rising in level.induce(unsorted()):
        if rising:
            pos = pos[(pos > 0) & (text[pos - 1] > text[pos])]
            if not len(pos):
                continue
            pos = pos if before is None else np.concatenate(([before], pos))
            index = ranks.below(pos)
            ends = np.where(index + 1 < len(minima), minima[np.minimum(index + 1, len(minima) - 1)], len(text) - 1)
            length = ends - pos + 1
            same = length[1:] == length[:-1]
            live, depth = np.flatnonzero(same), 0
            while len(live):
                live = live[length[live] > depth]
                differ = text[pos[live] + depth] != text[pos[live + 1] + depth]
                same[live[differ]] = False
                live, depth = live[~differ], depth + 1
            step = np.cumsum(~same)
            if before is None:
                rank[index[0]] = name = 0
            rank[index[1:]] = name + step
            name += int(step[-1]) if len(step) else 0
            before = int(pos[-1])
    return rank, name + 1


def doubled(names: np.ndarray, cap: int) -> np.ndarray:
    """Order of the suffixes of a name string in memory, by ``cap`` characters at least.

    A name takes two characters or more before the next one starts, so half as many names do; equal
    suffixes may come in any order.
    """
    rank, reach = names + 1, 1
    while True:
        nxt = np.concatenate((rank[reach:], np.zeros(min(reach, len(rank)), rank.dtype)))[: len(rank)]
        key = rank * (int(rank.max()) + 1) + nxt
        order = np.argsort(key)
        key, new = key[order], np.empty_like(rank)
        new[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1]))) + 1
        rank, reach = new, reach * 2
        if 2 * reach >= cap or int(rank.max()) == len(rank):
            return order


def ordered_minima(level: Inducer, base: int, depth: list[int]) -> Iterator[Chunk]:
    """The local minima as suffixes in order, with common prefixes."""
    names, kinds = names_of(level)
    minima, text, cap = level.minima, level.text, level.cap

    def order() -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Indices of minima, and common prefixes in names."""
        if kinds == len(names):
            inverse = blank(len(names), level.memory)
            for at in range(0, len(names), CHUNK):
                inverse[names[at : at + CHUNK]] = np.arange(at, min(at + CHUNK, len(names)))
            ranked = inverse
        elif len(names) <= base:
            ranked = doubled(np.asarray(names), cap)
        else:
            depth.append(len(names))
            chunks = (names[at : at + CHUNK] + 1 for at in range(0, len(names), CHUNK))
            inner = gathered((*chunks, np.zeros(1, np.int64)), "<i8", level.memory)
            for pos, lcp in suffix_order(inner, cap, level.memory, base, depth):
                keep = pos < len(names)
                yield pos[keep], lcp[keep]
            return
        for at in range(0, len(ranked), CHUNK):
            yield np.asarray(ranked[at : at + CHUNK]), None

    before = None
    for index, equal in order():
        if not len(index):
            continue
        first = np.asarray(minima[index])
        known = None
        if equal is not None:  # so many names agree, and with them their substrings
            known = np.minimum(minima[np.minimum(index + equal, len(minima) - 1)] - first, cap)
        a = np.concatenate(([first[0] if before is None else before], first[:-1]))
        lcp = common_prefix(text, a, first, cap, known)
        if before is None:
            lcp[0] = 0
        before = int(first[-1])
        yield first, lcp


def suffix_order(text: np.ndarray, cap: int, memory: int = MEMORY, base: int = BASE, depth: list[int] | None = None) -> Iterator[Chunk]:
    """Suffixes in order and the common prefix of each with the one before it, in chunks.

    text: integers, of which the last is the unique least. depth: gets the length of each
    name string that is sorted by recursion.
    """
    level = Inducer(text, cap, memory)
    minima = ordered_minima(level, base, [] if depth is None else depth) if len(level.minima) else iter(())
    for pos, lcp, _ in level.induce(minima):
        yield pos, lcp
