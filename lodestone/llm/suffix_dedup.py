"""Suffix-array dedup: removes every byte that an earlier document already has.

A byte goes if a string of ``length`` bytes that covers it also starts in a document
with a smaller doc_id. Documents are judged as they came in; matches end with them.

1. Equal texts are one text, that of their smallest doc_id; the others lose all bytes if
   they have ``length`` of them.
2. Anchors. Of the hashes of a window's `GRAM`-byte strings the least is the window's
   anchor, so equal windows of ``length`` bytes have equal anchors. Consecutive windows
   with the same anchor form a segment; about one byte in twenty starts a segment.
3. Anchors that occur in one text only settle their segments. Tasks send the others as
   packed blobs to shards of the hash range. An anchor that a task itself finds in two
   texts is sent once, so what a third of all documents have is sent once a batch.
4. The segments of shared anchors are counted by content with their smallest doc_id, and
   distinct segments meet by anchor in shards. A shard is one text of about `SHARD_BYTES`: its
   suffixes with their common prefixes come in order from external induced sorting
   (`induced_sort`), whose queues, scans and arrays keep ``MEMORY`` bytes each and lie in scratch
   space beyond, so a shard may be far larger than memory. Suffixes with a common prefix
   of ``length`` bytes are one string; its smallest doc_id is the least of its segments.
   Anchors with over `HOT` contents are split before, by more of the bytes around the anchor.
5. Segments bring these smallest ids back to the documents, whose removed runs follow.

Defined results: null text is empty; documents shorter than ``length`` bytes lose
nothing; repeated rows (same doc_id) do not remove each other; a null doc_id counts as
larger than all others; an empty table gives no rows; extra columns are ignored. Texts
and segments are told apart by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import BROADCAST_ROWS, Scratch, join_groups, map_rows, mix64, small, text_id, to_batch
from lodestone.llm.induced_sort import MEMORY, BucketQueue, Ranks, gathered, suffix_order

GRAM, SHARD_BYTES, PIECE, BLOCK, SLICE = 24, 16 << 20, 1 << 20, 1 << 20, 50_000
#: Contents of an anchor that one task may get.
HOT = 4_000
#: Tasks of one exchange, and pairs of an anchor and a text that a task holds at a time.
MOST_TASKS, PASS = 20_000, 4_000_000
CUT = np.uint64(24)  # bits of an anchor that the filter leaves out
LAST = (1 << 63) - 1  # stands for a null doc_id


def anchor_of_windows(raw: np.ndarray, length: int) -> np.ndarray:
    """The anchor of each window of ``length`` bytes."""
    n = len(raw) - GRAM + 1
    raw = np.ascontiguousarray(raw)
    eight = np.ndarray(len(raw) - 7, "<u8", raw, 0, (1,)).copy()  # of the eight bytes from each place
    low = eight[:n] * np.uint64(0x9E3779B97F4A7C15)
    low += eight[8 : 8 + n] * np.uint64(0xD6E8FEB86659FD93)
    low += eight[GRAM - 8 : GRAM - 8 + n] * np.uint64(0x9DDFEA08EB382D69)
    low = mix64(low)
    width, span = length - GRAM + 1, 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the segments and their anchors; a segment ends where the next starts.

    Long texts are read in pieces; a segment that spans pieces is one segment.
    """
    raw = np.frombuffer(text, np.uint8)
    total = len(raw) - length + 1
    if total <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    starts, values = [], []
    before = None
    for at in range(0, total, PIECE):
        low = anchor_of_windows(raw[at : min(at + PIECE, total) + length - 1], length)
        new = np.flatnonzero(np.concatenate(([before is None or low[0] != before], low[1:] != low[:-1])))
        starts.append(new + at)
        values.append(low[new])
        before = low[-1]
    return np.concatenate(starts), np.concatenate(values)


def packed_pairs(value: np.ndarray, key: np.ndarray) -> bytes:
    """Anchors of 40 bits with their texts: five bytes and a two-byte index each, and the keys once."""
    keys, index = np.unique(key, return_inverse=True)
    head = np.array([len(value), len(keys)], "<u4")
    parts = (head, keys.astype("<i8"), (value & np.uint64(0xFFFFFFFF)).astype("<u4"), index.astype("<u2"), (value >> np.uint64(32)).astype("u1"))
    return b"".join(p.tobytes() for p in parts)


def unpacked_pairs(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, m = np.frombuffer(raw, "<u4", 2).tolist()
    at = 8 + 8 * m
    low, index, high = np.frombuffer(raw, "<u4", n, at), np.frombuffer(raw, "<u2", n, at + 4 * n), np.frombuffer(raw, "u1", n, at + 6 * n)
    return (high.astype(np.uint64) << np.uint64(32)) | low, np.frombuffer(raw, "<i8", m, 8)[index]


class Blobs:
    """Packed pairs in a scratch file of the task, read back in passes of bounded memory."""

    def __init__(self):
        self.file, self.sizes, self.pairs = tempfile.TemporaryFile(), [], 0

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def add(self, raw: bytes) -> None:
        self.file.write(raw)
        self.sizes.append(len(raw))
        self.pairs += int(np.frombuffer(raw, "<u4", 1)[0])

    def passes(self, part_of) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All (value, key) of a part at a time; part_of(value, key) gives a hash by which they are dealt."""
        count = -(-self.pairs // PASS)
        for k in range(count):
            self.file.seek(0)
            parts = []
            for size in self.sizes:
                v, key = unpacked_pairs(self.file.read(size))
                if count > 1:
                    mine = part_of(v, key) % np.uint64(count) == k
                    v, key = v[mine], key[mine]
                parts.append((v, key))
            yield np.concatenate([v for v, _ in parts]), np.concatenate([key for _, key in parts])


def shared_anchors(docs: DataFrame, length: int, shards: int) -> DataFrame:
    """(text_key, anchors): packed anchors of a text that another text may have.

    Anchors are cut to 40 bits here, which at worst lets more of them through.
    """
    blob = pa.schema([("shard", pa.int32()), ("blob", pa.binary())])
    kept = pa.schema([("bucket", pa.int32()), ("pairs", pa.binary())])
    done = pa.schema([("text_key", pa.int64()), ("anchors", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(values: list, keys: list) -> pa.RecordBatch:
            value, key = np.concatenate(values), np.concatenate(keys)
            order = np.argsort(value, kind="stable")
            value, key = value[order], key[order]
            first = np.concatenate(([True], value[1:] != value[:-1]))
            several = ~first | np.concatenate((~first[1:], [False]))  # in two texts of this batch
            rows = [(shards + int(value[0] % np.uint64(shards)), packed_pairs(value[several], key[several]))] if several.any() else []
            value, key = value[first], key[first]  # of those one tells the other tasks
            shard = ((value >> np.uint64(16)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            value, key, edge = value[order], key[order], np.searchsorted(shard[order], np.arange(shards + 1))
            rows += [(k, packed_pairs(value[edge[k] : edge[k + 1]], key[edge[k] : edge[k + 1]])) for k in range(shards) if edge[k] < edge[k + 1]]
            return to_batch(rows, blob)

        values, keys, held, seen = [], [], 0, set()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key in seen:  # a copy of a text of this batch
                    continue
                own = np.unique(anchors(text.as_py() or b"", length)[1] >> CUT)
                if not len(own):
                    continue
                seen.add(key)
                values.append(own)
                keys.append(np.full(len(own), key, np.int64))
                held += len(own)
                if held > 500_000 or len(keys) > 60_000:
                    yield flush(values, keys)
                    values, keys, held, seen = [], [], 0, set()
        if held:
            yield flush(values, keys)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Emits the pairs of shared anchors, by bucket of their text."""

        def emit(value: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
            bucket = key % shards
            order = np.argsort(bucket, kind="stable")
            value, key, bucket = value[order], key[order], bucket[order]
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))).tolist()
            rows = []
            for a, b in zip(cut, [*cut[1:], len(key)], strict=True):
                rows += [(int(bucket[a]), packed_pairs(value[k : min(b, k + 60_000)], key[k : min(b, k + 60_000)])) for k in range(a, b, 60_000)]
            if rows:
                yield to_batch(rows, kept)

        with Blobs() as blobs:
            for batch in batches:
                for shard, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if shard >= shards:
                        yield from emit(*unpacked_pairs(packed.as_py()))
                    else:
                        blobs.add(packed.as_py())
            for value, key in blobs.passes(lambda v, _: v >> np.uint64(5)):
                order = np.lexsort((key, value))
                value, key = value[order], key[order]
                cut = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
                last = np.append(cut[1:], len(value)) - 1
                shared = np.repeat(key[cut] < key[last], last - cut + 1)
                yield from emit(value[shared], key[shared])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs of a task's buckets by text."""
        with Blobs() as blobs:
            for batch in batches:
                for raw in batch.column(1):
                    blobs.add(raw.as_py())
            for value, key in blobs.passes(lambda _, k: mix64(k.view(np.uint64))):
                order = np.argsort(key, kind="stable")
                value, key = value[order], key[order]
                cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                for at in range(0, len(cut), 20_000):
                    edges = [*cut[at : at + 20_001].tolist(), len(key)]
                    yield to_batch([(int(key[a]), value[a:b].tobytes()) for a, b in zip(edges[:20_000], edges[1:], strict=False)], done)

    sent = docs.select("text_key", "text").mapInArrow(make, "shard int, blob binary")
    decided = sent.repartition(shards, "shard").mapInArrow(decide, "bucket int, pairs binary")
    return decided.repartition(shards, "bucket").mapInArrow(gather, "text_key long, anchors binary")


def segments(docs: DataFrame, shared: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """(ord, text_key, h2, start, windows, anchor, digest, body) of segments with a shared anchor.

    body, the bytes of a segment with its last window, comes once a task and content.
    """
    mine = shared.join(firsts.select("text_key", "h2", F.col("least").alias("ord")), "text_key")
    names = ("ord", "text_key", "h2", "start", "windows", "anchor", "digest")
    schema = pa.schema([*((n, pa.int64()) for n in names), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        columns: list[list[np.ndarray]] = [[] for _ in names]
        bodies: list[bytes | None] = []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(c)) for c in columns), pa.array(bodies, pa.binary())], schema=schema)
            for c in columns:
                c.clear()
            bodies.clear()
            return out

        for batch in batches:
            for key, h2, ord_, text, wanted in zip(*batch.columns, strict=True):
                text = text.as_py()
                start, value = anchors(text, length)
                wanted, short = np.unique(np.frombuffer(wanted.as_py(), np.uint64)), value >> CUT
                at = np.minimum(np.searchsorted(wanted, short), len(wanted) - 1)
                hit = np.flatnonzero(wanted[at] == short)
                end = np.append(start[1:], len(text) - length + 1)[hit]
                start = start[hit]
                own = [text[a:b] for a, b in zip(start.tolist(), (end + length - 1).tolist(), strict=True)]
                digests = list(map(xxhash.xxh3_64_intdigest, own))
                for k, digest in enumerate(digests):
                    if digest in sent:
                        own[k] = None
                    else:
                        sent.add(digest)
                if len(sent) > 500_000:
                    sent.clear()
                constant = [np.full(len(hit), v.as_py(), np.int64) for v in (ord_, key, h2)]
                for column, values in zip(columns, (*constant, start, end - start, value[hit].view(np.int64), np.array(digests, np.uint64).view(np.int64)), strict=True):
                    column.append(values)
                bodies += own
                if len(bodies) > 50_000:
                    yield flush()
        if bodies:
            yield flush()

    met = docs.join(mine, ["text_key", "h2", "ord"]).select("text_key", "h2", "ord", "text", "anchors")
    return met.mapInArrow(run, "ord long, text_key long, h2 long, start long, windows long, anchor long, digest long, body binary")


def least_by_position(text: np.ndarray, starts: np.ndarray, ords: np.ndarray, length: int, memory: int) -> Iterator[tuple[int, np.ndarray]]:
    """By blocks of the text: where one starts, and for each position the smallest doc_id of
    the segments with the string of ``length`` bytes that starts there.

    Suffixes come in order; those with a common prefix of ``length`` are a group. Positions and
    groups are dealt to the blocks of the text through scratch space.
    """
    dealt, parts, least, number = BucketQueue(memory), [], None, -1
    ranks, few = Ranks(starts, len(text)), len(text) <= BLOCK << 16
    for pos, lcp in suffix_order(text, length + 6, memory):
        owner = ords[ranks.below(pos + 1) - 1]
        new = lcp < length
        new[0] |= least is None
        first = np.flatnonzero(new)
        head = len(first) == 0 or first[0] > 0  # goes on with the last group
        low = np.minimum.reduceat(owner, np.concatenate(([0], first)) if head else first)
        if head:
            least, low = min(least, low[0]), low[1:]
        if len(low):
            parts += ([] if least is None else [np.array([least])]) + [low[:-1]]
            least = low[-1]
        group = (number + np.cumsum(new)).astype(np.int32)
        number = int(group[-1])
        block = pos // BLOCK
        order = np.argsort(block.astype(np.uint16) if few else block, kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], block[order][1:] != block[order][:-1]))).tolist()
        for x, y in zip(edge, [*edge[1:], len(order)], strict=True):
            dealt.push(int(block[order[x]]), pos[order[x:y]], group[order[x:y]])
    of_group = gathered((*parts, np.array([least])), "<i8", memory)
    for at in range(0, len(text), BLOCK):
        values = np.empty(min(BLOCK, len(text) - at), np.int64)
        for pos, group in dealt.pop(at // BLOCK):
            values[pos - at] = of_group[group]
        yield at, values
    dealt.close()


def profiles_by_segment(text: np.ndarray, sizes: np.ndarray, ords: np.ndarray, last: np.ndarray, length: int, memory: int) -> Iterator[tuple[int, bytes]]:
    """(segment, profile) of the segments of a shard that some document may lose bytes in."""
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    windows = sizes - length + 1
    ends = starts + windows
    held, base, done = np.empty(0, np.int64), 0, 0
    for at, values in least_by_position(text, starts, ords, length, memory):
        held = np.concatenate((held, values))
        upto = int(np.searchsorted(ends, at + len(values), side="right"))
        if upto > done:
            own = windows[done:upto]
            before = np.concatenate(([0], np.cumsum(own)[:-1]))
            segment = np.repeat(np.arange(upto - done), own)
            place = np.arange(len(segment)) - before[segment]
            value = held[starts[done:upto][segment] + place - base]
            closes = np.append((segment[1:] != segment[:-1]) | (value[1:] != value[:-1]), True)
            cut = np.flatnonzero(closes)
            packed = np.stack([place[cut] + 1, value[cut]], 1).astype("<i8").tobytes()
            edge = np.concatenate(([0], np.cumsum(np.bincount(segment[cut], minlength=upto - done)))).tolist()
            for k in np.flatnonzero(np.minimum.reduceat(value, before) < last[done:upto]).tolist():
                yield done + k, packed[16 * edge[k] : 16 * edge[k + 1]]
            done = upto
        keep = min(int(starts[done]) if done < len(starts) else len(text), at + len(values))
        held, base = held[max(keep - base, 0) :], max(keep, base)


NUMBERS = ("anchor", "digest", "least", "last", "n")


def shard_profiles(distinct: DataFrame, length: int, shard_bytes: int, memory: int = MEMORY) -> DataFrame:
    """(anchor, digest, n, profile) of distinct segments (anchor, digest, body, least, last, n).

    least, last: the smallest and largest doc_id with the segment. Without anything to
    remove there may be no profile.

    profile: packed (end of run of window starts, smallest doc_id) pairs of 64-bit numbers.
    """
    schema = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("profile", pa.binary())])

    def encoded(bodies: pa.BinaryArray, sizes: np.ndarray) -> np.ndarray:
        """Bytes plus 2, a 1 after each segment."""
        first, last = np.frombuffer(bodies.buffers()[1], "<i4")[[bodies.offset, bodies.offset + len(bodies)]]
        data = np.frombuffer(bodies.buffers()[2], np.uint8)[first:last]
        out = np.ones(len(data) + len(sizes), np.uint8 if not len(data) or data.max() < 254 else np.uint16)
        out[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data.astype(out.dtype) + 2
        return out

    def solve(parts: list[tuple]) -> Iterator[tuple]:
        numbers = {name: np.concatenate([p[0][name] for p in parts]) for name in NUMBERS}
        sizes = np.concatenate([p[1] for p in parts])
        wide = "<u2" if any(p[2].itemsize == 2 for p in parts) else "u1"
        text = gathered((*(p[2] for p in parts), np.zeros(1, np.uint8)), wide, memory)
        for k, profile in profiles_by_segment(text, sizes, numbers["least"], numbers["last"], length, memory):
            yield int(numbers["anchor"][k]), int(numbers["digest"][k]), int(numbers["n"][k]), profile

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole anchors, sorted, are gathered up to the size of a shard."""
        parts: list[tuple] = []
        held = 0
        rest: pa.Table | None = None

        def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            """An anchor with one content needs no sorting: one doc_id holds for its windows."""
            nonlocal held
            numbers = {name: rows.column(name).to_numpy() for name in NUMBERS}
            bodies = rows.column("body").combine_chunks()
            sizes = pc.binary_length(bodies).to_numpy().astype(np.int64)
            anchor = numbers["anchor"]
            edge = np.concatenate(([True], anchor[1:] != anchor[:-1]))
            lone = edge & np.append(edge[1:], True)
            loses = np.flatnonzero(lone & (numbers["least"] < numbers["last"]))
            if len(loses):
                packed = np.stack([sizes[loses] - length + 1, numbers["least"][loses]], 1).astype("<i8").tobytes()
                columns = [pa.array(numbers[name][loses]) for name in ("anchor", "digest", "n")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([packed[16 * k : 16 * k + 16] for k in range(len(loses))], pa.binary())], schema=schema)
            if not lone.all():
                own = bodies.filter(pa.array(~lone))
                text = encoded(own, sizes[~lone])
                parts.append(({name: v[~lone] for name, v in numbers.items()}, sizes[~lone], text))
                held += len(text)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            out = []
            for row in solve(parts):
                out.append(row)
                if len(out) >= 20_000:
                    yield to_batch(out, schema)
                    out = []
            if out:
                yield to_batch(out, schema)
            parts.clear()
            held = 0

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            anchor = rows.column("anchor").to_numpy()
            cut = np.flatnonzero(anchor[1:] != anchor[:-1])
            upto = int(cut[-1]) + 1 if len(cut) else 0  # the last anchor may go on
            rest = rows.slice(upto)
            at, borders = 0, cut + 1
            while at < upto:
                to = int(borders[min(np.searchsorted(borders, at + SLICE), len(borders) - 1)])
                yield from settle(rows.slice(at, to - at))
                at = to
                if held >= shard_bytes:
                    yield from flush()
        if rest is not None and rest.num_rows:
            yield from settle(rest)
        if parts:
            yield from flush()

    near = distinct.repartition("anchor").sortWithinPartitions("anchor", "digest")
    return near.select("anchor", "digest", "least", "last", "n", "body").mapInArrow(run, "anchor long, digest long, n long, profile binary")


def split_segments(kinds: DataFrame, length: int) -> DataFrame:
    """Distinct segments cut into pieces of three windows at most: (anchor, digest, n, at,
    sub_anchor, sub_digest, body, least, last).

    The place of the anchor in a window, three places apart, and the bytes that all windows
    with it there have in common, all but two, are the new anchor. Equal windows have it alike.
    """

    def make():
        def step(row):
            anchor, digest, n, least, last, body = row
            raw = np.frombuffer(body, np.uint8)
            found = np.flatnonzero(anchor_of_windows(raw, GRAM) == np.uint64(anchor & (1 << 64) - 1))
            window = np.arange(len(raw) - length + 1)
            place = found[np.searchsorted(found, window)]
            kind = (place - window) // 3
            cut = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (kind[1:] != kind[:-1])))).tolist()
            for a, b in zip(cut, [*cut[1:], len(window)], strict=True):
                at = int(place[a] - 3 * kind[a])
                key = xxhash.xxh3_64_intdigest(body[at : at + length - 2], int(kind[a])) - (1 << 63)
                own = body[a : b - 1 + length]
                yield anchor, digest, n, a, key, xxhash.xxh3_64_intdigest(own) - (1 << 63), own, least, last

        return step

    rows = kinds.select("anchor", "digest", "n", "least", "last", "body")
    return map_rows(rows, "anchor long, digest long, n long, at long, sub_anchor long, sub_digest long, body binary, least long, last long", make)


def hot_profiles(kinds: DataFrame, length: int, shard_bytes: int, scratch: Scratch) -> DataFrame:
    """As `shard_profiles`, for anchors with so many contents that one task shouldn't have them all."""
    pieces = scratch.table(split_segments(kinds, length))
    groups = pieces.groupBy(F.col("sub_anchor").alias("anchor"), F.col("sub_digest").alias("digest"))
    parts = groups.agg(F.max("body").alias("body"), F.min("least").alias("least"), F.max("last").alias("last"), F.count("*").alias("n"))
    solved = scratch.table(shard_profiles(parts, length, shard_bytes))
    named = solved.select(F.col("anchor").alias("sub_anchor"), F.col("digest").alias("sub_digest"), F.col("n").alias("_n"), "profile")
    rows = pieces.select("anchor", "digest", "n", "at", (F.length("body") - (length - 1)).cast("long").alias("windows"), "sub_anchor", "sub_digest")
    met = join_groups(rows, named, ["sub_anchor", "sub_digest"], "_n", max(1, pieces.count()))
    whole = met.groupBy("anchor", "digest").agg(F.first("n").alias("n"), F.max(F.col("profile").isNotNull()).alias("some"), F.array_sort(F.collect_list(F.struct("at", "windows", "profile"))).alias("parts"))

    def make():
        def step(row):
            runs = []
            for part in row[3]:
                own = np.array([[part["windows"], LAST]]) if part["profile"] is None else np.frombuffer(part["profile"], "<i8").reshape(-1, 2)
                runs.append(own + np.array([part["at"], 0]))
            return [(row[0], row[1], row[2], np.concatenate(runs).astype("<i8").tobytes())]

        return step

    out = map_rows(whole.where("some").select("anchor", "digest", "n", "parts"), "anchor long, digest long, n long, profile binary", make)
    return scratch.table(out, drop=[pieces, solved])


def kinds_of(found: DataFrame) -> DataFrame:
    return found.groupBy("anchor", "digest").agg(F.max("body").alias("body"), F.min("ord").alias("least"), F.max("ord").alias("last"), F.count("*").alias("n"))


def profiles_of(found: DataFrame, length: int, shard_bytes: int, hot: int, scratch: Scratch) -> DataFrame:
    """(anchor, digest, n, profile) of segments; anchors with over ``hot`` contents are split."""
    many = scratch.table(found.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"))
    if many.isEmpty():
        return scratch.table(shard_profiles(kinds_of(found), length, shard_bytes), drop=[many])
    contents = found.join(small(many), "anchor", "left_semi").select("anchor", "digest").distinct()
    split = scratch.table(contents.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"), drop=[many])
    rest = shard_profiles(kinds_of(found.join(small(split), "anchor", "left_anti")), length, shard_bytes)
    more = hot_profiles(kinds_of(found.join(small(split), "anchor", "left_semi")), length, shard_bytes, scratch)
    return scratch.table(rest.unionByName(more), drop=[split, more])


def repeated_segments(docs: DataFrame, firsts: DataFrame, length: int, shard_bytes: int, scratch: Scratch) -> DataFrame:
    """(ord, text_key, h2, start, profile) of segments that may lose bytes."""
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(8, min(MOST_TASKS, volume // (16 << 20)))
    shared = scratch.table(shared_anchors(docs, length, shards))
    found = scratch.table(segments(docs, shared, firsts, length), drop=[shared])
    profiles = profiles_of(found, length, shard_bytes, HOT, scratch)
    placed = join_groups(found.drop("body"), profiles, ["anchor", "digest"], "n", max(1, found.count()))
    out = placed.where("profile is not null").select("ord", "text_key", "h2", "start", "profile")
    return scratch.table(out, drop=[found, profiles])


def runs_of(ord_: int, pieces: list[dict], length: int) -> np.ndarray:
    """Byte runs (from, to) that a document loses, in order and apart."""
    runs = []
    for p in pieces:
        at = 0
        for end, least in np.frombuffer(p["profile"], "<i8").reshape(-1, 2).tolist():
            if least < ord_:
                runs.append((p["start"] + at, p["start"] + end + length - 1))
            at = end
    if not runs:
        return np.empty((0, 2), np.int64)
    runs = np.array(sorted(runs), np.int64)
    reach = np.maximum.accumulate(runs[:, 1])
    first = np.concatenate(([True], runs[1:, 0] > reach[:-1]))
    return np.stack([runs[first, 0], np.append(reach[:-1][first[1:]], reach[-1])], 1)


def repeated_runs(docs: DataFrame, firsts: DataFrame, length: int, shard_bytes: int, scratch: Scratch) -> DataFrame:
    """(text_key, h2, ord, runs): packed runs of the texts that lose bytes in their first document."""

    def make():
        def step(row):
            runs = runs_of(row[0], row[3], length)
            return [(row[1], row[2], row[0], runs.astype("<i8").tobytes())] if len(runs) else []

        return step

    found = repeated_segments(docs, firsts, length, shard_bytes, scratch)
    # repeated rows of a document bring their segments twice
    pieces = found.groupBy("ord", "text_key", "h2").agg(F.collect_list(F.struct("start", "profile")).alias("pieces"))
    return scratch.table(map_rows(pieces, "text_key long, h2 long, ord long, runs binary", make), drop=[found])


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, ord (null last), text_key and h2 (128 bits of the text), text (binary)."""
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    h1, h2 = text_id()
    return whole.select("doc_id", F.coalesce("doc_id", F.lit(LAST)).cast("long").alias("ord"), h1.alias("text_key"), h2.alias("h2"), F.col("text").cast("binary").alias("text"))


def first_texts(keyed: DataFrame) -> DataFrame:
    """text_key, h2, least (smallest ord), n (rows) of every text."""
    return keyed.groupBy("text_key", "h2").agg(F.min("ord").alias("least"), F.count("*").alias("n"))


def dedup_substrings(docs: DataFrame, length: int = 50, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    scratch = Scratch(docs.sparkSession)
    keyed = keyed_texts(docs)
    firsts = scratch.table(first_texts(keyed))
    runs = repeated_runs(keyed, firsts, length, shard_bytes, scratch)
    cut = scratch.table(kept_texts(keyed, runs).drop("kept").dropDuplicates(["text_key", "h2"]), drop=[runs])
    state = firsts.join(cut, ["text_key", "h2"], "left")
    keys = keyed.select("doc_id", "ord", "text_key", "h2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole_sha256"))
    met = join_groups(keys, state, ["text_key", "h2"], "n", max(1, firsts.agg(F.sum("n")).first()[0] or 0))
    copy = (F.col("ord") > F.col("least")) & (F.col("n_bytes") >= length)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return met.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(copy, one).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )


def kept_texts(keyed: DataFrame, runs: DataFrame) -> DataFrame:
    """(text_key, h2, n_removed, n_spans, kept_sha256, kept) of the texts that have runs."""

    def make():
        def step(row):
            key, h2, text, packed = row
            gone = np.frombuffer(packed, "<i8").reshape(-1, 2)
            edges = [0, *gone.ravel().tolist(), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            return [(key, h2, len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept)]

        return step

    count = runs.count()
    near = keyed.select("text_key", "h2", "ord", "text")
    if count <= BROADCAST_ROWS:  # else the join's shuffle tells the texts
        near = near.join(F.broadcast(runs.select("text_key")), "text_key", "left_semi")
    met = near.join(runs, ["text_key", "h2", "ord"]).select("text_key", "h2", "text", "runs")
    return map_rows(met, "text_key long, h2 long, n_removed long, n_spans long, kept_sha256 string, kept binary", make)


def deduped_texts(docs: DataFrame, length: int = 50, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, kept (binary): what is left of every row's text."""
    scratch = Scratch(docs.sparkSession)
    keyed = keyed_texts(docs)
    firsts = scratch.table(first_texts(keyed))
    runs = repeated_runs(keyed, firsts, length, shard_bytes, scratch)
    cut = kept_texts(keyed, runs).select("text_key", "h2", "kept").dropDuplicates(["text_key", "h2"])
    met = join_groups(keyed, firsts.join(cut, ["text_key", "h2"], "left"), ["text_key", "h2"], "n", max(1, firsts.agg(F.sum("n")).first()[0] or 0))
    copy = (F.col("ord") > F.col("least")) & (F.octet_length("text") >= length)
    return met.select("doc_id", F.when(copy, F.lit(b"")).otherwise(F.coalesce("kept", "text")).alias("kept"))
