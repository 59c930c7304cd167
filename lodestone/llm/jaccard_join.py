"""N-gram Jaccard join with count vectors in an R-tree.

A document is the set of its distinct word shingles. Two documents link when
``100 * common >= percent * union``; the result is each document's component.

1. Equal sets become one node, grouped by 128 bits of the set's hash.
2. Routing. The first common shingle of two linked sets, in any fixed order, has enough
   shingles after it in both sets: ``room``, the shingles from it on, is at least the
   number that the link needs. So a node goes to one cell for each of its first ``n -
   ceil(percent * n / 100) + 1`` shingles. The order is by frequency, then hash: a sketch
   over all documents counts shingles in `SKETCH` hash cells, and the more its cell holds,
   the later a shingle comes. So a passage or phrase that many documents share routes
   nothing unless a document consists of such. Cells of one node and cells of two nodes
   without enough room are dropped at once: shingles travel packed, a blob a shard and batch,
   and one that a batch has twice tells the shards so only once.
3. Hubs. A cell's hub is the member that meets most others in all its cells. Every node is
   tried against the hub that it meets most often. This is linear and joins most of a
   group of near copies, however large, into one component.
4. Cells of up to `SMALL` members that still lie in several components give their pairs
   with enough room. Larger ones are indexed: shingles are hashed into `GROUPS` groups, a
   node's counts per group are a point, points of a cell in order of component and size
   are packed into leaves of up to `LEAF`, `FAN` of these into a node of the tree and so on, each
   with its bounding box. The sum over the coordinates of the smaller upper bound is at
   least the number of common shingles; pairs of boxes below what a link needs, or of one
   component, are pruned from the roots down, before any member travels, then pairs of points.
5. All pairs have to pass the bound of their points and are verified on the full sets;
   links become components. The pairs that the boxes and points leave are counted; up to `EACH`
   a node are listed whole. If the pairs are no more than the nodes, all are verified at once,
   else in rounds (`TRIES`): each node is first tried with the partner of the greatest bound,
   then with a few more, so that the pairs of a round are linear in the nodes and those that it
   joins give no more; at last all pairs that still lie between two components.

Texts travel for the nodes in a round's pairs only. Hashes of shingles have 64
bits; cells are told apart by 48, where chance hits cost work and change nothing.

Defined results: null or empty texts and texts of white space have an empty set and are
linked with nothing; with fewer words than a shingle has, the whole sequence is the only
shingle; repeated rows are copies; null doc_ids count for no component id (null if a
component has no other); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import BROADCAST_ROWS, Scratch, gram_hashes, join_groups, map_rows, released, text_bytes, text_id, to_batch, without, word_hashes
from lodestone.llm.components import connected_components, merged

SKETCH, GROUPS, SMALL, LEAF, FAN, EACH, TRIES = 1 << 20, 128, 64, 32, 64, 32, (1, 8, None)
#: Prefix shingles in a task's shard, in a batch of the sender, and in a pass over a shard.
SHARD, BATCH, PASS = 400_000, 500_000, 4_000_000


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    each = word_hashes((text or b"").lower())
    return np.unique(gram_hashes(each, min(words, len(each)))) if len(each) else each


def least_common(a: np.ndarray | int | Column, b: np.ndarray | int | Column, percent: int):
    """Common shingles that sets of these sizes need for a link."""
    if isinstance(a, Column):
        return F.ceil((a + b).cast("long") * percent / (100 + percent))
    return -(-percent * (a + b) // (100 + percent))


def cell_levels(docs: DataFrame, words: int) -> np.ndarray:
    """How full each cell of the sketch is: half powers of two of the mean, 8 bits."""
    width = SKETCH // 64
    shift = np.uint64(64 - (SKETCH - 1).bit_length())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        total = np.zeros(SKETCH, np.int64)
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(shingle_set(text.as_py(), words) >> shift)
                size += len(held[-1])
                if size > SKETCH:
                    total += np.bincount(np.concatenate(held).astype(np.int64), minlength=SKETCH)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held).astype(np.int64), minlength=SKETCH)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int32()), pa.array([zlib.compress(total[k * width : (k + 1) * width].tobytes(), 1) for k in range(64)], pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(zlib.decompress(counts.as_py()), np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in sums.values()], pa.binary())], names=["part", "counts"])

    made = docs.select(text_bytes()).mapInArrow(count, "part int, counts binary").repartition("part").mapInArrow(add, "part int, counts binary")
    total = np.zeros(SKETCH, np.int64)
    for row in made.collect():  # 64 rows, 8 MB before compression
        total[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return np.ceil(2 * np.log2(np.maximum(total / max(total.mean(), 1.0), 0.5))).astype(np.int8)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, h1, h2, s1, s2 (of the set; null if empty), n, counts, prefix per row."""
    shared = docs.sparkSession.sparkContext.broadcast(cell_levels(docs, words))
    shift = np.uint64(64 - (SKETCH - 1).bit_length())

    def make():
        released()
        level = shared.value

        def step(row):
            own = shingle_set(row[1], words)
            n = len(own)
            if not n:
                return [(row[0], row[2], row[3], None, None, 0, None, None)]
            first = n - -(-percent * n // 100) + 1
            order = own[np.lexsort((own, level[(own >> shift).astype(np.int64)]))[:first]]
            counts = np.bincount((own & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
            s1, s2 = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), "<i8").tolist()
            return [(row[0], row[2], row[3], s1, s2, n, packed(counts), packed_prefix(order))]

        return step

    return map_rows(docs.select("doc_id", text_bytes(), *text_id()), "doc_id long, h1 long, h2 long, s1 long, s2 long, n int, counts binary, prefix binary", make)


def packed(counts: np.ndarray) -> bytes:
    """Counts in one, two or four bytes each, as they need."""
    top = counts.max()
    return counts.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(counts, {1: "u1", 2: "<u2", 4: "<u4"}[len(counts) // GROUPS]).astype(np.int64)


def packed_prefix(order: np.ndarray) -> bytes:
    """The upper 48 bits of each shingle: four bytes each, then two each."""
    token = order >> np.uint64(16)
    return (token & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (token >> np.uint64(32)).astype("<u2").tobytes()


def unpacked_prefix(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    return np.frombuffer(raw, "<u4", n).astype(np.uint64) | np.frombuffer(raw, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32)


#: A shingle of a node. at: its place, which a full value makes only more tolerant; more: others of its batch have it.
ENTRY = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<u4"), ("at", "<u2"), ("more", "u1")])


def packed_entries(rows: np.ndarray) -> bytes:
    """Shingles in 11 bytes each, their nodes once."""
    nodes, first, index = np.unique(rows["node"], return_index=True, return_inverse=True)
    parts = (
        np.array([len(rows), len(nodes)], "<u4"), nodes, rows["n"][first], (rows["token"] & np.uint64(0xFFFFFFFF)).astype("<u4"),
        (rows["token"] >> np.uint64(32)).astype("<u2"), index.astype("<u2"), rows["at"], rows["more"],
    )
    return b"".join(p.tobytes() for p in parts)


def unpacked_entries(raw: bytes) -> np.ndarray:
    count, nodes = np.frombuffer(raw, "<u4", 2).tolist()
    at, parts = 8, []
    for kind, size in (("<i8", nodes), ("<u4", nodes), ("<u4", count), ("<u2", count), ("<u2", count), ("<u2", count), ("u1", count)):
        parts.append(np.frombuffer(raw, kind, size, at))
        at += parts[-1].nbytes
    node, n, low, high, index, place, more = parts
    rows = np.empty(count, ENTRY)
    rows["token"] = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
    rows["node"], rows["n"], rows["at"], rows["more"] = node[index], n[index], place, more
    return rows


def live_cells(nodes: DataFrame, shards: int, percent: int) -> DataFrame:
    """(token, node, n, room): the cells that more than one node goes to, from (node, n, prefix)."""
    blob = pa.schema([("shard", pa.int32()), ("blob", pa.binary())])
    live = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("room", pa.int32())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held)
            rows = rows[np.argsort(rows["token"], kind="stable")]
            same = rows["token"][1:] == rows["token"][:-1]
            again = np.concatenate(([False], same))
            rows["more"] = np.concatenate((same, [False])) | again
            out = [(shards, packed_entries(rows[again]))] if again.any() else []  # live without asking
            rows = rows[~again]
            shard = (rows["token"] % np.uint64(shards)).astype(np.int64)
            rows = rows[np.argsort(shard, kind="stable")]
            edge = np.concatenate(([0], np.cumsum(np.bincount(shard, minlength=shards))))
            return to_batch(out + [(k, packed_entries(rows[edge[k] : edge[k + 1]])) for k in np.flatnonzero(np.diff(edge)).tolist()], blob)

        for batch in batches:
            for node, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                token = unpacked_prefix(raw)
                rows = np.zeros(len(token), ENTRY)
                rows["token"], rows["node"], rows["n"], rows["at"] = token, node, n, np.minimum(np.arange(len(token)), 65_535)
                # of equal upper bits the first place stands for all
                held.append(rows[np.unique(token, return_index=True)[1]])
                size += len(token)
                if size > BATCH or len(held) > 60_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def out(rows: np.ndarray) -> pa.RecordBatch:
        room = (rows["n"].astype(np.int64) - rows["at"]).astype(np.int32)
        columns = (rows["token"].astype(np.int64), rows["node"].copy(), rows["n"].astype(np.int32), room)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=live)

    def settle(rows: np.ndarray) -> np.ndarray:
        """The rows of a pass that may have a partner."""
        rows = rows[np.lexsort((rows["node"], rows["token"]))]
        first = np.flatnonzero(np.concatenate(([True], rows["token"][1:] != rows["token"][:-1])))
        size, more = np.diff(np.append(first, len(rows))), np.maximum.reduceat(rows["more"], first) > 0
        good = (size > 1) | more
        two = first[(size == 2) & ~more]  # all of the cell is here
        n, room = rows["n"].astype(np.int64), rows["n"].astype(np.int64) - rows["at"]
        good[np.flatnonzero((size == 2) & ~more)] = np.minimum(room[two], room[two + 1]) >= least_common(n[two], n[two + 1], percent)
        return rows[np.repeat(good, size)]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams a task's blobs to scratch space and settles so many shingles at a time."""
        released()
        with tempfile.TemporaryFile() as scratch:
            sizes, total = [], 0
            for batch in batches:
                for shard, packed_ in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    raw = packed_.as_py()
                    if shard == shards:
                        yield out(unpacked_entries(raw))
                        continue
                    scratch.write(raw)
                    sizes.append(len(raw))
                    total += int(np.frombuffer(raw, "<u4", 1)[0])
            passes = -(-total // PASS)
            for k in range(passes):
                scratch.seek(0)
                rows = []
                for size in sizes:
                    part = unpacked_entries(scratch.read(size))
                    rows.append(part[(part["token"] >> np.uint64(20)) % np.uint64(passes) == k] if passes > 1 else part)
                found = settle(np.concatenate(rows))
                for at in range(0, len(found), 200_000):
                    yield out(found[at : at + 200_000])

    sent = nodes.select("node", "n", "prefix").mapInArrow(send, "shard int, blob binary")
    # rows that need no answer are dealt out evenly
    dealt = sent.withColumn("_to", F.when(F.col("shard") < shards, F.col("shard").cast("long")).otherwise(F.xxhash64("blob")))
    return dealt.repartition(min(shards, MOST_TASKS), "_to").select("shard", "blob").mapInArrow(decide, "token long, node long, n int, room int")


#: Tasks of one exchange; beyond them a task takes more passes over its shards.
MOST_TASKS = 20_000


def texts_of(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, text) of the nodes in pairs (a, b)."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = scratch.table(ends.join(nodes.select("node", "rep"), "node").select("node", "rep.doc_id", "rep.h1", "rep.h2"))
    h1, h2 = text_id()
    read = docs.select("doc_id", text_bytes(), h1.alias("h1"), h2.alias("h2"))
    count = wanted.count()
    near = read.join(F.broadcast(wanted.select("h1")), "h1", "left_semi") if count <= BROADCAST_ROWS else read
    ids = wanted.toDF("node", "_id", "_h1", "_h2")
    match = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    # of rows that are repeated one stands for all
    return scratch.table(near.join(ids, match).groupBy("node").agg(F.first("text").alias("text")), drop=[wanted])


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Of distinct pairs (a, b) of nodes those that link. nodes: node, rep and more of all nodes."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    texts = texts_of(docs, nodes, pairs, scratch)
    # each a meets its b's in parts of about `each`, each of which gets a copy of a's text; the a's with several parts are few enough for a broadcast
    each = max(256, -(-pairs.count() // BROADCAST_ROWS))
    hot = pairs.groupBy("a").agg(F.ceil(F.count("*") / each).cast("int").alias("parts")).where("parts > 1")
    dealt = pairs.join(F.broadcast(hot), "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))
    left = dealt.select("a", "part").distinct().select(F.col("a").alias("node"), "a", "part", F.lit(None).cast("long").alias("b"))
    wanted = left.unionByName(dealt.select(F.col("b").alias("node"), "a", "part", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        held, one = None, None
        for batch in batches:
            out = []
            for a, b, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                other = shingle_set(text.as_py(), words)
                if b is None:
                    held, one = a, other
                    continue
                assert held == a
                common = len(one) + len(other) - len(np.union1d(one, other))
                if 100 * common >= percent * (len(one) + len(other) - common):
                    out.append((a, b))
            if out:
                yield to_batch(out, schema)

    met = texts.join(wanted, "node").select("a", "part", "b", "text")
    met = met.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return scratch.table(met.mapInArrow(run, "a long, b long"), drop=[texts])


def bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose summed coordinate minima, ``bound``, allow a link."""

    def make():
        def step(row):
            a, b = unpacked(row[2]), unpacked(row[3])
            bound = int(np.minimum(a, b).sum())
            return [(row[0], row[1], bound)] if bound >= least_common(int(a.sum()), int(b.sum()), percent) else []

        return step

    one, two = points.select(F.col("node").alias("a"), F.col("counts").alias("ca")), points.select(F.col("node").alias("b"), F.col("counts").alias("cb"))
    return map_rows(pairs.join(one, "a").join(two, "b").select("a", "b", "ca", "cb"), "a long, b long, bound long", make)


MEMBER = np.dtype([("node", "<i8"), ("comp", "<i8"), ("n", "<i4"), ("room", "<i4"), ("counts", "<u4", GROUPS)])


def point_pairs(a: np.ndarray, b: np.ndarray, own: bool, percent: int, most: int | None) -> tuple[list[tuple[int, int]], int]:
    """Pairs of members of two leaves (or of one with itself) that rooms and points allow,
    and how many more there are.

    most: how many for each member, greatest bounds first.
    """
    need = least_common(a["n"].astype(np.int64)[:, None], b["n"].astype(np.int64), percent)
    fits = (a["comp"][:, None] != b["comp"]) & (a["node"][:, None] != b["node"]) & (np.minimum(a["room"][:, None], b["room"]) >= need)
    x, y = np.nonzero(np.triu(fits, 1) if own else fits)
    bound = np.minimum(a["counts"][x], b["counts"][y]).sum(1, dtype=np.int64)
    good = bound >= need[x, y]
    x, y, bound = x[good], y[good], bound[good]
    number = len(x)
    if most is not None:
        order = np.lexsort((-bound, x))
        x, y = x[order], y[order]
        near = np.arange(number) - np.searchsorted(x, x) < most
        x, y = x[near], y[near]
    one, two = a["node"][x], b["node"][y]
    return list(zip(np.minimum(one, two).tolist(), np.maximum(one, two).tolist(), strict=True)), number - len(x)


#: A box: sizes, greatest room, its component if it has one only, and the counts' upper bounds.
BOX = "id long, parent long, token long, low int, high int, room int, comp long, box binary, members binary"


def tree_of(rows: DataFrame, height: int) -> DataFrame:
    """Packs rows (token, n, room, node, comp, counts), sorted by token, component and size, into trees.

    level 0 has the leaves; every root has level ``height`` and is its own parent. A cell
    has a root in each task that has rows of it.
    """
    schema = pa.schema([("level", pa.int32()), *((n, pa.int64()) for n in ("id", "parent", "token")), *((n, pa.int32()) for n in ("low", "high", "room")), ("comp", pa.int64()), ("box", pa.binary()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        ids = iter(range(TaskContext.get().partitionId() << 40, 1 << 62))
        out: list[tuple] = []
        cell: list[tuple] = []
        waiting: list[list[list]] = [[] for _ in range(height + 1)]  # by level, without their parents

        def close_leaf() -> None:
            block = np.zeros(len(cell), MEMBER)
            for k, (_, n, room, node, comp, counts) in enumerate(cell):
                block[k] = (node, comp, n, room, unpacked(counts))
            comps = np.unique(block["comp"])
            token = cell[0][0]
            cell.clear()
            lone = int(comps[0]) if len(comps) == 1 else None
            waiting[0].append([next(ids), token, int(block["n"].min()), int(block["n"].max()), int(block["room"].max()), lone, block["counts"].max(0), block.tobytes()])
            pack(0, False)

        def pack(level: int, last: bool) -> None:
            """Gives the waiting boxes of a level a parent when there are enough, or no more."""
            group = waiting[level]
            if not group or level < height and len(group) < FAN and not last:
                return
            parent = None
            if level < height:
                comps = {g[5] for g in group}
                parent = next(ids)
                waiting[level + 1].append([parent, group[0][1], min(g[2] for g in group), max(g[3] for g in group), max(g[4] for g in group), comps.pop() if len(comps) == 1 else None, np.max([g[6] for g in group], 0), None])
            for own, token, low, high, room, comp, box, members in group:
                out.append((level, own, own if parent is None else parent, token, low, high, room, comp, box.astype("<u4").tobytes(), members))
            group.clear()
            if level < height:
                pack(level + 1, last)

        def close_token() -> None:
            if cell:
                close_leaf()
            for level in range(height + 1):
                pack(level, True)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if cell and row[0] != cell[0][0]:
                    close_token()
                elif len(cell) >= LEAF or len(cell) >= LEAF // 2 and row[4] != cell[-1][4]:
                    close_leaf()  # at a border of components a leaf may be half full
                cell.append(row)
                if len(out) >= 2_000:
                    yield to_batch(out, schema)
                    out.clear()
        close_token()
        if out:
            yield to_batch(out, schema)

    order = ("token", "comp", "n", "node")
    placed = rows.select("token", "n", "room", "node", "comp", "counts").repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(run, f"level int, {BOX}")


def box_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs of boxes (columns of each with _a and _b) those that may hold a link: (a, b)."""

    def make():
        def step(row):
            a, b, low_a, low_b, box_a, box_b = row
            bound = np.minimum(np.frombuffer(box_a, "<u4"), np.frombuffer(box_b, "<u4")).sum(dtype=np.int64)
            return [(a, b)] if bound >= least_common(low_a, low_b, percent) else []

        return step

    column = F.col
    near = F.least(column("high_a"), column("high_b"), column("room_a"), column("room_b")) >= least_common(column("low_a"), column("low_b"), percent)
    mixed = F.coalesce(column("comp_a") != column("comp_b"), F.lit(True))
    return map_rows(pairs.where(near & mixed & (column("id_a") <= column("id_b"))).select("id_a", "id_b", "low_a", "low_b", "box_a", "box_b"), "a long, b long", make)


def leaf_pairs(tree: DataFrame, height: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of leaves, with their members, that the boxes allow."""
    names = [c for c in tree.columns if c not in ("level", "members")]

    def boxes(level: int, side: str) -> DataFrame:
        return tree.where(F.col("level") == level).select(*(F.col(c).alias(f"{c}_{side}") for c in names))

    met = boxes(height, "a").join(boxes(height, "b").withColumnRenamed("token_b", "token_a"), "token_a")
    kept = scratch.table(box_pairs(met, percent))
    for level in range(height - 1, -1, -1):
        down = kept.join(boxes(level, "a"), F.col("a") == F.col("parent_a")).drop("a").join(boxes(level, "b"), F.col("b") == F.col("parent_b"))
        kept = scratch.table(box_pairs(down, percent), drop=[kept])
    return kept


def tree_pairs(tree: DataFrame, kept: DataFrame, percent: int, most: int | None, most_pairs: int, scratch: Scratch) -> tuple[DataFrame, bool]:
    """Pairs (a, b) of different components that the pairs of leaves and the points allow,
    and whether these are all: so if they are no more than ``most_pairs``, else ``most`` decides."""
    leaves = [tree.where("level = 0").select(F.col("id").alias(x), F.col("members").alias(f"members_{x}")) for x in "ab"]
    full = kept.join(leaves[0], "a").join(leaves[1], "b").select("a", "b", "members_a", "members_b")

    def found(most: int | None) -> DataFrame:
        def make():
            def step(row):
                a, b, members_a, members_b = row
                pairs, more = point_pairs(np.frombuffer(members_a, MEMBER), np.frombuffer(members_b, MEMBER), a == b, percent, most)
                return [*((x, y, 1, 0) for x, y in pairs), (None, None, len(pairs), more)]

            return step

        made = map_rows(full, "a long, b long, n long, more long", make)
        return scratch.table(made.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("more").alias("more")))

    every = found(most)
    if most is not None:
        # boxes and points may leave few pairs of many members; the row without ends has the numbers
        sums = every.where("a is null").first()
        listed, more = (sums["n"], sums["more"]) if sums else (0, 0)
        if more and listed + more <= most_pairs:
            scratch.drop(every)
            every, more = found(None), 0
    else:
        more = 0
    return every.where("a is not null").select("a", "b"), not more


def small_pairs(live: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of different components that share a small cell with enough room."""
    a = live.select("token", F.col("node").alias("a"), F.col("n").alias("na"), F.col("room").alias("ra"), F.col("comp").alias("ca"))
    b = live.select("token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("room").alias("rb"), F.col("comp").alias("cb"))
    room = F.least("ra", "rb") >= least_common(F.col("na"), F.col("nb"), percent)
    met = a.join(b, (a["token"] == b["token"]) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & room)
    return met.select("a", "b").distinct()


def placed_in(live: DataFrame, comp: DataFrame) -> DataFrame:
    return live.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs (a, b) that lie between two components."""
    for x in "ab":
        pairs = pairs.join(comp.select(F.col("node").alias(x), F.col("comp").alias(f"_{x}")), x, "left")
    return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).drop("_a", "_b")


def link_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; see the module text."""
    return linked(docs, words, percent, Scratch(docs.sparkSession)).select("doc_id", "n_shingles", "component_id")


def linked(docs: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Adds h1, h2 and comp, the component's node (null: empty set)."""
    made = scratch.table(signatures(docs, words, percent))
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")).alias("rep")
    groups = made.where("n > 0").groupBy("s1", "s2").agg(rep, F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("n", "counts", "prefix")))
    nodes = scratch.table(groups.select(F.monotonically_increasing_id().alias("node"), "*"))
    rows = scratch.table(made.drop("counts", "prefix"), drop=[made])
    totals = nodes.agg(F.count("*").alias("nodes"), F.sum(F.length("prefix") / 6).alias("shingles"), F.max("copies").alias("copies")).first()
    total = max(1, totals["nodes"])

    live = scratch.table(live_cells(nodes, max(8, int((totals["shingles"] or 0) // SHARD)), percent))
    slim = scratch.table(nodes.drop("prefix"), drop=[nodes])
    comp = components_of(docs, slim, live, words, percent, total, scratch)

    known = placed_in(slim.select("node", "s1", "s2", "rep", "copies"), comp)
    known = scratch.table(known, drop=[slim, comp])
    best = F.min(F.struct(F.col("rep.none"), F.col("rep.doc_id"))).alias("_best")
    least = known.groupBy("comp").agg(best, F.count("*").alias("members")).select("comp", F.col("_best.doc_id").alias("component_id"), "members")
    named = join_groups(known, least, ["comp"], "members", total).select("s1", "s2", "comp", "component_id", "copies")
    filled = rows.where("n > 0").select("doc_id", "h1", "h2", "s1", "s2", "n")
    out = scratch.table(join_groups(filled, named, ["s1", "s2"], "copies", max(1, rows.count())).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "h1", "h2", "comp"))
    empty = rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), "h1", "h2", F.lit(None).cast("long").alias("comp"))
    scratch.keep(out, rows)
    return out.unionByName(empty)


def components_of(docs: DataFrame, nodes: DataFrame, live: DataFrame, words: int, percent: int, total: int, scratch: Scratch) -> DataFrame:
    """(node, comp) of the nodes with a link, from the cells (token, node, n, room)."""
    points = nodes.select("node", "counts")
    cells = live.groupBy("token").agg(F.count("*").alias("members"))
    sized = scratch.table(join_groups(live, cells, ["token"], "members", total), drop=[live])

    degree = sized.groupBy("node").agg(F.sum("members").alias("degree"))
    hub = F.max(F.struct("degree", "node", "n", "room")).alias("hub")
    best = sized.join(degree, "node").groupBy("token").agg(hub, F.count("*").alias("size")).select("token", "size", *(F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("node", "n", "room")))
    room = F.least("room", "hub_room") >= least_common(F.col("n"), F.col("hub_n"), percent)
    met = join_groups(sized, best, ["token"], "size", total).where((F.col("node") != F.col("hub_node")) & room).groupBy("node", "hub_node").agg(F.count("*").alias("times"))
    tries = met.groupBy("node").agg(F.max(F.struct("times", "hub_node")).alias("best")).select(F.col("best.hub_node").alias("a"), F.col("node").alias("b"))
    tries = scratch.table(bounded(tries, points, percent).select("a", "b"))
    links = verified(tries, docs, nodes, words, percent, scratch)
    comp = connected_components(links, scratch)
    scratch.drop(tries, links)

    # components only grow, so cells that have all members in one stay closed
    open_ = scratch.table(open_cells(sized, comp, total), drop=[sized])
    few = scratch.table(small_pairs(placed_in(open_.where(F.col("members") <= SMALL), comp), percent))
    many = scratch.table(open_.where(F.col("members") > SMALL).drop("members").join(points, "node"), drop=[open_])
    size = F.count("*").alias("m")
    large = many.groupBy("token").agg(size).agg(F.max("m").alias("largest"), F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("pairs")).first()
    linear = (large["pairs"] or 0) <= EACH * total  # then all pairs of large cells are tried at once, too; else the tree may show it
    height = 0
    while LEAF * FAN ** (height + 1) < (large["largest"] or 0):
        height += 1

    def candidates(most: int | None) -> tuple[DataFrame, bool]:
        pairs = apart(few, comp)
        if not large["largest"]:
            return bounded(pairs, points, percent), True
        tree = scratch.table(tree_of(placed_in(many, comp), height))
        kept = leaf_pairs(tree, height, percent, scratch)
        found, every = tree_pairs(tree, kept, percent, most, EACH * total, scratch)
        scratch.drop(tree, kept)
        return bounded(pairs.unionByName(found).distinct(), points, percent), every

    # with few members in large cells the first round takes more partners of each and stays linear in the nodes
    _, more, *rest = TRIES
    members = many.select("node").distinct().count() if large["largest"] and not linear else 0
    pool = tried = None
    for most in (more, 2 * more, *rest) if members * more <= total else TRIES:
        if pool is None or not linear:
            pool, linear = candidates(None if linear else most)
        else:
            pool = apart(pool, comp)
        if tried is not None:
            pool = pool.join(tried, ["a", "b"], "left_anti")
        pool = scratch.table(pool)
        left = pool.count()
        last = most is None or linear and left <= total
        if last:
            chosen = scratch.table(pool.select("a", "b"))
        else:
            rank = [F.row_number().over(Window.partitionBy(x).orderBy(F.desc("bound"), y)) <= most for x, y in (("a", "b"), ("b", "a"))]
            chosen = scratch.table(pool.withColumn("_a", rank[0]).withColumn("_b", rank[1]).where("_a or _b").select("a", "b"))
        if left:
            comp = merged(comp, verified(chosen, docs, nodes, words, percent, scratch), scratch)
            tried = chosen if tried is None else scratch.table(tried.unionByName(chosen), drop=[tried, chosen])
        if last:
            break  # a round of some partners without new pairs says nothing of the others
    scratch.drop(few, many)
    return comp


def open_cells(sized: DataFrame, comp: DataFrame, total: int) -> DataFrame:
    """(token, node, n, room, members) of the cells whose members are in several components."""
    placed = placed_in(sized, comp)
    mixed = placed.groupBy("token").agg(F.count("*").alias("_n"), F.min("comp").alias("_low"), F.max("comp").alias("_high")).where("_low < _high").select("token", "_n")
    return join_groups(sized, mixed, ["token"], "_n", total).where(F.col("_n").isNotNull()).drop("_n")


def keep_one(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs`` without those that lose to another of their component.

    The smallest doc_id stays, a null one loses to any other, and 128 bits of the text
    settle the rest. Rows are found again by doc_id and text, so nulls, repeated ids and any
    names of further columns do no harm; rows equal in both stand or fall together.
    """
    scratch = Scratch(docs.sparkSession)
    rows = linked(docs, words, percent, scratch).where(F.col("comp").isNotNull()).select("doc_id", "h1", "h2", "comp")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")
    best = rows.groupBy("comp").agg(F.min(rank).alias("best"), F.count("*").alias("members"))
    judged = join_groups(rows, best, ["comp"], "members", max(1, rows.count()))
    same = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("h1") == F.col("best.h1")) & (F.col("h2") == F.col("best.h2"))
    gone = scratch.table(judged.where(~same).select("doc_id", "h1", "h2").distinct())
    scratch.keep(gone)
    return without(docs, gone)
