"""Shared helpers: table access, Arrow mapping, byte-level word scanning, hot-key joins.

Word means ``[^\\x20\\x09-\\x0D]+`` throughout, which is exactly what ``bytes.split()``
separates on.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHITESPACE = b" \t\n\v\f\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(WHITESPACE)] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 19
_POWERS: list[np.ndarray] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(name: str = "text"):
    """The whole text as UTF-8 bytes; null stays null."""
    return F.col(name).cast("binary")


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[tuple], Iterable[tuple]]], flush_bytes: int = 8 << 20) -> DataFrame:
    """Runs a per-row generator over Arrow batches.

    ``make`` is called once per task and returns ``row -> rows``; rows are tuples in
    column order. Output goes out whenever about ``flush_bytes`` of it have gathered,
    so a task never holds more than one input batch and one output batch.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            columns = batch.columns
            for i in range(batch.num_rows):
                for out in step(tuple(c[i].as_py() for c in columns)):
                    rows.append(out)
                    held += sum(len(v) if isinstance(v, (bytes, str)) else getattr(v, "nbytes", 8) for v in out)
                    if held >= flush_bytes or len(rows) >= 20_000:
                        yield to_batch(rows, arrow)
                        rows, held = [], 0
        if rows:
            yield to_batch(rows, arrow)

    return df.mapInArrow(run, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's), so that sums and products of hashes stay well spread."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            inverse = pow(int(_BASE), -1, 1 << 64)
            up, down = np.full(size, _BASE), np.full(size, np.uint64(inverse))
            up[0] = down[0] = 1
            _POWERS[:] = [np.cumprod(up), np.cumprod(down)]
    return _POWERS[0], _POWERS[1]


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash per word, in order. Works in chunks cut at white space."""
    parts, at = [], 0
    while at < len(text):
        end = at + _CHUNK
        while end < len(text) and not IS_SPACE[text[end]]:
            end += 1
        parts.append(_chunk_hashes(text[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _chunk_hashes(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    edge = np.diff(np.concatenate(([False], ~IS_SPACE[raw], [False])).view(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Order-aware hashes of the ``size``-word windows of a word-hash array."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out = mix64(out * np.uint64(0x9DDFEA08EB382D69) + words[k : k + n])
    return out


#: Rows of a few numbers that a broadcast may have; with more the join is shuffled.
BROADCAST_ROWS = 400_000


def small(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for a broadcast if it has at most ``most`` rows (counted unless given);
    else as it is, for a shuffled join."""
    n = df.limit(most + 1).count() if rows is None else rows
    return F.broadcast(df) if n <= most else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, made of these."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def text_id(name: str = "text") -> tuple[Column, Column]:
    """128 bits that tell texts apart, as two numbers; a null text has its own."""
    return F.xxhash64(F.col(name)), F.xxhash64(F.lit(0x51_7C_C1B7), F.col(name))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` but those whose doc_id and text are among ``gone`` (doc_id, h1, h2).

    Nulls match nulls; the columns of ``docs`` may have any names.
    """
    names = fresh(docs, "_gone_id", "_gone_h1", "_gone_h2")
    keys = gone.select("doc_id", "h1", "h2").distinct().toDF(*names)
    h1, h2 = text_id()
    match = docs["doc_id"].eqNullSafe(F.col(names[0])) & (h1 == F.col(names[1])) & (h2 == F.col(names[2]))
    return docs.join(small(keys, most=100_000), match, "left_anti")


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, share: int = 1000) -> DataFrame:
    """Left join of ``rows`` to one row per key of ``groups`` where a key may hold most rows.

    Groups with more than ``total / share`` rows number fewer than ``share`` whatever the
    input, so these are broadcast; all other groups are small enough for a shuffled join.
    ``groups`` has ``keys``, ``size`` (its row count) and further columns.
    """
    rest = [c for c in groups.columns if c not in keys]
    bar = max(1, total // share)
    hot = groups.where(F.col(size) > bar).select(*keys, F.struct(*rest).alias("_hot"))
    cold = groups.where(F.col(size) <= bar).select(*keys, F.struct(*rest).alias("_cold"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    settled = marked.where(F.col("_hot").isNotNull()).select(*rows.columns, "_hot.*")
    others = marked.where(F.col("_hot").isNull()).select(*rows.columns).join(cold, keys, "left").select(*rows.columns, "_cold.*")
    return settled.unionByName(others)


def key_mod(divisor: int, column: str = "doc_id"):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def work_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local default only where it is unset."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return conf or spark.conf.get("spark.checkpoint.dir", None) or "/tmp/checkpoints"


def numbered(df: DataFrame, columns: list[str], run: int = 4_096) -> DataFrame:
    """Rows with a number among equal rows, ``copy`` from 0, and how many these are, ``copies``.

    Equal rows are counted before the shuffle. Runs of ``run`` numbers are dealt out before they become rows, so a row that most of
    the table repeats does not come back in one task.
    """
    counted = df.groupBy(*columns).agg(F.count("*").alias("copies"))
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / run))))
    many = runs.where(F.col("copies") > run).repartition("_run", *columns)
    first, last = F.col("_run") * run, F.least(F.col("copies"), (F.col("_run") + 1) * run) - 1
    each = runs.where(F.col("copies") <= run).unionByName(many)
    return each.withColumn("copy", F.explode(F.sequence(first, last))).withColumn("copy", F.col("copy").cast("int")).drop("_run")


def running_sum(df: DataFrame, keys: list[str], order: str, value: str, name: str, chunk: int = 4096) -> DataFrame:
    """Adds the sum of ``value`` over the rows of lower ``order`` with the same keys.

    ``order`` is an integer without repeats within the keys. It works in two levels, so
    that no task takes more than ``chunk`` rows or a ``chunk``-th of all rows of a key.
    """
    part = F.floor(F.col(order) / chunk).alias("_part")
    sums = df.groupBy(*keys, part).agg(F.sum(value).alias("_sum"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    own = Window.partitionBy(*keys, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("_part", part).withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return inner.join(before, [*keys, "_part"]).withColumn(name, (F.col("_before") + F.col("_own")).cast("long")).drop("_part", "_before", "_own")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables of one computation, in the shared folder.

    ``table`` cuts the lineage: it writes a compressed table, deletes the shuffle files of
    the query that made it and returns the table, which unlike a checkpoint has its own
    size statistics. ``drop`` deletes tables that nothing reads any more; what is left
    goes when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.written = spark, {}, 0

    def path(self) -> str:
        path = f"{work_dir(self.spark)}/lodestone-{uuid.uuid4().hex}"
        fs, at = _file_system(self.spark, path)
        fs.deleteOnExit(at)
        return path

    def table(self, df: DataFrame, drop: Iterable[DataFrame] = ()) -> DataFrame:
        path = self.path()
        with shuffle_files_dropped(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        self.drop(*drop)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        self.written += 1
        if self.written % 4 == 0:
            collect_garbage(self.spark)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            _, path = self.paths.pop(id(df), (None, None))
            if path:
                delete(self.spark, path)

    def keep(self, *tables: DataFrame) -> None:
        """Drops all tables but these."""
        kept = {id(t) for t in tables}
        self.drop(*(df for k, (df, _) in list(self.paths.items()) if k not in kept))


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)
    fs.cancelDeleteOnExit(at)


@contextlib.contextmanager
def shuffle_files_dropped(spark: SparkSession):
    """Queries that run inside delete their shuffle files when they end."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def collect_garbage(spark: SparkSession) -> None:
    """Drops the plans of written tables: long pipelines would else fill the driver's heap."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_RESIDENT: dict[tuple, object] = {}


def resident(key: tuple, make: Callable):
    """An object that a worker process keeps between tasks, until another key is asked for."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        gc.collect()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def released() -> None:
    """Gives back what earlier tasks left in this worker process: resident objects and free memory.

    Workers outlive their stages, so a task without use for them would else hold the vocabularies and
    caches of another stage beside its own arrays.
    """
    if _RESIDENT:
        _RESIDENT.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


class TwoGenerations(dict):
    """A bounded cache: when it is full its entries become the old generation, from which
    those in use come back, and the older ones go."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def keep(self, key, value) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) < 200:
            self.keep(key, value)
        return value
