"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass one scatters whole records into buckets by a seeded hash; there are so many buckets
that one holds about `BUCKET_ROWS` records, or `BUCKET_BYTES` of them, and fits in
memory. Pass two puts each bucket in a fixed order, applies a seeded Fisher-Yates
shuffle to it and writes it. The shuffled buckets one after another are a random order of all
records, which is cut into shards of contiguous positions: law `rows`, counts at most one
apart. Records travel once: a bucket's first position is known from counts of hashes before.

A bucket's records are sorted before they are shuffled and the buckets of a task before
that, so a task that runs again after a lost executor gives the same order. Records equal
in doc_id and text are numbered and scattered one by one, so not even a record that a third
of the table repeats fills a bucket.

Defined results: null text has size 16 and crc32 0; a null doc_id is scattered by its
text; fewer records than shards leave shards empty; an empty table gives no rows; all
columns are written, whatever their names, but columns named shard or slot give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lodestone.llm.common import Scratch, fresh, numbered, running_sum, shuffle_files_dropped, small, text_id, without

BUCKET_ROWS, BUCKET_BYTES, MOST_TASKS, SEED = 4_096, 64 << 20, 20_000, 71


def marked(docs: DataFrame, seed: int, scratch: Scratch) -> DataFrame:
    """record (all columns) and mark, a seeded hash that differs between repeated records."""
    h1, h2 = text_id()
    keys = docs.select("doc_id", h1.alias("h1"), h2.alias("h2"))
    repeated = scratch.table(keys.groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    own = docs if repeated.isEmpty() else without(docs, repeated)

    def with_mark(df: DataFrame, *more: Column) -> DataFrame:
        return df.select(F.struct(*(df[c] for c in docs.columns)).alias("record"), F.xxhash64(F.col("doc_id"), *text_id(), *more, F.lit(seed)).alias("mark"))

    out = with_mark(own)
    if own is not docs:
        names = fresh(docs, "_id", "_h1", "_h2")
        match = docs["doc_id"].eqNullSafe(F.col(names[0])) & (h1 == F.col(names[1])) & (h2 == F.col(names[2]))
        copies = docs.join(small(repeated.toDF(*names)), match, "left_semi").select(F.struct("*").alias("record"))
        record = numbered(copies, ["record"])
        out = out.unionByName(record.select("record", F.xxhash64(F.col("record.doc_id"), F.xxhash64("record.text"), F.col("copy"), F.to_json("record"), F.lit(seed)).alias("mark")))
    return out


def placed(docs: DataFrame, shards: int, seed: int, scratch: Scratch, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """record, shard and slot of every row of ``docs``, in the order of the shuffled buckets."""
    rows = marked(docs, seed, scratch)
    weight = F.coalesce(F.octet_length("record.text"), F.lit(0)).cast("long") + 64
    total = rows.agg(F.count("*").alias("n"), F.sum(weight).alias("bytes")).first()
    count = total["n"]
    buckets = max(1, -(-count // bucket_rows), -(-int(total["bytes"] or 0) // bucket_bytes))
    bucket = F.pmod("mark", F.lit(buckets)).alias("bucket")
    sizes = rows.select(bucket).groupBy("bucket").agg(F.count("*").alias("n"))
    first = running_sum(sizes.withColumn("_all", F.lit(0)), ["_all"], "bucket", "n", "first").select("bucket", "first")
    first = scratch.table(first)
    tasks = min(buckets, MOST_TASKS)
    dealt = rows.select(bucket, "mark", "record").repartition(tasks, "bucket")
    gathered = dealt.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("mark", "record"))).alias("records")).join(small(first), "bucket")
    shuffled = gathered.sortWithinPartitions("bucket").select("first", F.shuffle("records", seed).alias("records"))
    at = shuffled.select("first", F.posexplode("records").alias("pos", "one")).select("one.record", (F.col("first") + F.col("pos")).alias("at"))
    shard = F.expr(f"((at + 1) * {shards}L - 1) div {max(count, 1)}L").cast("int")
    return at.withColumn("shard", shard).select("record", "shard", (F.col("at") - F.expr(f"(shard * {count}L) div {shards}L")).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    Whole documents are shuffled and written; all columns are taken from the written shards.
    """
    path = Scratch(docs.sparkSession).path()
    write_shards(docs, path, shards, seed)
    fields = [f for f in docs.schema.fields if f.name in ("doc_id", "text")]
    schema = StructType([*fields, StructField("slot", LongType()), StructField("shard", IntegerType())])
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 16).cast("long").alias("size")
    written = docs.sparkSession.read.schema(schema).parquet(path)
    return written.select("doc_id", size, F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = SEED, **sizes: int) -> None:
    """Writes whole documents in shuffled order, one folder a shard; ``slot`` tells the order."""
    scratch = Scratch(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    with shuffle_files_dropped(docs.sparkSession):
        out = placed(docs.select(*kept), shards, seed, scratch, **sizes).select("record.*", "shard", "slot")
        out.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    scratch.keep()
