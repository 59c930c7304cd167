"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when their bytes are equal after lower-casing A-Z only. Each step is
asked only of rows that the step before could not tell apart:

1. rows are counted by byte length; a length that occurs once settles its row;
2. rows of the other lengths are counted by (length, hash of the first characters);
3. only rows of a (length, prefix) that occurs twice or more have their whole content
   hashed (SHA-256), and equal hashes are one group.

All of it are built-in functions. The lengths and prefixes that go on reach the rows by a
broadcast while they are few (`small`) and by a shuffled join beyond. Rows are matched to their
groups with the few hottest groups broadcast (fewer than 1,000 by construction) and the rest
shuffled, so a text that a third of all rows share lands nowhere as a whole.

Defined results: null text counts as empty, and equals the empty text; the row with the
largest doc_id of a group stays; of repeated rows (same id, same text) one stays; a null
doc_id loses to any other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import Scratch, fresh, join_groups, numbered, small, text_id, without

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def refined(docs: DataFrame, prefix_chars: int, scratch: Scratch) -> DataFrame:
    """doc_id, text, h1, h2 and alive: whether the length and prefix of a row occur twice."""
    text = F.coalesce(F.col("text"), F.lit(""))
    prefix = F.xxhash64(normalised(F.substring("text", 1, prefix_chars)))
    h1, h2 = text_id()
    sized = docs.select("doc_id", text.alias("text"), h1.alias("h1"), h2.alias("h2"), F.octet_length(text).alias("n_bytes"))
    lengths = scratch.table(sized.groupBy("n_bytes").count().where("count > 1").select("n_bytes"))
    close = sized.join(small(lengths), "n_bytes", "left_semi").withColumn("mark", F.xxhash64("n_bytes", prefix))
    alike = scratch.table(close.groupBy("mark").count().where("count > 1").select("mark", F.lit(True).alias("alive")))
    marked = sized.withColumn("mark", F.xxhash64("n_bytes", prefix)).join(small(alike), "mark", "left")
    return marked.select("doc_id", "text", "h1", "h2", F.coalesce("alive", F.lit(False)).alias("alive"))


def digests(docs: DataFrame, prefix_chars: int, digest_all: bool, scratch: Scratch) -> DataFrame:
    """doc_id, h1, h2, alive, digest (of rows that are not alive only for ``digest_all``)."""
    rows = refined(docs, prefix_chars, scratch)
    digest = F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256))
    needed = digest if digest_all else F.when(F.col("alive"), digest)
    return scratch.table(rows.select("doc_id", "h1", "h2", "alive", needed.alias("digest")))


def exact_groups(docs: DataFrame, prefix_chars: int = 64, digest_all: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest: one row per row of ``docs``.

    digest is the SHA-256 (binary) of the normalised text where step 3 read it, else
    null. ``digest_all`` has it computed for settled rows too, for callers that report
    it; it does not change the grouping.
    """
    scratch = Scratch(docs.sparkSession)
    hashed = digests(docs, prefix_chars, digest_all, scratch)
    scratch.keep(hashed)
    single = hashed.where(~F.col("alive")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    alive = hashed.where("alive")
    groups = alive.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    joined = join_groups(numbered(alive, ["doc_id", "digest"]), groups, ["digest"], "group_size", hashed.count())
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)
    return single.unionByName(joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest"))


def keep_exact(docs: DataFrame, prefix_chars: int = 64) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of a group the largest doc_id stays, among several rows of it the one with the greatest text
    hash. Rows are found again by doc_id and 128 bits of their text, as neither nulls nor
    repeated ids tell a row; of rows equal in both one stays, the first by its columns as JSON.
    """
    scratch = Scratch(docs.sparkSession)
    hashed = digests(docs, prefix_chars, False, scratch).where("alive")
    best = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h1", "h2")).alias("best")
    groups = hashed.groupBy("digest").agg(best, F.count("*").alias("n"))
    rows = hashed.groupBy("doc_id", "h1", "h2", "digest").agg(F.count("*").alias("copies"))
    joined = join_groups(rows, groups, ["digest"], "n", max(1, hashed.count()))
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("h1") == F.col("best.h1")) & (F.col("h2") == F.col("best.h2"))
    judged = joined.select("doc_id", "h1", "h2", "copies", stays.alias("stays")).where("not stays or copies > 1")
    out = scratch.table(judged)
    scratch.keep(out)
    left = without(docs, out)
    several = out.where("stays").select("doc_id", "h1", "h2")
    return left if several.isEmpty() else left.unionByName(one_of_each(docs, several))


def one_of_each(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of ``docs`` for each of ``keys`` (doc_id, h1, h2)."""
    names = fresh(docs, "_id", "_h1", "_h2", "_row")
    h1, h2 = text_id()
    match = docs["doc_id"].eqNullSafe(F.col(names[0])) & (h1 == F.col(names[1])) & (h2 == F.col(names[2]))
    row = F.struct(*(docs[c] for c in docs.columns))
    met = docs.join(small(keys.toDF(*names[:3]), most=100_000), match).groupBy(*names[:3]).agg(F.min_by(row, F.to_json(row)).alias(names[3]))
    return met.select(*(F.col(names[3])[c].alias(c) for c in docs.columns))
