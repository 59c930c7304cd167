"""Mixing sources to target weights, in DataFrame operations only.

Targets: sources in code-point order (null last) take turns at the given weights and
share ``share`` times all words; a target stops at ``cap`` times its source's words and
the excess is shared anew by weight until none is above.

Mix: the documents of a source, in a seeded order, are one stream of words that is cut
into blocks of `BLOCK` words. Output shards have `SLOTS` slots; each slot draws its source
with the sources' shares as probabilities, so a shard's counts are multinomial. The
j-th slot of a source, counted over all shards, gets block ``perm(j mod n)`` in pass
``j div n``, where perm is a pseudorandom permutation of the n blocks (swap-or-not, keyed
by source and pass). Draws miss a source's total by about its root; slots beyond it go
to the sources that are short, so that every source gives its target to the word (the
block of its last slot is cut). Slots and blocks meet in one equi-join by source and
block index.

Nothing is done per source in one task: the order of a source's documents is found with
hash buckets of about `BUCKET` documents and prefix sums over these.

Defined results: null text has no words; documents without words are in no block and
have taken 0; sources without words have target 0; equal rows are told apart by number
and each takes its own part; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import Scratch, fresh, join_groups, numbered, running_sum, text_id

BLOCK, SLOTS, BUCKET, ROUNDS, CELLS, TASK, SEED = 256, 512, 512, 32, 1_024, 50_000, 53
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """sources (source, source_size, ...) with sid, weight and target."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.array(*map(F.lit, weights))
    ranked = sources.withColumn("sid", F.row_number().over(order)).withColumn("weight", F.element_at(turn, ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    limit = F.col("source_size") * cap
    by_ratio = Window.orderBy(limit / F.col("weight"), "sid")
    everything = Window.partitionBy()
    fuller = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum(limit).over(fuller), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fuller), F.lit(0))
    )
    leveled = ranked.withColumn("_level", level).withColumn("_full", limit / F.col("weight") <= F.col("_level"))
    common = F.max(F.when(~F.col("_full"), F.col("_level"))).over(everything)
    return leveled.withColumn("target", F.when(F.col("_full"), limit).otherwise(common * F.col("weight")).cast("double")).drop("_level", "_full")


def permuted(x: Column, n: Column, *key: Column, back: bool = False) -> Column:
    """Swap-or-not permutation of 0..n-1; ``back`` gives its inverse."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def step(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - at, n)
        return F.when(F.xxhash64(*key, r, F.greatest(at, other)).bitwiseAND(1) == 1, other).otherwise(at)

    return F.aggregate(rounds, x.cast("long"), step)


def plan(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = SEED, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their place in their source's stream, sources, and filled slots.

    Documents: doc_id, source, h1, h2 (128 bits of the text), size, copy, sid, source_size,
    target, start. Slots: shard, sid, pass, block, words (how many words of the block are taken).
    """
    scratch = scratch or Scratch(docs.sparkSession)
    h1, h2 = text_id()
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), h1.alias("h1"), h2.alias("h2"))
    rows = scratch.table(numbered(sized, ["doc_id", "source", "size", "h1", "h2"]))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sources = targets(sources, weights, share, cap)

    # how many slots a source fills, and how many words of the last one
    size, sid = F.col("source_size"), F.col("sid")
    goal = F.round("target").cast("long")
    sources = sources.withColumn("n_blocks", F.ceil(size / BLOCK)).withColumn("passes", F.when(size > 0, F.floor(goal / size)).otherwise(0)).withColumn("rest", goal - F.col("passes") * size)
    least, short = F.ceil(F.col("rest") / BLOCK), size - (F.col("n_blocks") - 1) * BLOCK
    place = permuted(F.col("n_blocks") - 1, F.col("n_blocks"), F.lit(seed), sid, F.col("passes"), back=True)
    sources = sources.withColumn("_place", F.when((size > 0) & (F.col("rest") > 0), place)).withColumn("_in", F.coalesce(F.col("_place") < least, F.lit(False)))
    more = F.when(F.col("_in") & ((least - 1) * BLOCK + short < F.col("rest")), least + 1).otherwise(least)
    sources = sources.withColumn("_last", F.when(F.col("rest") > 0, more).otherwise(0))
    covers = F.coalesce(F.col("_place") < F.col("_last"), F.lit(False))
    sources = sources.withColumn("excess", F.when(F.col("rest") > 0, F.col("_last") * BLOCK - F.when(covers, BLOCK - short).otherwise(0) - F.col("rest")).otherwise(0))
    sources = sources.withColumn("n_slots", (F.col("passes") * F.col("n_blocks") + F.col("_last")).cast("long"))
    sources = scratch.table(sources.select("source", "sid", "source_size", "target", "n_docs", "n_blocks", "n_slots", "excess"))

    total = rows.count()
    mark = F.xxhash64("doc_id", "h1", "h2", "copy", F.lit(seed))
    buckets = max(1, -(-total // BUCKET))
    known = join_groups(rows.withColumn("_key", F.xxhash64("source")), sources.withColumn("_key", F.xxhash64("source")).drop("source", "n_blocks", "n_slots", "excess"), ["_key"], "n_docs", total).drop("_key", "n_docs")
    known = known.withColumn("_mark", mark).withColumn("_bucket", F.pmod("_mark", F.lit(buckets)))
    sums = known.groupBy("sid", "_bucket").agg(F.sum("size").alias("_words"))
    first = running_sum(sums, ["sid"], "_bucket", "_words", "_first").select("sid", "_bucket", "_first")
    before = Window.partitionBy("sid", "_bucket").orderBy("_mark", "doc_id", "h1", "h2", "copy").rowsBetween(Window.unboundedPreceding, -1)
    placed = known.join(first, ["sid", "_bucket"]).withColumn("start", F.col("_first") + F.coalesce(F.sum("size").over(before), F.lit(0)))
    return placed.select("doc_id", "source", "h1", "h2", "size", "copy", "copies", "sid", "source_size", "target", "start"), sources, fill(sources, seed, scratch)


def fill(sources: DataFrame, seed: int, scratch: Scratch) -> DataFrame:
    """Draws the slots' sources shard by shard and gives each slot its block."""
    spark = sources.sparkSession
    live = sources.where("n_slots > 0").select("sid", "n_slots", "n_blocks", "source_size", "excess")
    total = live.agg(F.sum("n_slots")).first()[0] or 0
    ends = live.withColumn("_to", F.sum("n_slots").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)))
    # a draw is a number below total; cells of numbers make the search an equi-join
    width = max(1, -(-total // CELLS))
    cells = ends.select("sid", (F.col("_to") - F.col("n_slots")).alias("_from"), "_to").withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") / width), F.floor((F.col("_to") - 1) / width))))
    draws = spark.range(total).select(F.floor(F.col("id") / SLOTS).alias("shard"), F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "id"), F.lit(max(total, 1))).alias("_u"))
    drawn = draws.withColumn("_cell", F.floor(F.col("_u") / width)).join(cells, "_cell").where("_u >= _from and _u < _to")
    counts = running_sum(drawn.groupBy("sid", "shard").agg(F.count("*").alias("c")), ["sid"], "shard", "c", "had")
    counts = scratch.table(counts)

    wanted = live.select("sid", "n_slots")
    given = counts.join(F.broadcast(wanted) if total == 0 else wanted, "sid").withColumn("good", F.greatest(F.lit(0), F.least(F.col("c"), F.col("n_slots") - F.col("had"))))
    kept = given.where("good > 0").select("shard", "sid", F.explode(F.sequence(F.col("had"), F.col("had") + F.col("good") - 1)).alias("j"))
    # what was drawn beyond a source's total, shard by shard, goes to sources that are short
    over = given.where("good < c").groupBy("shard").agg(F.sum(F.col("c") - F.col("good")).alias("n"))
    over = running_sum(over.withColumn("_all", F.lit(0)), ["_all"], "shard", "n", "r")
    over = over.select("shard", F.explode(F.sequence(F.col("r"), F.col("r") + F.col("n") - 1)).alias("r"))
    short = wanted.join(counts.groupBy("sid").agg(F.sum("c").alias("c")), "sid", "left").select("sid", F.coalesce("c", F.lit(0)).cast("long").alias("c"), (F.col("n_slots") - F.coalesce("c", F.lit(0))).alias("n")).where("n > 0")
    short = running_sum(short.withColumn("_all", F.lit(0)), ["_all"], "sid", "n", "r")
    short = short.select("sid", "c", "r", F.posexplode(F.sequence(F.col("r"), F.col("r") + F.col("n") - 1)).alias("k", "_r")).select("sid", (F.col("c") + F.col("k")).alias("j"), F.col("_r").alias("r"))
    slots = kept.unionByName(over.join(short, "r").select("shard", "sid", "j"))

    # few rows became many, and the permutation is the work: so many slots a task
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK))
    slots = slots.repartition(tasks, "sid", "j").join(live.drop("source_size"), "sid").withColumn("pass", F.floor(F.col("j") / F.col("n_blocks")))
    block = permuted(F.col("j") % F.col("n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("sid"), F.col("pass"))
    slots = slots.withColumn("block", block).join(live.select("sid", "source_size"), "sid")
    length = F.least(F.lit(BLOCK), F.col("source_size") - F.col("block") * BLOCK)
    words = length - F.when(F.col("j") == F.col("n_slots") - 1, F.col("excess")).otherwise(0)
    return slots.select("shard", "sid", F.col("pass").cast("int"), "block", words.cast("long").alias("words"))


def pieces(placed: DataFrame, slots: DataFrame) -> DataFrame:
    """Words ``lo`` to ``hi`` (from 0, without the last) of a document that a slot takes.

    The key columns of the document come along; documents that no slot takes are absent.
    """
    last = F.col("start") + F.col("size") - 1
    cut = placed.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor(last / BLOCK))))
    lo = F.greatest(F.col("start"), F.col("block") * BLOCK)
    hi = F.least(F.col("start") + F.col("size"), F.col("block") * BLOCK + F.col("words"))
    met = cut.join(slots, ["sid", "block"]).withColumn("lo", lo - F.col("start")).withColumn("hi", hi - F.col("start")).where("hi > lo")
    return met.select("doc_id", "source", "h1", "h2", "size", "copy", "copies", "shard", "pass", "block", "lo", "hi")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    placed, _, slots = plan(docs, **options)
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK)
    first = F.floor(F.col("start") / BLOCK)
    cut = placed.withColumn("block", F.explode(F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))))
    each = slots.groupBy("sid", "block").agg(F.collect_list("words").alias("words"))  # cap slots a block at most
    lo = F.greatest(F.col("start"), F.col("block") * BLOCK)
    end = F.col("start") + F.col("size")
    taken = F.aggregate("words", F.lit(0).cast("long"), lambda sum_, w: sum_ + F.greatest(F.lit(0).cast("long"), F.least(end, F.col("block") * BLOCK + w) - lo))
    met = cut.join(each, ["sid", "block"], "left").withColumn("taken", F.coalesce(taken, F.lit(0)))
    keys = ["doc_id", "h1", "h2", "copy", "sid", "size", "source_size", "target"]
    return met.groupBy(*keys).agg(F.sum("taken").alias("taken")).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: per document and pass a row with the words taken in it.

    A text that is taken whole stays as it is; else its taken words follow each other,
    each with the white space before it. n_chars is that of the new text. The columns of
    ``docs`` may have any names; of rows equal in doc_id, source and text the one that is
    first by its columns as JSON gives these to all. Texts travel once.
    """
    scratch = Scratch(docs.sparkSession)
    placed, _, slots = plan(docs, scratch=scratch, **options)
    key = ["doc_id", "source", "h1", "h2"]
    ranges = pieces(placed, slots).groupBy(*key, "copy", "copies", "size", "pass").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("ranges"), F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    whole = F.when(F.col("taken") < F.col("size"), F.col("ranges"))  # null: the text as it is
    passes = scratch.table(ranges.groupBy(*key, "copies").agg(F.collect_list(F.struct("copy", "pass", whole.alias("ranges"))).alias("passes")))
    scratch.keep(passes)
    names = fresh(docs, "_id", "_source", "_h1", "_h2", "_copies", "_passes", "_row", "_pass", "_text")
    taken = passes.toDF(*names[:6])
    id_, source_, h1_, h2_, copies_, passes_, row_, pass_, text_ = map(F.col, names)

    h1, h2 = text_id()
    match = docs["doc_id"].eqNullSafe(id_) & docs["source"].eqNullSafe(source_) & (h1 == h1_) & (h2 == h2_)
    joined = docs.join(taken.where(copies_ == 1), match).select(*docs.columns, F.explode(passes_).alias(names[7]))
    several = taken.where(copies_ > 1)
    if not several.isEmpty():  # equal rows: one of them stands for all
        row = F.struct(*(docs[c] for c in docs.columns))
        one = docs.join(several, match).groupBy(*names[:4]).agg(F.min_by(row, F.to_json(row)).alias(names[6]), F.first(passes_).alias(names[5]))
        joined = joined.unionByName(one.select(*(row_[c].alias(c) for c in docs.columns), F.explode(passes_).alias(names[7])))
    words = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    some = F.array_join(F.flatten(F.transform(pass_["ranges"], lambda r: F.slice(words, (r["lo"] + 1).cast("int"), (r["hi"] - r["lo"]).cast("int")))), "")
    out = joined.withColumn(names[8], F.when(pass_["ranges"].isNull(), F.col("text")).otherwise(some))
    new = {"text": text_} | ({"n_chars": F.length(text_).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return out.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))
