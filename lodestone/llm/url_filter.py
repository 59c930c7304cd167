"""URL filter: host and path rules first, then a ratio of character language models.

Two variable-order Markov models over bytes, one of accepted and one of rejected URLs,
are smoothed by Witten-Bell interpolation from order `ORDER` down to the uniform
distribution. A URL's figure is the difference of its log-likelihoods under both
divided by its length; it is allowed from a threshold on. The threshold is calibrated on
labelled URLs that the models did not see, for the greatest mean of the two hit rates.

The models are the counts of all distinct URLs that rules decide but a quarter, by a seeded
hash, which is held out for the calibration. They stay tables: counts of strings of ``ORDER
+ 1`` bytes, summed by suffix and by context, meet the strings of the URLs to be judged in joins,
each distinct string once. Contexts of up to two bytes are few by construction and broadcast.
Log-likelihoods are summed as integers (`SCALE`) and the calibration counts figures on a
grid (`GRID`), so results do not depend on the order of rows. Everything is built-in functions.

Defined results: null URLs and URLs without `://` have empty host and path, fit no rule
and are judged by the models (null as the empty text); an empty URL, and every URL when
one verdict has no example, has the figure 0; the longest fitting rule wins, of equally
long ones a block; repeated rows are judged alike; extra columns are ignored; an empty
table gives no rows; URLs of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import Scratch, join_groups, text_id

ORDER, SEED, SCALE, GRID = 5, 41, 1 << 20, 1_000
VERDICTS = ("allow", "block")
Rule = tuple[str, str, str]  # verdict, host, path


def strings(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram`` for every byte of the texts ``url`` and the end: it and the ``order`` bytes
    before it, as a number; bytes 2 stand before the start and a byte 3 is the end."""
    padded = F.concat(F.lit("02" * order), F.hex(F.col("url").cast("binary")), F.lit("03"))
    place = F.explode(F.sequence(F.lit(0), F.octet_length("url")))
    cut = urls.withColumn("_hex", padded).withColumn("_at", place)
    gram = F.conv(F.substring("_hex", F.col("_at") * 2 + 1, F.lit(2 * order + 2)), 16, 10).cast("long")
    return cut.withColumn("gram", gram).drop("_hex", "_at")


def key(level: Column, value: Column) -> Column:
    """A string of some length as one number."""
    return F.shiftleft(level.cast("long"), 48).bitwiseOR(value)


def levels(grams: DataFrame, order: int) -> DataFrame:
    """Each gram's suffixes: level n has n bytes of context; ``suffix`` with the byte, ``context`` without."""
    each = grams.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(order))))
    suffix = F.expr(f"gram & (shiftleft(1L, 8 * (level + 1)) - 1)")
    return each.withColumn("suffix", key(F.col("level"), suffix)).withColumn("context", key(F.col("level"), F.shiftright(suffix, 8)))


def counts_of(urls: DataFrame, order: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(suffix, c_<verdict>) and (context, n_<verdict>, t_<verdict>) of URLs (url, verdict):
    how often a suffix occurs, and how often a context with how many different next bytes."""
    grams = strings(urls, order).groupBy("gram").agg(*(F.count(F.when(F.col("verdict") == v, 1)).alias(f"c_{v}") for v in VERDICTS))
    by = levels(grams, order).groupBy("suffix", "context", "level").agg(*(F.sum(f"c_{v}").alias(f"c_{v}") for v in VERDICTS))
    by = scratch.table(by)
    sums = [F.sum(f"c_{v}").alias(f"n_{v}") for v in VERDICTS] + [F.count(F.when(F.col(f"c_{v}") > 0, 1)).alias(f"t_{v}") for v in VERDICTS]
    return by.select("level", "suffix", *(f"c_{v}" for v in VERDICTS)), scratch.table(by.groupBy("level", "context").agg(*sums))


def differences(grams: DataFrame, counts: tuple[DataFrame, DataFrame], order: int) -> DataFrame:
    """(gram, gain): log2 of the ratio of both models' probabilities, times `SCALE`, of distinct grams."""
    by_suffix, by_context = counts
    wanted = levels(grams, order)
    # a level of up to two bytes has at most 65,792 keys
    low, high = wanted.where("level <= 1"), wanted.where("level > 1")
    met = low.join(F.broadcast(by_suffix.where("level <= 1").drop("level")), "suffix", "left").unionByName(high.join(by_suffix.where("level > 1").drop("level"), "suffix", "left"))
    low, high = met.where("level <= 2"), met.where("level > 2")
    met = low.join(F.broadcast(by_context.where("level <= 2").drop("level")), "context", "left").unionByName(high.join(by_context.where("level > 2").drop("level"), "context", "left"))
    figures = [f"{x}_{v}" for v in VERDICTS for x in "cnt"]
    lists = met.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("level", *(F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in figures)))).alias("steps"))

    def probability(verdict: str) -> Column:
        c, n, t = (f"{x}_{verdict}" for x in "cnt")
        step = lambda p, s: F.when(s[n] > 0, (s[c] + s[t] * p) / (s[n] + s[t])).otherwise(p)
        return F.aggregate("steps", F.lit(1 / 256), step)

    gain = (F.log2(probability("allow")) - F.log2(probability("block"))) * SCALE
    return lists.select("gram", F.round(gain).cast("long").alias("gain"))


def figures(urls: DataFrame, counts: tuple[DataFrame, DataFrame], order: int, scratch: Scratch) -> DataFrame:
    """``urls`` (h1, h2, url and more, a row each) with ``figure``."""
    cut = scratch.table(strings(urls.select("h1", "h2", "url"), order).groupBy("h1", "h2", "gram").agg(F.count("*").alias("times")))
    grams = cut.groupBy("gram").agg(F.count("*").alias("urls"))
    gains = scratch.table(grams.join(differences(grams.select("gram"), counts, order), "gram"))
    sums = join_groups(cut, gains, ["gram"], "urls", max(1, urls.count())).groupBy("h1", "h2").agg(F.sum(F.col("gain") * F.col("times")).alias("gain"))
    sums = scratch.table(sums, drop=[cut, gains])
    figure = F.when(F.col("url") == "", 0.0).otherwise(F.col("gain") / SCALE / F.octet_length("url"))
    return scratch.table(urls.join(sums, ["h1", "h2"]).withColumn("figure", figure).drop("gain"), drop=[sums])


def best_cut(cells: list[tuple[int, str, int]]) -> float:
    """The threshold with the greatest mean of both hit rates, between two cells of the grid;
    cells: (figure times `GRID`, rounded; verdict; URLs)."""
    total = {v: sum(n for _, verdict, n in cells if verdict == v) for v in VERDICTS}
    if not all(total.values()):
        return 0.0
    marks: dict[int, int] = {}  # what a threshold above the cell gains, in whole numbers
    for cell, verdict, n in cells:
        marks[cell] = marks.get(cell, 0) + (-n * total["block"] if verdict == "allow" else n * total["allow"])
    order = sorted(marks)
    best, cut, gain = 0, order[0] - 0.5, 0
    for k, cell in enumerate(order[:-1]):
        gain += marks[cell]
        if gain > best:
            best, cut = gain, (cell + order[k + 1]) / 2
    return cut / GRID


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(text, pattern, 1), upper, lower), F.regexp_extract(text, pattern, 2)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The deciding rule as (rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, at, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "block")):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def held_out(url: Column, seed: int) -> Column:
    """A quarter of the URLs, by the first eight digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(url, F.lit(str(seed))).cast("binary")), 1, 8), 16, 10).cast("long") % 4 == 3


def judge_urls(pages: DataFrame, rules: list[Rule], order: int = ORDER, seed: int = SEED) -> DataFrame:
    """page_id, host, path, rule, verdict, figure (null where a rule decides) per row."""
    scratch = Scratch(pages.sparkSession)
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    h1, h2 = text_id("url")
    ruled = split.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).select("page_id", "url", h1.alias("h1"), h2.alias("h2"), "host", "path", "_rule.*")
    each = scratch.table(ruled.groupBy("h1", "h2").agg(F.first("url").alias("url"), F.first("verdict").alias("verdict"), F.count("*").alias("n")))
    counts = counts_of(each.where(F.col("verdict").isNotNull() & ~held_out(F.col("url"), seed)), order, scratch)
    examples = each.where(~held_out(F.col("url"), seed)).agg(*(F.count(F.when(F.col("verdict") == v, 1)) for v in VERDICTS)).first()
    wanted = each.where(F.col("verdict").isNull() | held_out(F.col("url"), seed))
    if all(examples):
        judged = figures(wanted, counts, order, scratch)
    else:
        judged = scratch.table(wanted.withColumn("figure", F.lit(0.0)))
    cells = judged.where(F.col("verdict").isNotNull()).groupBy(F.round(F.col("figure") * GRID).cast("long").alias("cell"), "verdict").count()
    threshold = best_cut([tuple(r) for r in cells.collect()]) if all(examples) else 0.0  # cells of a bounded grid
    scratch.keep(judged)

    open_ = judged.where(F.col("verdict").isNull()).select("h1", "h2", "n", "figure")
    decided = ruled.where(F.col("verdict").isNotNull()).select("page_id", "host", "path", "rule", "verdict", F.lit(None).cast("double").alias("figure"))
    left = ruled.where(F.col("verdict").isNull()).select("page_id", "host", "path", "h1", "h2")
    verdict = F.when(F.col("figure") >= threshold, "allow").otherwise("block")
    met = join_groups(left, open_, ["h1", "h2"], "n", max(1, pages.count())).select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), verdict.alias("verdict"), "figure")
    return decided.unionByName(met)
