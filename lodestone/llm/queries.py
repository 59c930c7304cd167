"""One query per operator, over whole tables; SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, exact_dedup, fertility, ftrl, jaccard_join, langid, mixing, sharding, suffix_dedup, url_filter
from lodestone.llm.common import key_mod, read_table

BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
FERTILITY_PATHS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model"), PATTERN)
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.fertility_report(read_table(spark, sf_dir, "documents"), *FERTILITY_PATHS)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(read_table(spark, sf_dir, "documents"), length=50)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(key_mod(4) != 2))
    out = langid.predict_languages(docs, model)
    return out.select("doc_id", (key_mod(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), shards=40)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, cap=2.0)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(read_table(spark, sf_dir, "documents"), BYTE_JSON, PATTERN)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"), digest_all=True)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(read_table(spark, sf_dir, "documents"), words=3, percent=90)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(key_mod(3) != 1).select("doc_id", F.col("quality").alias("label"))
    out = ftrl.score_documents(docs, ftrl.fit(docs, labels))
    return out.select("doc_id", (key_mod(3) == 1).alias("held_out"), "score", "predicted")


ORACLE: dict[str, str] = {
    "op7_exact_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)""",
    "op2_suffix_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
e AS (SELECT doc_id, n, c, substr(h, 1000 * c + 1, 1098) AS h FROM (SELECT *, unnest(range(0, (n + 499) // 500)) AS c FROM d)),
b AS (SELECT *, unnest(range(0, least(500, n - 500 * c))) AS q FROM e),
g AS (SELECT doc_id, 500 * c + q AS p, substr(h, 2 * q + 1, 2) AS x, CASE WHEN 500 * c + q + 50 <= n THEN md5_number(substr(h, 2 * q + 1, 100)) END AS s FROM b),
f AS (SELECT doc_id, p, x, s IS NOT NULL AND min(doc_id) OVER (PARTITION BY s) < doc_id AS hit FROM g),
c AS (SELECT doc_id, p, x, max(CAST(hit AS integer)) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM c),
t AS (SELECT doc_id, sum(gone) AS n_removed, sum(CASE WHEN gone = 1 AND before = 0 THEN 1 ELSE 0 END) AS n_spans,
             sha256(unhex(coalesce(string_agg(x, '' ORDER BY p) FILTER (gone = 0), ''))) AS kept_sha256 FROM k GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(n_removed, 0) AS bigint) AS n_removed, CAST(coalesce(n_spans, 0) AS bigint) AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)""",
    "op9_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 3 THEN [array_to_string(l, ' ')]
             ELSE list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 90 * (x.n + y.n - m)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(d, t) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.d, u.b FROM r JOIN u ON r.t = u.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(t) FROM r WHERE r.d = d.doc_id) AS component_id FROM documents d LEFT JOIN n USING (doc_id)""",
}


def _ratio_sql() -> str:
    """The character models of op8: counts by strings of up to six bytes (as hex), level by level."""
    rule = "CASE " + " ".join(
        f"WHEN (host = '{at}' OR host LIKE '%.{at}') AND path LIKE '{start}%' THEN '{verdict} {at}{start}'" for verdict, at, start in sorted(URL_RULES, key=lambda r: -len(r[1]) - len(r[2]))
    ) + " END"
    step = "CASE WHEN x.n_{0} > 0 THEN (coalesce(s.c_{0}, 0) + x.t_{0} * p_{0}) / CAST(x.n_{0} + x.t_{0} AS double) ELSE p_{0} END AS p_{0}"
    levels = ",\n".join(
        f"l{n} AS (SELECT gram, {step.format('allow')}, {step.format('block')} FROM l{n - 1} LEFT JOIN s ON s.suffix = right(gram, {2 * n + 2}) LEFT JOIN x ON x.context = substr(gram, {11 - 2 * n}, {2 * n}))"
        for n in range(6)
    )
    return rf"""
WITH h AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
a AS (SELECT page_id, url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM h),
r AS (SELECT *, {rule} AS hit FROM a),
e AS (SELECT url, any_value(split_part(hit, ' ', 1)) AS verdict, CAST('0x' || substr(md5(url || '{url_filter.SEED}'), 1, 8) AS bigint) % 4 = 3 AS held FROM r GROUP BY url),
g AS (SELECT url, verdict, held, substr(repeat('02', 5) || hex(encode(url)) || '03', 2 * p + 1, 12) AS gram
      FROM (SELECT *, unnest(range(0, octet_length(encode(url)) + 1)) AS p FROM e)),
c AS (SELECT gram, count(*) FILTER (verdict = 'allow') AS c_allow, count(*) FILTER (verdict = 'block') AS c_block FROM g WHERE verdict IS NOT NULL AND NOT held GROUP BY gram),
s AS (SELECT right(gram, 2 * n + 2) AS suffix, sum(c_allow) AS c_allow, sum(c_block) AS c_block FROM c, range(6) t(n) GROUP BY ALL),
x AS (SELECT substr(suffix, 1, length(suffix) - 2) AS context, sum(c_allow) AS n_allow, sum(c_block) AS n_block,
             count(*) FILTER (c_allow > 0) AS t_allow, count(*) FILTER (c_block > 0) AS t_block FROM s GROUP BY ALL),
w AS (SELECT url, gram FROM g WHERE verdict IS NULL OR held),
l_ AS (SELECT DISTINCT gram, 1 / 256 AS p_allow, 1 / 256 AS p_block FROM w),
{levels.replace("FROM l-1", "FROM l_")},
f AS (SELECT url, CASE WHEN url = '' THEN 0.0 ELSE CAST(sum(CAST(round((log2(p_allow) - log2(p_block)) * {url_filter.SCALE}) AS bigint)) AS double) / {url_filter.SCALE} / octet_length(encode(url)) END AS figure
      FROM w JOIN l5 USING (gram) GROUP BY url),
k AS (SELECT CAST(round(figure * {url_filter.GRID}) AS bigint) AS cell, count(*) FILTER (verdict = 'allow') AS na, count(*) FILTER (verdict = 'block') AS nb FROM f JOIN e USING (url) WHERE verdict IS NOT NULL GROUP BY 1),
m AS (SELECT cell, lead(cell) OVER (ORDER BY cell) AS next, sum(nb * (SELECT sum(na) FROM k) - na * (SELECT sum(nb) FROM k)) OVER (ORDER BY cell) AS gain FROM k),
b AS (SELECT coalesce((SELECT (cell + next) / 2 / {url_filter.GRID} FROM m WHERE next IS NOT NULL AND gain > 0 ORDER BY gain DESC, cell LIMIT 1), (SELECT (min(cell) - 0.5) / {url_filter.GRID} FROM m)) AS cut)
SELECT page_id, host, path, nullif(split_part(hit, ' ', 2), '') AS rule, figure,
       coalesce(split_part(hit, ' ', 1), CASE WHEN figure >= (SELECT cut FROM b) THEN 'allow' ELSE 'block' END) AS verdict
FROM r LEFT JOIN (SELECT f.* FROM f JOIN e USING (url) WHERE verdict IS NULL) f USING (url)"""


ORACLE["op8_url_filter"] = _ratio_sql()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
