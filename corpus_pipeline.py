"""A corpus pipeline: quality rules, exact and near dedup, mixing, byte-pair encoding.

Each stage takes the documents that its predecessor kept, as (spark, docs, sf_dir), and
returns documents with the same columns; the last one returns their token ids. Near
duplicates are judged on five-word shingles at a similarity of 0.8; of each group the
document with the smallest doc_id stays. The mix repeats and cuts documents to reach its
targets: per document and pass there is a row with the words taken.

Nulls, empty and very long texts, ties and repeated rows have the results that the stages'
operators state; rows are found again by doc_id and 128 bits of their text, so null and repeated
ids do no harm. Further columns, whatever their names, go through all stages but the last; an
empty table gives no rows.

SQL expresses neither the tokenisers nor the mix, so ORACLE_SQL is None; the tests hold
the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import bpe, exact_dedup, fertility, jaccard_join, mixing
from lodestone.llm.common import Scratch
from lodestone.llm.queries import BYTE_JSON, FERTILITY_PATHS, PATTERN


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fertility.keep_fertile(docs, *FERTILITY_PATHS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_exact(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.5, cap=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.token_documents(docs, BYTE_JSON, PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written before the next one reads it."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), drop=[docs])
    return STAGES[-1][1](spark, docs, sf_dir)
