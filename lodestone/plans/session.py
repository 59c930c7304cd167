"""SQL pass-through: one statement with parameters, or a script of several."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run(spark: SparkSession, text: str, args: dict[str, Any] | list | None = None, **tables: DataFrame) -> DataFrame:
    """A statement over the given tables; args bind `:name` or `?` markers."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args) if args is not None else spark.sql(text)


def statements(text: str) -> list[str]:
    """A script cut at semicolons outside quotes and comments."""
    out, start, at = [], 0, 0
    while at < len(text):
        c = text[at]
        if c in "'\"`":
            end = text.find(c, at + 1)
            at = len(text) if end < 0 else end
        elif text.startswith("--", at):
            end = text.find("\n", at)
            at = len(text) if end < 0 else end
        elif text.startswith("/*", at):
            end = text.find("*/", at + 2)
            at = len(text) if end < 0 else end + 1
        elif c == ";":
            out.append(text[start:at])
            start = at + 1
        at += 1
    return [s for s in (*out, text[start:]) if s.strip()]


def script(spark: SparkSession, text: str) -> list[DataFrame]:
    """The result of each statement in order; one without a result has no columns."""
    results = []
    for sql in statements(text):
        df = spark.sql(sql)
        results.append(df)
    return results
