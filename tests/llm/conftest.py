import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture
def docs(spark):
    """Makes documents from texts or (doc_id, text[, lang[, source]]) rows; some extra columns clash."""

    def make(rows, extra=False):
        full = []
        for k, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (k, row)
            doc_id, text, lang, source = (*row, *(None,) * (4 - len(row)))
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            for name in ("node", "n", "copy", "slot", "ord", "token", "kept", "size", "bucket", "_key"):
                df = df.withColumn(name, df.doc_id.cast("string"))
        return df

    return make


@pytest.fixture
def prose():
    """A generator of invented texts."""

    def make(words, seed):
        r = random.Random(seed)
        parts = ["the", "re", "ing", "on", "st", "an", "is", "ou", "é", "lo", "mi"]
        return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) + r.choice(["", "", ",", "."]) for _ in range(words))

    return make


ODD = [None, "", " ", "\n\t", "x", "A" * 3000, "the end", "THE END", "the  end\n", "é 中 😀"]
