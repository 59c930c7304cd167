"""Every query with SQL against DuckDB, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plain(v):
    if v is None or isinstance(v, float) and v != v:
        return "NULL"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_duckdb(spark, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(columns).collect())
    with duckdb.connect() as c:
        for p in Path(DATA).glob("*.parquet"):
            c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        relation = c.sql(entry.oracle_sql()[name])
        assert sorted(relation.columns) == columns
        theirs = sorted(tuple(map(plain, r)) for r in relation.select(*(f'"{k}"' for k in columns)).fetchall())
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_caps_decide_on_all_rows(spark, tmp_path):
    rows = [(1, "a" * 4096), (2, "é" * 2049), (3, None), (4, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {n: {r.doc_id: r[1] for r in entry.queries()[n](spark, str(tmp_path)).collect()} for n in ("text_cap", "binary_cap")}
    assert got == {"text_cap": {1: 4096, 2: None, 3: None, 4: 0}, "binary_cap": {1: 1, 2: 1, 3: None, 4: 0}}
