import json
import sqlite3

import pyarrow as pa
import pytest

from lodestone.errors import BindParameters, ExecuteStatement, MetadataUnavailable, PreparingStatement, ReadingBatch
from lodestone.functions.inference import ColumnDescriptor
from lodestone.operators.chunks import chunked
from lodestone.operators.limits import ReaderOptions
from lodestone.plans import session
from lodestone.sources import dbapi, jdbc
from lodestone.streaming.sink import write_stream
from lodestone.types import Logical

URL = "jdbc:derby:memory:tests;create=true"


def fresh(spark, name, columns):
    try:
        jdbc.execute(spark, URL, f"DROP TABLE {name}", driver=jdbc.DERBY_DRIVER)
    except Exception:  # noqa: BLE001
        pass
    jdbc.execute(spark, URL, f"CREATE TABLE {name} ({columns})", driver=jdbc.DERBY_DRIVER)


def test_describe_without_rows(spark):
    fresh(spark, "DESCRIBED", "A REAL NOT NULL, B DECIMAL(7,2), C VARCHAR(50), D CHAR(5) FOR BIT DATA")
    columns, name = jdbc.describe(spark, URL, "SELECT * FROM DESCRIBED", jdbc.DERBY_DRIVER)
    assert [(c.name, c.sql_type, c.nullable) for c in columns] == [("A", "real", False), ("B", "decimal", True), ("C", "varchar", True), ("D", "binary", True)]
    assert name == "Apache Derby" and columns[2].length == 50
    with pytest.raises(MetadataUnavailable):
        jdbc.describe(spark, URL, "SELECT * FROM MISSING", jdbc.DERBY_DRIVER)


def test_jdbc_round_trip(spark):
    fresh(spark, "TRIP", "A INT, B VARCHAR(20), C TIME")
    df = spark.sql("SELECT * FROM VALUES (1, 'Hello'), (CAST(NULL AS int), 'none'), (3, 'Frühstück µ') t(a, b)")
    jdbc.execute(spark, URL, "INSERT INTO TRIP VALUES (9, 'x', TIME('12:34:56'))", driver=jdbc.DERBY_DRIVER)
    jdbc.insert(df.selectExpr("a AS A", "b AS B"), URL, "TRIP", 2, jdbc.DERBY_DRIVER)
    back = jdbc.scan(spark, URL, "SELECT * FROM TRIP", ReaderOptions(max_text_size=20), jdbc.DERBY_DRIVER)
    assert sorted(back.collect(), key=lambda r: r.A or 0) == [(None, "none", None), (1, "Hello", None), (3, "Frühstück µ", None), (9, "x", 45_296)]
    plan = back.where("A = 2").select("B")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(A,2)" in plan and "C" not in plan.split("ReadSchema")[-1]


@pytest.fixture
def base(tmp_path):
    path = str(tmp_path / "db.sqlite")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE t (a INTEGER, b TEXT)")
    return {"database": path, "timeout": 60}


def test_dbapi_chunks_span_batches(spark, base):
    writer = dbapi.DbApiWriter({"module": "sqlite3", "connect": json.dumps(base), "statement": "INSERT INTO t VALUES (?, ?)", "row_capacity": 5})
    batches = [pa.RecordBatch.from_pydict({"a": list(range(k, k + n)), "b": ["x"] * n}) for k, n in ((0, 3), (3, 8), (11, 1))]
    assert writer.write(iter(batches)).chunks == [5, 5, 2]


@pytest.mark.parametrize("prefetch", [False, True])
def test_dbapi_scan(spark, base, prefetch):
    dbapi.insert(spark.range(10).selectExpr("id AS a", "CAST(id AS string) AS b").coalesce(1), "sqlite3", base, "t", 3)
    rows = dbapi.scan(spark, "sqlite3", base, "SELECT a, b FROM t WHERE a % 2 = ?", "a long, b string", [[0], [1]], 2, prefetch)
    assert rows.rdd.getNumPartitions() == 2 and sorted(r.a for r in rows.collect()) == list(range(10))
    assert dbapi.scan(spark, "sqlite3", base, "SELECT a, b FROM t WHERE a < ?", "a long, b string", [[0]]).collect() == []
    with pytest.raises(Exception, match="no such table"):
        dbapi.scan(spark, "sqlite3", base, "SELECT a FROM missing", "a long", prefetch=prefetch).collect()


def test_dbapi_any_statement(spark, base):
    dbapi.insert(spark.range(4).selectExpr("id AS a", "'x' AS b").coalesce(1), "sqlite3", base, "t")
    dbapi.execute_many(spark.range(2).selectExpr("'y' AS b", "id AS a").coalesce(1), "sqlite3", base, "UPDATE t SET b = ? WHERE a = ?", 1)
    with sqlite3.connect(base["database"]) as c:
        assert c.execute("SELECT a, b FROM t ORDER BY a").fetchall() == [(0, "y"), (1, "y"), (2, "x"), (3, "x")]
    with pytest.raises(PreparingStatement):
        dbapi.insert(spark.range(1), "sqlite3", base, "missing")
    with pytest.raises(BindParameters):
        dbapi.execute_many(spark.range(1), "sqlite3", base, "DELETE FROM t WHERE a = ? AND b = ?")


def test_prefetch_gives_errors_and_ends():
    def broken():
        yield 1
        raise ValueError("late")

    got = dbapi.prefetched(broken())
    assert next(got) == 1
    with pytest.raises(ValueError, match="late"):
        next(got)
    assert list(dbapi.prefetched(iter(()))) == []


def test_script(spark):
    results = session.script(spark, "SELECT ';' AS a; -- not; here\nCREATE OR REPLACE TEMP VIEW v AS SELECT 2 AS b; /* ; */ SELECT b FROM v;")
    assert [r.columns for r in results] == [["a"], [], ["b"]] and results[2].first().b == 2
    assert session.statements(" ; ") == []
    assert session.run(spark, "SELECT :x + 1 AS y", {"x": 2}).first().y == 3


@pytest.mark.parametrize("capacity", [1, 4, 10, 100])
def test_chunks(spark, capacity):
    rows = chunked(spark.range(25), ["id"], capacity).collect()
    assert sorted((r.id, r.chunk) for r in rows) == [(k, k // capacity) for k in range(25)]
    assert chunked(spark.range(0), ["id"], capacity).collect() == []


def test_stream_into_database(spark, base, tmp_path):
    spark.range(7).selectExpr("id AS a", "'s' AS b").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("a long, b string").parquet(str(tmp_path / "in"))
    write_stream(stream, lambda batch: dbapi.insert(batch.coalesce(1), "sqlite3", base, "t"), str(tmp_path / "cp")).awaitTermination()
    assert dbapi.scan(spark, "sqlite3", base, "SELECT a, b FROM t", "a long, b string").count() == 7


def test_explicit_schema_of_scan(spark):
    fresh(spark, "TYPED", "A BIGINT")
    jdbc.execute(spark, URL, "INSERT INTO TYPED VALUES (5)", driver=jdbc.DERBY_DRIVER)
    back = jdbc.scan(spark, URL, "SELECT * FROM TYPED", ReaderOptions(schema=[("renamed", Logical("int32"))]), jdbc.DERBY_DRIVER)
    assert back.dtypes == [("renamed", "int")] and back.first().renamed == 5


STUB = """
import json, sqlite3
paramstyle = "named"

class Cursor:
    def __init__(self, c): self.c, self.left = c, []
    def execute(self, sql, params=()):
        self.left = [s for s in sql.split(";") if s.strip()]
        self.nextset()
    def nextset(self):
        if not self.left: return None
        self.c.execute(self.left.pop(0)); return True
    def executemany(self, sql, rows): self.c.executemany(sql, rows)
    def fetchmany(self, n): return self.c.fetchmany(n)

class Connection:
    def __init__(self, **k): self.c = sqlite3.connect(**k)
    def cursor(self): return Cursor(self.c.cursor())
    def commit(self): self.c.commit()
    def close(self): self.c.close()

connect = Connection
"""


@pytest.fixture
def named_driver(spark, tmp_path, monkeypatch):
    """A database module with named placeholders, several result sets and no EXPLAIN."""
    name = f"stub_{tmp_path.name.replace('-', '_')}"
    (tmp_path / f"{name}.py").write_text(STUB)
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / f"{name}.py"))
    return name


def test_named_placeholders(spark, base, named_driver):
    dbapi.insert(spark.range(4).selectExpr("id AS a", "'x' AS b").coalesce(1), named_driver, base, "t", 3)
    dbapi.execute_many(spark.range(2).selectExpr("'y' AS b", "id AS a").coalesce(1), named_driver, base, "UPDATE t SET b = :b WHERE a = :a AND b <> ':c'")
    with sqlite3.connect(base["database"]) as c:
        assert c.execute("SELECT a, b FROM t ORDER BY a").fetchall() == [(0, "y"), (1, "y"), (2, "x"), (3, "x")]
    with pytest.raises(BindParameters):
        dbapi.execute_many(spark.range(1), named_driver, base, "DELETE FROM t WHERE a = :other")
    with pytest.raises(ExecuteStatement):
        dbapi.insert(spark.range(1), named_driver, base, "missing")


def test_several_result_sets(spark, base, named_driver):
    one, none, two = dbapi.result_sets(spark, named_driver, base, "SELECT 1; CREATE TABLE u (a INTEGER); SELECT 2, 'b'", ["a int", None, "a int, b string"])
    assert one.collect() == [(1,)] and none.columns == []
    with sqlite3.connect(base["database"]) as c:
        c.execute("DROP TABLE IF EXISTS u")
    assert two.collect() == [(2, "b")]


def test_jdbc_result_sets(spark):
    fresh(spark, "SETS", "A INT")
    results = jdbc.result_sets(spark, URL, "SELECT 1 AS A, 'x' AS B FROM SYSIBM.SYSDUMMY1", jdbc.DERBY_DRIVER)
    assert [r.collect() for r in results] == [[(1, "x")]] and results[0].dtypes == [("A", "int"), ("B", "string")]
    assert [r.columns for r in jdbc.result_sets(spark, URL, "INSERT INTO SETS VALUES (1)", jdbc.DERBY_DRIVER)] == [[]]


def test_limits_of_a_reader(spark, base):
    dbapi.insert(spark.range(10).selectExpr("id AS a", "CAST(id AS string) AS b").coalesce(1), "sqlite3", base, "t")
    columns = [ColumnDescriptor("a", "bigint", nullable=False), ColumnDescriptor("b", "varchar", length=4)]
    options = ReaderOptions(max_bytes_per_batch=3 * (16 + 8 + 17) + 5)
    out = dbapi.scan(spark, "sqlite3", base, "SELECT a, b FROM t ORDER BY a", columns=columns, options=options, batch_column="k")
    assert [(r.a, r.k) for r in sorted(out.collect())] == [(k, k // 3) for k in range(10)]
    assert out.schema["a"].metadata["nullable"] is False
    typed = dbapi.scan(spark, "sqlite3", base, "SELECT a, '1.50', '12:00:01', '2020-01-02' FROM t", columns=[ColumnDescriptor("a", "smallint"), ColumnDescriptor("d", "decimal", 5, 2), ColumnDescriptor("t", "time"), ColumnDescriptor("day", "date")])
    assert typed.dtypes == [("a", "smallint"), ("d", "decimal(5,2)"), ("t", "int"), ("day", "date")] and str(typed.first().d) == "1.50"


def test_rows_that_cannot_be_made(spark, base):
    with pytest.raises(ReadingBatch):
        dbapi.insert(spark.sql("SELECT CAST(raise_error('no rows') AS bigint) AS a, 'x' AS b").coalesce(1), "sqlite3", base, "t")


def test_trimmed_scan_and_pushed_decimals(spark):
    fresh(spark, "FIXED", "A CHAR(6), D DECIMAL(10,2), N INT NOT NULL")
    jdbc.execute(spark, URL, "INSERT INTO FIXED VALUES ('ab', 7.5, 1)", driver=jdbc.DERBY_DRIVER)
    trimmed = jdbc.scan(spark, URL, "SELECT * FROM FIXED", ReaderOptions(trim_fixed_sized_characters=True), jdbc.DERBY_DRIVER)
    assert trimmed.first().A == "ab" and jdbc.scan(spark, URL, "SELECT * FROM FIXED", None, jdbc.DERBY_DRIVER).first().A == "ab    "
    plan = trimmed.where("D > 5")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(D,5.00)" in plan
    assert [f.metadata["nullable"] for f in trimmed.schema] == [True, True, False]


def test_chunks_with_ties(spark):
    rows = chunked(spark.range(40).selectExpr("id % 3 AS k", "id"), ["k"], 7).collect()
    assert len(rows) == 40 and sorted(r.chunk for r in rows) == [k // 7 for k in range(40)]
    assert [r.k for r in sorted(rows, key=lambda r: (r.chunk, r.k))] == sorted(k % 3 for k in range(40))
