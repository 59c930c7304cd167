"""One query per operator of the exchange, with the SQL that it must agree with.

Values leave as integers, doubles and text, so both engines print them alike.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.errors import ColumnFailure, ExchangeError
from lodestone.functions import read, sqlgen, write
from lodestone.functions.inference import ColumnDescriptor, infer_schema
from lodestone.operators.chunks import chunked
from lodestone.operators.convert import read_projection, write_projection
from lodestone.operators.limits import ReaderOptions, rows_per_batch
from lodestone.plans import session
from lodestone.plans.shared import shared_folder
from lodestone.sources import dbapi, jdbc
from lodestone.types import Logical, check_readable, check_writable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
US = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DERBY = "jdbc:derby:memory:lodestone;create=true"


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")



PASS = """
SELECT l_returnflag, l_linestatus, count(*) AS n,
       CAST(sum(CAST(l_quantity AS decimal(15,2))) AS {text}) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS decimal(15,2))) AS {text}) AS sum_price
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus"""


@query(PASS.format(text="varchar"))
def scan_passthrough(spark: SparkSession, d: str) -> DataFrame:
    sql = PASS.format(text="string").replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return session.run(spark, sql, lineitem=table(spark, d, "lineitem"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def scan_partitioned(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    url = derby_copy(orders, "PART_ORDERS", "O_ORDERKEY BIGINT, O_CUSTKEY BIGINT, O_ORDERSTATUS VARCHAR(1)")
    ends = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    schema = [("o_orderkey", Logical("int64")), ("o_custkey", Logical("int64")), ("o_orderstatus", Logical("utf8"))]
    return jdbc.scan(spark, url, "SELECT * FROM PART_ORDERS", ReaderOptions(schema=schema), jdbc.DERBY_DRIVER, ("O_ORDERKEY", ends[0], ends[1], 4))


def derby_copy(df: DataFrame, name: str, columns: str) -> str:
    """The URL of a new database with the rows of ``df`` that all executors can read."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    url = f"jdbc:derby:{folder}/db"
    jdbc.execute(spark, f"{url};create=true", f"CREATE TABLE {name} ({columns})", driver=jdbc.DERBY_DRIVER)
    jdbc.insert(df, url, name, driver=jdbc.DERBY_DRIVER)
    return jdbc.published(spark, folder, "db")


@query("SELECT c_custkey, c_name FROM customer")
def scan_prefetch(spark: SparkSession, d: str) -> DataFrame:
    where = {"database": sqlite_copy(table(spark, d, "customer").select("c_custkey", "c_name"), "customer", "c_custkey INTEGER, c_name TEXT"), "timeout": 60}
    halves = "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = ?"
    return dbapi.scan(spark, "sqlite3", where, halves, "c_custkey long, c_name string", [[0], [1]], batch_rows=1000, prefetch=True)


def sqlite_copy(df: DataFrame, name: str, columns: str) -> str:
    """A new sqlite file with the rows of ``df``, written by the chunked writer."""
    import sqlite3

    path = os.path.join(shared_folder(df.sparkSession), "db.sqlite")
    with sqlite3.connect(path) as connection:
        connection.execute(f"CREATE TABLE {name} ({columns})")
    dbapi.insert(df.coalesce(1), "sqlite3", {"database": path, "timeout": 60}, name, row_capacity=500)
    return path


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE 1 = 0")
def scan_empty(spark: SparkSession, d: str) -> DataFrame:
    return session.run(spark, "SELECT o_orderkey, o_totalprice FROM orders WHERE 1 = 0", orders=table(spark, d, "orders"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 100")
def param_query(spark: SparkSession, d: str) -> DataFrame:
    sql = "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = :segment AND c_acctbal > :least"
    return session.run(spark, sql, {"segment": "BUILDING", "least": 100}, customer=table(spark, d, "customer"))


@query("SELECT count(*) AS n FROM nation")
def multi_result(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "nation").createOrReplaceTempView("nation")
    results = session.script(spark, "SELECT 1 AS a; SET spark.sql.shuffle.partitions; -- a; comment\nSELECT count(*) AS n FROM nation")
    return results[2]


@query("SELECT CAST(o_orderkey AS integer) AS k, CAST(CAST(o_totalprice AS decimal(15,2)) AS varchar) AS price, CAST(CAST(o_orderdate AS date) AS varchar) AS day, strftime(date_trunc('second', o_orderdate), '%Y-%m-%d %H:%M:%S') AS ts FROM orders")
def explicit_schema(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(15,2)"), "o_orderdate", F.col("o_orderdate").alias("again"))
    schema = [("k", Logical("int32")), ("price", Logical("decimal", precision=15, scale=2)), ("day", Logical("date")), ("ts", Logical("timestamp", unit="s"))]
    out = read_projection(source, schema)
    return out.select("k", F.col("price").cast("string").alias("price"), F.col("day").cast("string").alias("day"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("SELECT l_orderkey AS i64, l_linenumber AS i32, CAST(l_linenumber AS smallint) AS i16, CAST(l_linenumber AS tinyint) AS i8, CAST(CAST(l_quantity AS integer) % 256 AS smallint) AS u8 FROM lineitem")
def read_ints(spark: SparkSession, d: str) -> DataFrame:
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    small = F.col("l_quantity").cast("int") % 256
    return table(spark, d, "lineitem").select(*(read.identical(c, k).alias(n) for c, k, n in ((key, "int64", "i64"), (line, "int32", "i32"), (line, "int16", "i16"), (line, "int8", "i8"), (small, "uint8", "u8"))))


@query("SELECT l_orderkey, l_linenumber, l_linenumber % 2 = 1 AS b FROM lineitem")
def read_bool(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", read.boolean(F.col("l_linenumber") % 2).alias("b"))


@query("SELECT l_orderkey, l_linenumber, coalesce(CAST(CAST(CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity > 25 END AS tinyint) AS varchar), 'NULL') AS bit FROM lineitem")
def write_bool(spark: SparkSession, d: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") != "A", F.col("l_quantity") > 25)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.coalesce(write.bit(flag).cast("string"), F.lit("NULL")).alias("bit"))


@query("SELECT event_id, CAST(CAST(value AS float) AS double) AS f32, value AS f64 FROM events")
def read_floats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", write.widened(F.col("value")).cast("double").alias("f32"), read.identical(F.col("value"), "float64").alias("f64"))


@query("SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS date)) AS integer) AS days, CAST(CAST(o_orderdate AS date) AS varchar) AS day FROM orders")
def date_days(spark: SparkSession, d: str) -> DataFrame:
    days = read.date_days(F.col("o_orderdate").cast("date"))
    return table(spark, d, "orders").select("o_orderkey", days.alias("days"), write.date_from_days(days).cast("string").alias("day"))


@query("SELECT event_id, CAST(floor(epoch_us(ts) / 1e6) AS bigint) AS s, CAST(floor(epoch_us(ts) / 1e3) AS bigint) AS ms, epoch_us(ts) AS us FROM events")
def ts_epoch(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", *(read.epoch(F.col("ts"), u).alias(u) for u in ("s", "ms", "us")))


@query("SELECT event_id, epoch_ns(ts) AS ns FROM events")
def ts_ns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", read.epoch_ns(F.col("ts")).alias("ns"))


@query("SELECT o_orderkey, coalesce(CAST(TRY_CAST(CAST(epoch_us(o_orderdate + INTERVAL 264 YEAR) AS hugeint) * 1000 AS bigint) AS varchar), 'NULL') AS ns FROM orders")
def ns_or_null(spark: SparkSession, d: str) -> DataFrame:
    later = F.expr("o_orderdate + interval 264 years")
    return table(spark, d, "orders").select("o_orderkey", F.coalesce(read.epoch_ns(later, or_null=True).cast("string"), F.lit("NULL")).alias("ns"))


TICKS = "SELECT event_id, CAST({0} // 1000000 AS integer) AS s, CAST({0} // 1000 AS integer) AS ms, {0} AS us, {0} * 1000 AS ns FROM (SELECT event_id, epoch_us(ts) % 86400000000 AS t FROM events)"


@query(TICKS.format("t"))
def time_ticks(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    form = {"s": "HH:mm:ss", "ms": "HH:mm:ss.SSS", "us": "HH:mm:ss.SSSSSS", "ns": "HH:mm:ss.SSSSSS"}
    return table(spark, d, "events").select("event_id", *(read.time_ticks(F.date_format(ts, f), u).alias(u) for u, f in form.items()))


@query("SELECT event_id, strftime(ts, '%H:%M:%S') AS s, strftime(ts, '%H:%M:%S.%g') AS ms, strftime(ts, '%H:%M:%S.%f') AS us, strftime(ts, '%H:%M:%S.%f') || '000' AS ns FROM events")
def time_text(spark: SparkSession, d: str) -> DataFrame:
    of_day = F.unix_micros(F.col("ts").cast("timestamp")) % F.lit(86_400_000_000)
    ticks = {"s": F.floor(of_day / 1_000_000), "ms": F.floor(of_day / 1000), "us": of_day, "ns": of_day * 1000}
    return table(spark, d, "events").select("event_id", *(write.time_text(t, u).alias(u) for u, t in ticks.items()))


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS s, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') AS ms, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS us FROM events")
def ts_from_epoch(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, d, "events").select("event_id", *(F.date_format(write.timestamp_from_epoch(read.epoch(ts, u), u), US).alias(u) for u in ("s", "ms", "us")))


NANOS = "epoch_ns(ts) * (CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END) + event_id % 1000"


def nanos() -> Column:
    """Nanoseconds on both sides of 1970, not all multiples of a hundred."""
    return read.epoch_ns(F.col("ts")) * F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1) + F.col("event_id") % 1000


@query(f"SELECT event_id, (CASE WHEN n < 0 THEN -((-n) // 100) ELSE n // 100 END) * 100 AS ns FROM (SELECT event_id, {NANOS} AS n FROM events)")
def ns_trunc(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", write.truncated_ns(nanos()).alias("ns"))


@query(
    f"""SELECT event_id, strftime(make_timestamp(CAST(floor(t / 1e7) AS bigint) * 1000000), '%Y-%m-%d %H:%M:%S') || '.' || lpad(CAST(((t % 10000000) + 10000000) % 10000000 AS varchar), 7, '0') AS ns
    FROM (SELECT event_id, CASE WHEN n < 0 THEN -((-n) // 100) ELSE n // 100 END AS t FROM (SELECT event_id, {NANOS} AS n FROM events))"""
)
def ns_sink(spark: SparkSession, d: str) -> DataFrame:
    """Through the projection that every sink uses."""
    rows = table(spark, d, "events").select("event_id", nanos().alias("ns", metadata=Logical("timestamp", unit="ns").field("ns").metadata))
    return write_projection(rows)


def zone_sql(zone: str, name: str) -> str:
    local = f"timezone('{zone}', timezone('UTC', t))"
    off = f"date_diff('second', t, {local})"
    return f"strftime({local}, '%Y-%m-%d %H:%M:%S.%f') || printf('%s%02d:%02d', CASE WHEN {off} < 0 THEN '-' ELSE '+' END, CAST(abs({off}) // 3600 AS integer), CAST(abs({off}) % 3600 // 60 AS integer)) AS {name}"


ZONES = {"berlin": "Europe/Berlin", "kolkata": "Asia/Kolkata", "new_york": "America/New_York"}


@query(f"SELECT o_orderkey, {', '.join(zone_sql(z, n) for n, z in ZONES.items())} FROM (SELECT o_orderkey, make_timestamp(epoch_us(o_orderdate) + o_orderkey * 7919 % 1000000) AS t FROM orders)")
def ts_tz_text(spark: SparkSession, d: str) -> DataFrame:
    ticks = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") * 7919 % 1_000_000
    return table(spark, d, "orders").select("o_orderkey", *(write.timestamp_tz_text(ticks, "us", z).alias(n) for n, z in ZONES.items()))


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS decimal(15,2)) AS varchar) AS price FROM lineitem")
def decimal_parse(spark: SparkSession, d: str) -> DataFrame:
    text = F.translate(F.col("l_extendedprice").cast("decimal(15,2)").cast("string"), ".", ",")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", read.decimal_text(text, 15, 2).cast("string").alias("price"))


DECIMAL = "(CASE WHEN {0} < 0 THEN '-' ELSE '+' END) || lpad(CAST(abs({0}) AS varchar), {1}, '0')"


@query(f"SELECT c_custkey, {DECIMAL.format('CAST(c_acctbal AS decimal(15,2))', 16)} AS p15s2, {DECIMAL.format('CAST(round(c_acctbal) AS decimal(10,0))', 10)} AS p10s0, {DECIMAL.format('CAST(c_custkey AS decimal(9,0))', 9)} || '00' AS p9sm2 FROM customer")
def decimal_text(spark: SparkSession, d: str) -> DataFrame:
    money = F.col("c_acctbal").cast("decimal(15,2)")
    return table(spark, d, "customer").select(
        "c_custkey",
        write.decimal_text(money, 15, 2).alias("p15s2"),
        write.decimal_text(F.round("c_acctbal").cast("decimal(10,0)"), 10, 0).alias("p10s0"),
        write.decimal_text(F.col("c_custkey").cast("decimal(9,0)"), 9, -2).alias("p9sm2"),
    )


@query("SELECT p, s, CASE WHEN s < 0 THEN p - s + 1 WHEN s = 0 THEN p + 1 ELSE p + 2 END AS width FROM range(1, 39) a(p), range(-3, 11) b(s)")
def decimal_text_len(spark: SparkSession, d: str) -> DataFrame:
    rows = [(p, s, write.decimal_width(p, s)) for p in range(1, 39) for s in range(-3, 11)]
    return spark.createDataFrame(rows, "p long, s long, width long")


@query("SELECT lang, CAST(coalesce(max(octet_length(encode(text))), 0) AS integer) AS longest FROM documents GROUP BY lang")
def text_max_len(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("lang").agg(write.longest(F.col("text")).alias("longest"))


@query("SELECT * FROM (VALUES (1, true, 'Hello'), (2, false, 'Hello�'), (3, true, 'Ü™가'), (4, false, '�(')) t(id, valid, lossy)")
def utf8_validate(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.sql("SELECT * FROM VALUES (1, X'48656c6c6f'), (2, X'48656c6c6fc3'), (3, X'c39ce284a2eab080'), (4, X'c328') t(id, raw)")
    text = F.col("raw").cast("string")
    return rows.select("id", read.text_utf8(F.col("raw"), or_null=True).isNotNull().alias("valid"), F.make_valid_utf8(text).alias("lossy"))


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def utf16_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(read.text_utf16(write.text_utf16(F.col("text"))).cast("binary")).alias("digest"))


@query("SELECT n_nationkey, n_name AS name FROM nation")
def trim_char(spark: SparkSession, d: str) -> DataFrame:
    """A scan of a padded column that trims, as the option says."""
    nation = table(spark, d, "nation").select("n_nationkey", F.concat(F.lit(" "), "n_name").alias("name"))
    url = derby_copy(nation, "PADDED", "N_NATIONKEY INT, NAME CHAR(40)")
    schema = [("n_nationkey", Logical("int32")), ("name", Logical("utf8"))]
    return jdbc.scan(spark, url, "SELECT * FROM PADDED", ReaderOptions(schema=schema, trim_fixed_sized_characters=True), jdbc.DERBY_DRIVER)


@query("SELECT doc_id, CAST(CASE WHEN octet_length(encode(text)) <= 4096 THEN octet_length(encode(text)) END AS integer) AS size FROM documents")
def text_cap(spark: SparkSession, d: str) -> DataFrame:
    """Of every document what the cap decides: its size, or null beyond it."""
    return table(spark, d, "documents").select("doc_id", F.octet_length(read.capped(F.col("text"), 4096, "text", or_null=True)).alias("size"))


@query("SELECT doc_id, CAST(octet_length(encode(text)) > 1024 AS integer) AS beyond FROM documents")
def binary_cap(spark: SparkSession, d: str) -> DataFrame:
    raw = F.col("text").cast("binary")
    beyond = read.capped(raw, 1024, "binary", or_null=True).isNull()
    return table(spark, d, "documents").select("doc_id", F.when(raw.isNotNull(), beyond.cast("int")).alias("beyond"))


@query("SELECT doc_id, octet_length(encode(text)) AS size, md5(text) AS digest FROM documents")
def binary_rt(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts as variable and as fixed-size binary through a database and back."""
    docs = table(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("raw"))
    where = {"database": sqlite_copy(docs, "raw", "doc_id INTEGER, raw BLOB"), "timeout": 60}
    columns = [ColumnDescriptor("doc_id", "bigint"), ColumnDescriptor("raw", "longvarbinary")]
    back = dbapi.scan(spark, "sqlite3", where, "SELECT doc_id, raw FROM raw", columns=columns, options=ReaderOptions(max_binary_size=1 << 20))
    return back.select("doc_id", F.octet_length("raw").cast("long").alias("size"), F.md5("raw").alias("digest"))


@query("SELECT doc_id, CAST(16 AS bigint) AS size, md5(text) AS digest FROM documents")
def binary_fixed(spark: SparkSession, d: str) -> DataFrame:
    """A fixed-size column, the digests of whole texts, through a database and back."""
    docs = table(spark, d, "documents").select("doc_id", F.unhex(F.md5("text")).alias("raw"))
    where = {"database": sqlite_copy(docs, "raw", "doc_id INTEGER, raw BLOB"), "timeout": 60}
    columns = [ColumnDescriptor("doc_id", "bigint"), ColumnDescriptor("raw", "binary", length=16)]
    back = dbapi.scan(spark, "sqlite3", where, "SELECT doc_id, raw FROM raw", columns=columns)
    return back.select("doc_id", F.octet_length("raw").cast("long").alias("size"), F.lower(F.hex("raw")).alias("digest"))


SUNK = f"""
SELECT event_id, strftime(ts, '%H:%M:%S.%f') || '000' AS at,
       strftime(timezone('Europe/Berlin', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S.%f') ||
       printf('%s%02d:%02d', '+', CAST(date_diff('second', ts, timezone('Europe/Berlin', timezone('UTC', ts))) // 3600 AS integer), 0) AS zoned,
       '+' || lpad(CAST(event_id AS varchar), 38, '0') || '00' AS wide, CAST(event_id % 2 AS bigint) AS odd
FROM events"""


@query(SUNK)
def sink_types(spark: SparkSession, d: str) -> DataFrame:
    """Time, zoned timestamp, a decimal of 40 digits with negative scale and a boolean in a database."""
    meta = lambda kind, **more: Logical(kind, **more).field("x").metadata
    ts = F.col("ts").cast("timestamp")
    of_day = F.pmod(F.unix_micros(ts), F.lit(86_400_000_000).cast("long")) * 1000
    rows = table(spark, d, "events").select(
        "event_id",
        of_day.alias("at", metadata=meta("time", unit="ns")),
        ts.alias("zoned", metadata=meta("timestamp", unit="us", tz="Europe/Berlin")),
        F.col("event_id").cast("string").alias("wide", metadata=meta("decimal", precision=38, scale=-2)),
        (F.col("event_id") % 2 == 1).alias("odd"),
    )
    where = {"database": sqlite_copy(rows, "sunk", "event_id INTEGER, at TEXT, zoned TEXT, wide TEXT, odd INTEGER"), "timeout": 60}
    return dbapi.scan(spark, "sqlite3", where, "SELECT * FROM sunk", "event_id long, at string, zoned string, wide string, odd long")


@query(
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_tax AS float) AS double) AS half, CAST(CAST(l_shipdate AS date) AS varchar) AS day,
    strftime(l_shipdate + to_seconds(l_linenumber * 3601), '%H:%M:%S') AS at, CAST(CAST(l_extendedprice AS decimal(15,2)) AS varchar) AS price,
    CAST(l_linenumber * 36 AS smallint) AS u8, l_comment FROM (SELECT *, l_returnflag || 'ü' AS l_comment FROM lineitem)"""
)
def write_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Columns of most kinds through the projection of the sinks, two of them declared without nulls."""
    meta = lambda kind, **more: Logical(kind, **more).field("x").metadata
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("long")
    seconds = F.pmod(F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + F.col("l_linenumber") * 3601, F.lit(86_400).cast("long"))
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("l_orderkey", metadata={"nullable": False}),
        F.col("l_linenumber").alias("l_linenumber", metadata={"nullable": False}),
        F.col("l_tax").cast("float").alias("half", metadata=meta("float16")),
        (day * 86_400_000 + 1).alias("day", metadata=meta("date64")),
        seconds.cast("int").alias("at", metadata=meta("time", unit="s")),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("price", metadata=meta("decimal", precision=15, scale=2)),
        (F.col("l_linenumber") * 36).cast("smallint").alias("u8", metadata=meta("uint8")),
        F.concat("l_returnflag", F.lit("ü")).alias("l_comment"),
    )
    out = write_projection(rows)
    return out.withColumns({"half": F.col("half").cast("double"), "day": F.col("day").cast("string"), "price": F.col("price").cast("string")})


def refusals() -> list[tuple[str, str, str, int]]:
    """What is refused before any row moves: the case, the error, and the column if it is named."""
    one = Logical("int32")
    cases = {
        "unsigned 16": lambda: check_readable([("a", one), ("b", Logical("uint16"))]),
        "negative scale": lambda: check_readable([("a", Logical("decimal", precision=3, scale=-2))]),
        "zone on a read": lambda: check_readable([("t", Logical("timestamp", unit="s", tz="UTC"))]),
        "list to a sink": lambda: check_writable([("l", Logical("list"))]),
        "bad zone": lambda: check_writable([("t", Logical("timestamp", unit="s", tz="Foobar"))]),
        "binary without length": lambda: infer_schema([ColumnDescriptor("k", "integer"), ColumnDescriptor("b", "binary")]),
        "text without bound": lambda: ReaderOptions().max_rows_per_batch([ColumnDescriptor("a", "varchar")], [Logical("utf8")]),
        "unknown text length": lambda: ReaderOptions().max_rows_per_batch([ColumnDescriptor("a", "varchar", length=-4)], [Logical("utf8")]),
        "batch below a row": lambda: ReaderOptions(max_bytes_per_batch=1).max_rows_per_batch([ColumnDescriptor("a", "integer")], [one]),
        "allocation": lambda: ReaderOptions(fallible_allocations=True, allocation_limit=1000).max_rows_per_batch([ColumnDescriptor("a", "varchar", length=512)], [Logical("utf8")]),
        "placeholders": lambda: dbapi.execute_many(SparkSession.active().range(1), "sqlite3", {"database": ":memory:"}, "DELETE FROM t WHERE a = ? AND b = ?"),
        "statement": lambda: dbapi.execute_many(SparkSession.active().range(1), "sqlite3", {"database": ":memory:"}, "INSERT INTO missing VALUES (?)"),
        "description": lambda: jdbc.describe(SparkSession.active(), DERBY, "SELECT * FROM MISSING", jdbc.DERBY_DRIVER),
    }
    out = []
    for case, run in cases.items():
        try:
            run()
            out.append((case, "none", "", -1))
        except ExchangeError as e:
            named = isinstance(e, ColumnFailure)
            out.append((case, type(e.reason if named else e).__name__, e.name if named else "", e.index if named else -1))
    return out


REFUSED = [
    ("unsigned 16", "UnsupportedType", "b", 1), ("negative scale", "UnsupportedType", "a", 0), ("zone on a read", "UnsupportedType", "t", 0), ("list to a sink", "UnsupportedForInsertion", "", -1),
    ("bad zone", "InvalidTimeZone", "", -1), ("binary without length", "ZeroSizedColumn", "b", 1), ("text without bound", "ZeroSizedColumn", "a", 0), ("unknown text length", "UnknownStringLength", "a", 0),
    ("batch below a row", "BufferTooSmall", "", -1), ("allocation", "TooLarge", "a", 0), ("placeholders", "BindParameters", "", -1), ("statement", "PreparingStatement", "", -1), ("description", "MetadataUnavailable", "", -1),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}', {k})" for a, b, c, k in REFUSED) + ") t(refused, error, name, place)")
def errors_at_build(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(refusals(), "refused string, error string, name string, place int")


WIDTHS = (0, 1, 8, 100, 8_192, 10_000, 1 << 20, 512 << 20)


@query("SELECT CAST(w AS bigint) AS width, CAST(CASE WHEN w = 0 THEN 536870912 ELSE least(65535, 536870912 // w) END AS bigint) AS n_rows FROM (VALUES " + ", ".join(f"({w})" for w in WIDTHS) + ") t(w)")
def batch_size_rule(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(w, rows_per_batch(w)) for w in WIDTHS], "width long, n_rows long")


BATCHES = "SELECT CAST((row_number() OVER (ORDER BY c_custkey) - 1) // {0} AS bigint) AS batch, c_custkey, c_name FROM customer"


def customer_batches(spark: SparkSession, d: str, options: ReaderOptions) -> DataFrame:
    """Customers with the number of the batch that a reader with these limits fetched them in."""
    where = {"database": sqlite_copy(table(spark, d, "customer").select("c_custkey", "c_name"), "customer", "c_custkey INTEGER, c_name TEXT"), "timeout": 60}
    columns = [ColumnDescriptor("c_custkey", "bigint"), ColumnDescriptor("c_name", "varchar", length=25)]
    return dbapi.scan(spark, "sqlite3", where, "SELECT * FROM customer ORDER BY c_custkey", columns=columns, options=options, batch_column="batch")


@query(BATCHES.format(700))
def batch_rows(spark: SparkSession, d: str) -> DataFrame:
    return customer_batches(spark, d, ReaderOptions(max_num_rows_per_batch=700))


COLUMNS = [
    ColumnDescriptor("k", "bigint"), ColumnDescriptor("name", "varchar", length=50), ColumnDescriptor("price", "decimal", 15, 2),
    ColumnDescriptor("at", "time", scale=7), ColumnDescriptor("ts", "timestamp", scale=6), ColumnDescriptor("raw", "varbinary", length=30),
]


@query("SELECT * FROM (VALUES ('k', 16), ('name', 209), ('price', 26), ('at', 27), ('ts', 24), ('raw', 38)) t(name, width)")
def row_width(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.functions.inference import infer_logical

    options = ReaderOptions()
    options.row_width(COLUMNS, [infer_logical(c) for c in COLUMNS])
    return spark.createDataFrame(list(options.widths.items()), "name string, width int")


@query(BATCHES.format("(37500 // (16 + 8 + 4 * 25 + 1))"))
def batch_bytes(spark: SparkSession, d: str) -> DataFrame:
    """A row may take 16 bytes for its number and 109 for its text."""
    return customer_batches(spark, d, ReaderOptions(max_bytes_per_batch=37_500))


@query("SELECT chunk, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM (SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS bigint) AS chunk FROM orders) GROUP BY chunk")
def chunking(spark: SparkSession, d: str) -> DataFrame:
    rows = chunked(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 1000)
    return rows.groupBy("chunk").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


NAMES = ["a", '"values"', "[x y]", "`b c`", "column name with spaces", "a-b", "Ünï_1", "a$#@_", ""]


@query("SELECT * FROM (VALUES ('a', 'a'), ('\"values\"', '\"values\"'), ('[x y]', '[x y]'), ('`b c`', '`b c`'), ('column name with spaces', '\"column name with spaces\"'), ('a-b', '\"a-b\"'), ('Ünï_1', 'Ünï_1'), ('a$#@_', 'a$#@_'), ('', '')) t(name, quoted)")
def quote_names(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in NAMES], "name string").select("name", sqlgen.quoted_column(F.col("name")).alias("quoted"))


@query("SELECT * FROM (VALUES ('MyTable', 'INSERT INTO MyTable (a, b) VALUES (?, ?)'), ('t', 'INSERT INTO t (\"a b\", [c d], e) VALUES (?, ?, ?)')) t(target, statement)")
def insert_sql(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([("MyTable", ["a", "b"]), ("t", ["a b", "[c d]", "e"])], "target string, names array<string>")
    return rows.select("target", sqlgen.insert_statement_column(F.col("target"), F.col("names")).alias("statement"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate, o_orderpriority FROM orders")
def insert_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    columns = "O_ORDERKEY BIGINT, O_CUSTKEY BIGINT, O_ORDERSTATUS VARCHAR(1), O_TOTALPRICE DOUBLE, O_ORDERDATE TIMESTAMP, O_ORDERPRIORITY VARCHAR(20)"
    url = derby_copy(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), "ORDERS_COPY", columns)
    schema = [("o_orderkey", Logical("int64")), ("o_custkey", Logical("int64")), ("o_orderstatus", Logical("utf8")), ("o_totalprice", Logical("float64")), ("o_orderdate", Logical("timestamp", unit="us")), ("o_orderpriority", Logical("utf8"))]
    back = jdbc.scan(spark, url, "SELECT * FROM ORDERS_COPY", ReaderOptions(schema=schema), jdbc.DERBY_DRIVER)
    return back.withColumn("o_orderdate", F.date_format("o_orderdate", US))


@query("SELECT CAST(n_nationkey AS bigint) AS n_nationkey, CAST(CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey + 100 ELSE n_regionkey END AS bigint) AS n_regionkey FROM nation")
def exec_many(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    where = {"database": sqlite_copy(nation, "nation", "n_nationkey INTEGER, n_regionkey INTEGER"), "timeout": 60}
    change = nation.where("n_nationkey % 2 = 0").select((F.col("n_regionkey") + 100).alias("v"), "n_nationkey").coalesce(1)
    dbapi.execute_many(change, "sqlite3", where, "UPDATE nation SET n_regionkey = ? WHERE n_nationkey = ?", row_capacity=3)
    return dbapi.scan(spark, "sqlite3", where, "SELECT n_nationkey, n_regionkey FROM nation", "n_nationkey long, n_regionkey long")


DESCRIBED = [
    (ColumnDescriptor("dec", "decimal", 38, 4), "decimal(38,4)", ""), (ColumnDescriptor("wide", "numeric", 39, 2), "string", ""),
    (ColumnDescriptor("i", "integer", nullable=False), "int", ""), (ColumnDescriptor("s", "smallint"), "smallint", ""), (ColumnDescriptor("b", "bigint"), "bigint", ""),
    (ColumnDescriptor("t", "tinyint"), "tinyint", ""), (ColumnDescriptor("u", "tinyint", unsigned=True), "smallint", ""),
    (ColumnDescriptor("f24", "float", 24), "float", ""), (ColumnDescriptor("f25", "float", 25), "double", ""), (ColumnDescriptor("bit", "bit"), "boolean", ""),
    (ColumnDescriptor("d", "date"), "date", ""), (ColumnDescriptor("ts0", "timestamp", scale=0), "timestamp_ntz", "s"), (ColumnDescriptor("ts3", "timestamp", scale=3), "timestamp_ntz", "ms"),
    (ColumnDescriptor("ts6", "timestamp", scale=6), "timestamp_ntz", "us"), (ColumnDescriptor("ts7", "timestamp", scale=7), "bigint", "ns"),
    (ColumnDescriptor("t0", "time"), "int", "s"), (ColumnDescriptor("t2", "time", scale=2), "int", "ms"), (ColumnDescriptor("t5", "time", scale=5), "bigint", "us"),
    (ColumnDescriptor("t9", "time", scale=9), "bigint", "ns"), (ColumnDescriptor("t10", "time", scale=10), "string", ""),
    (ColumnDescriptor("v154", "other", scale=7, code=-154), "bigint", "ns"), (ColumnDescriptor("v98", "other", code=-98), "string", ""),
    (ColumnDescriptor("fix", "binary", length=5), "binary", ""), (ColumnDescriptor("var", "varbinary"), "binary", ""), (ColumnDescriptor("txt", "unknown"), "string", ""),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c.name}', '{t}', '{u}', {str(c.nullable or u == 'ns' and c.sql_type == 'timestamp').lower()})" for c, t, u in DESCRIBED) + ") t(name, type, unit, nullable)")
def infer_schema_rules(spark: SparkSession, d: str) -> DataFrame:
    fields = infer_schema([c for c, *_ in DESCRIBED], "Microsoft SQL Server", errors_to_null=True)
    rows = [(f.name, f.dataType.simpleString(), f.metadata.get("unit", ""), f.nullable) for f in fields]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, T.StringType()) for n in ("name", "type", "unit")] + [T.StructField("nullable", T.BooleanType())]))


JOINED = """
SELECT n_name, count(DISTINCT c_custkey) AS customers, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS decimal(15,2))) AS {text}) AS total,
       CAST(rank() OVER (ORDER BY count(*) DESC, n_name) AS integer) AS place
FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus <> 'P' GROUP BY n_name"""


@query(JOINED.format(text="varchar"))
def sql_passthrough_join(spark: SparkSession, d: str) -> DataFrame:
    return session.run(spark, JOINED.format(text="string"), **{n: table(spark, d, n) for n in ("customer", "orders", "nation")})
