import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestone.errors import ColumnFailure, InvalidTimeZone, InvalidUtf8, OutOfRangeTimestampNs, typed_errors
from lodestone.functions import read, sqlgen, write
from lodestone.functions.inference import ColumnDescriptor
from lodestone.operators.convert import read_projection, write_projection
from lodestone.operators.limits import ReaderOptions
from lodestone.types import Logical


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, sql, column):
    return spark.sql(f"SELECT {sql} AS c").select(column(F.col("c"))).first()[0]


@pytest.mark.parametrize(("text", "unit", "ticks"), [("12:34:56", "s", 45_296), ("12:34:56.7", "ms", 45_296_700), ("12:34:56.789", "ms", 45_296_789), ("12:34:56", "us", 45_296_000_000), ("12:34:56.7891", "us", 45_296_789_100), ("12:34:56.7891234", "ns", 45_296_789_123_400)])
def test_time_ticks(spark, text, unit, ticks):
    assert one(spark, f"'{text}'", lambda c: read.time_ticks(c, unit)) == ticks


def test_time_ticks_too_many_digits(spark):
    with pytest.raises(Exception, match="more than 3 digits"):
        one(spark, "'12:34:56.7891'", lambda c: read.time_ticks(c, "ms"))


@pytest.mark.parametrize(("sql", "unit", "ticks"), [("TIMESTAMP_NTZ '1900-01-01 12:43:17.123'", "ms", -2208942_202_877), ("TIMESTAMP_NTZ '1600-06-18 23:12:44.123'", "ms", -11_661_612_435_877 + 0), ("TIMESTAMP_NTZ '1969-12-31 23:59:59.5'", "s", -1)])
def test_epoch_before_1970(spark, sql, unit, ticks):
    expected = (dt.datetime.fromisoformat(sql.split("'")[1] if len(sql.split("'")[1].split(".")[-1]) != 1 else sql.split("'")[1] + "00000") - dt.datetime(1970, 1, 1)) // dt.timedelta(**{"milliseconds" if unit == "ms" else "seconds": 1})
    assert one(spark, sql, lambda c: read.epoch(c, unit)) == expected


def test_epoch_ns(spark):
    assert one(spark, "TIMESTAMP_NTZ '1970-01-01 00:00:01.000001'", read.epoch_ns) == 1_000_001_000
    assert one(spark, "TIMESTAMP_NTZ '2300-01-01 00:00:00.1'", lambda c: read.epoch_ns(c, or_null=True)) is None
    with pytest.raises(Exception, match="Timestamp is not representable in arrow: 2300-01-01"):
        one(spark, "TIMESTAMP_NTZ '2300-01-01 00:00:00.1'", read.epoch_ns)
    assert one(spark, "'2021-04-09 18:57:50.1234567'", read.epoch_ns_text) == 1_617_994_670_123_456_700


@pytest.mark.parametrize(("text", "p", "s", "value"), [("123.45", 5, 2, "123.45"), ("-123,4", 5, 2, "-123.40"), ("7", 5, 2, "7.00")])
def test_decimal_from_text(spark, text, p, s, value):
    assert one(spark, f"'{text}'", lambda c: read.decimal_text(c, p, s)) == Decimal(value)


def test_text(spark):
    assert one(spark, "X'48656c6c6fc3'", lambda c: read.text_utf8(c, or_null=True)) is None
    with pytest.raises(Exception, match="invalid UTF-8; readable part: Hello"):
        one(spark, "X'48656c6c6fc3'", read.text_utf8)
    assert one(spark, "' 123 '", read.trimmed) == "123"
    for text in ("Hällö, Wörld!", "가" * 1000, ""):
        assert one(spark, f"'{text}'", lambda c: read.text_utf16(write.text_utf16(c))) == text


def test_caps_and_lengths(spark):
    with pytest.raises(Exception, match="beyond the limit of 5"):
        one(spark, "'123456789'", lambda c: read.capped(c, 5))
    assert one(spark, "CAST(NULL AS string)", lambda c: read.capped(c, 5)) is None
    assert one(spark, "X'0102'", lambda c: read.fixed_binary(c, 2)) == bytearray(b"\1\2")
    with pytest.raises(Exception, match="expected 3 bytes"):
        one(spark, "X'0102'", lambda c: read.fixed_binary(c, 3))
    with pytest.raises(Exception, match="not an unsigned byte"):
        one(spark, "300", lambda c: read.identical(c, "uint8"))


@pytest.mark.parametrize(("ticks", "unit", "tz", "text"), [(1_750_586_400, "s", "Europe/Berlin", "2025-06-22 12:00:00+02:00"), (1_738_407_600_123, "ms", "Europe/Berlin", "2025-02-01 12:00:00.123+01:00"), (-1, "ms", "UTC", "1969-12-31 23:59:59.999+00:00"), (1_750_586_400_123_456_789, "ns", "Asia/Kolkata", "2025-06-22 15:30:00.123456789+05:30")])
def test_timestamp_with_zone(spark, ticks, unit, tz, text):
    got = one(spark, f"{ticks}L", lambda c: write.timestamp_tz_text(c, unit, tz))
    assert got == text and len(got) == write.TZ_WIDTH[unit]


def test_zone_is_checked_at_once():
    with pytest.raises(InvalidTimeZone):
        write.timestamp_tz_text(F.lit(1), "s", "Foobar")


@pytest.mark.parametrize(("ticks", "unit", "text"), [(11_111, "s", "03:05:11"), (11_111_111, "ms", "03:05:11.111"), (11_111_111_111, "us", "03:05:11.111111"), (11_111_111_111_111, "ns", "03:05:11.111111111")])
def test_time_text(spark, ticks, unit, text):
    assert one(spark, f"{ticks}L", lambda c: write.time_text(c, unit)) == text


@pytest.mark.parametrize(("sql", "p", "s", "text"), [("CAST(12.345 AS decimal(5,3))", 5, 3, "+12.345"), ("CAST(-0.001 AS decimal(5,3))", 5, 3, "-00.001"), ("CAST(0.12345 AS decimal(5,5))", 5, 5, "+.12345"), ("CAST(42 AS decimal(5,0))", 5, 0, "+00042"), ("CAST(123 AS decimal(3,0))", 3, -2, "+12300"), ("'-1.5'", 40, 1, "-" + "0" * 38 + "1.5")])
def test_decimal_text(spark, sql, p, s, text):
    got = one(spark, sql, lambda c: write.decimal_text(c, p, s))
    assert got == text and len(got) == write.decimal_width(p, s)


@pytest.mark.parametrize(
    ("ns", "text"),
    [(11_111_111_111_111_111, "1970-05-09 14:25:11.1111111"), (0, "1970-01-01 00:00:00.0000000"), (-150, "1969-12-31 23:59:59.9999999"), (-1_000_000_001, "1969-12-31 23:59:59.0000000"), (1_700_000_000_380_112_000, "2023-11-14 22:13:20.3801120"), (2**63 - 1, "2262-04-11 23:47:16.8547758")],
)
def test_nanoseconds_in_a_sink(spark, ns, text):
    field = Logical("timestamp", unit="ns").field("t")
    rows = spark.sql(f"SELECT {ns}L AS t").select(F.col("t").alias("t", metadata=field.metadata))
    assert write_projection(rows).first().t == text


def test_whole_microseconds_stay(spark):
    ticks = spark.range(200_000).select((F.col("id") * 1_000 + 1_700_000_000_000_000_000).alias("t"))
    wrong = ticks.where(F.unix_micros(write.timestamp_from_epoch(F.col("t"), "ns").cast("timestamp")) * 1000 != F.col("t"))
    assert wrong.count() == 0


def test_nulls_in_columns_declared_without(spark):
    rows = spark.sql("SELECT CAST(NULL AS int) AS a").select(F.col("a").alias("a", metadata={"nullable": False}))
    with pytest.raises(Exception, match="declared without nulls"):
        write_projection(rows).collect()
    described = [ColumnDescriptor("a", "integer", nullable=False)]
    source = spark.sql("SELECT CAST(NULL AS int) AS a")
    assert read_projection(source, [("a", Logical("int32"))], None, described).schema["a"].metadata["nullable"] is False
    with pytest.raises(Exception, match="declared without nulls"):
        read_projection(source, [("a", Logical("int32"))], ReaderOptions(enforce_not_null=True), described).collect()


def test_trimming_of_fixed_columns(spark):
    source = spark.sql("SELECT ' ab  ' AS a, ' ab  ' AS b")
    described = [ColumnDescriptor("a", "char", length=5), ColumnDescriptor("b", "varchar", length=5)]
    schema = [("a", Logical("utf8")), ("b", Logical("utf8"))]
    assert read_projection(source, schema, ReaderOptions(trim_fixed_sized_characters=True), described).first() == ("ab", " ab  ")
    assert read_projection(source, schema, ReaderOptions(), described).first() == (" ab  ", " ab  ")


def test_encoding(monkeypatch):
    assert ReaderOptions().encoding == "utf8" and ReaderOptions(payload_text_encoding="utf16").encoding == "utf16"
    monkeypatch.setattr("sys.platform", "win32")
    assert ReaderOptions().encoding == "utf16"


def test_typed_errors(spark):
    with pytest.raises(OutOfRangeTimestampNs) as e, typed_errors():
        one(spark, "TIMESTAMP_NTZ '2300-01-01 00:00:00.1'", read.epoch_ns)
    assert e.value.value.startswith("2300-01-01")
    with pytest.raises(InvalidUtf8) as e, typed_errors():
        one(spark, "X'48656c6c6fc3'", read.text_utf8)
    assert e.value.lossy_value.startswith("Hello")


def test_small_write_rules(spark):
    assert one(spark, "-150L", write.truncated_ns) == -100
    assert one(spark, "86400000L", write.date_from_ms) == dt.date(1970, 1, 2)
    assert one(spark, "-1L", write.date_from_ms) == dt.date(1969, 12, 31)
    assert one(spark, "true", write.bit) == 1
    assert values(spark, [("a",), ("bcd",), (None,)], "t string", write.longest(F.col("t"))) == [(3,)]
    assert values(spark, [], "t string", write.longest(F.col("t"))) == [(0,)]
    with pytest.raises(Exception, match="declared without nulls"):
        one(spark, "CAST(NULL AS int)", lambda c: write.not_null(c, "a"))


def test_projections(spark):
    source = spark.sql("SELECT 1 AS x, '12:00:01' AS t, CAST(NULL AS string) AS n")
    out = read_projection(source, [("a", Logical("int64")), ("at", Logical("time", unit="s")), ("s", Logical("utf8"))])
    assert out.first() == (1, 43_201, None) and out.schema["at"].metadata["unit"] == "s"
    with pytest.raises(ColumnFailure):
        read_projection(source, [("a", Logical("uint16")), ("b", Logical("utf8")), ("c", Logical("utf8"))])
    assert write_projection(out).first() == (1, "12:00:01", None)
    with pytest.raises(Exception, match="beyond the limit"):
        read_projection(source.select("t"), [("t", Logical("utf8"))], ReaderOptions(max_text_size=3)).collect()


@pytest.mark.parametrize(("name", "text"), [("a", "a"), ('"values"', '"values"'), ("column name with spaces", '"column name with spaces"'), ("[x y]", "[x y]"), ("a-b", '"a-b"'), ("Ü1_$#@", "Ü1_$#@"), ("", ""), ('"', '"'), ("x\ny", '"x\ny"'), ("नाि", "नाि"), ("½", "½"), ("a\u0301", '"a\u0301"')])
def test_quoting(spark, name, text):
    assert sqlgen.quoted(name) == text
    assert values(spark, [(name,)], "n string", sqlgen.quoted_column(F.col("n"))) == [(text,)]


def test_insert_statement():
    assert sqlgen.insert_statement("MyTable", ["a", "b c"]) == 'INSERT INTO MyTable (a, "b c") VALUES (?, ?)'
    assert sqlgen.insert_statement("t", ["a", "b"], "numeric") == "INSERT INTO t (a, b) VALUES (:1, :2)"
    assert sqlgen.insert_statement("t", ["a", "b"], "pyformat") == "INSERT INTO t (a, b) VALUES (%(a)s, %(b)s)"


@pytest.mark.parametrize(
    ("statement", "style", "found"),
    [("UPDATE t SET a = ? WHERE b = '?' -- ?\n AND \"c?\" = ? /* ? */", "qmark", ["?", "?"]), ("x = %s AND y LIKE 'a%s' AND z LIKE 5%%", "format", ["%s"]), ("a = :n AND b = :m AND c::int = :n", "named", [":n", ":m"]), ("(:2, :1)", "numeric", [":2", ":1"]), ("%(a)s, %(b)s, %(a)s", "pyformat", ["%(a)s", "%(b)s"])],
)
def test_placeholders(statement, style, found):
    assert sqlgen.placeholders(statement, style) == found
