import pytest
from pyspark.sql import types as T

from lodestone.errors import ColumnFailure, InvalidTimeZone, UnsupportedForInsertion, UnsupportedType, ZeroSizedColumn
from lodestone.functions.inference import ColumnDescriptor, infer_field, infer_logical, infer_schema, unit_of
from lodestone.types import Logical, check_readable, check_writable, logical_of


@pytest.mark.parametrize(("digits", "unit"), [(0, "s"), (1, "ms"), (3, "ms"), (4, "us"), (6, "us"), (7, "ns"), (9, "ns"), (10, None), (-1, None)])
def test_unit_of(digits, unit):
    assert unit_of(digits) == unit


@pytest.mark.parametrize(
    ("column", "dbms", "kind"),
    [
        (ColumnDescriptor("a", "decimal", 38, 0), None, "decimal"),
        (ColumnDescriptor("a", "decimal", 39, 0), None, "utf8"),
        (ColumnDescriptor("a", "tinyint", unsigned=True), None, "uint8"),
        (ColumnDescriptor("a", "float", 24), None, "float32"),
        (ColumnDescriptor("a", "float", 53), None, "float64"),
        (ColumnDescriptor("a", "other", code=-154), "Microsoft SQL Server", "time"),
        (ColumnDescriptor("a", "other", code=-154), "Microsoft SQL Server 2022", "utf8"),
        (ColumnDescriptor("a", "other", code=-98), "DB2/LINUXX8664", "binary"),
        (ColumnDescriptor("a", "other", code=-98), None, "utf8"),
        (ColumnDescriptor("a", "longvarchar"), None, "utf8"),
    ],
)
def test_kinds(column, dbms, kind):
    assert infer_logical(column, 0, dbms).kind == kind


def test_nullability_and_metadata():
    ns = ColumnDescriptor("a", "timestamp", scale=7, nullable=False)
    assert not infer_field(ns).nullable
    assert infer_field(ns, errors_to_null=True).nullable
    assert not infer_field(ColumnDescriptor("a", "timestamp", scale=6, nullable=False), errors_to_null=True).nullable
    assert logical_of(infer_field(ns)) == Logical("timestamp", unit="ns")
    assert infer_schema([]) == T.StructType([])


def test_binary_without_length():
    with pytest.raises(ColumnFailure) as e:
        infer_schema([ColumnDescriptor("x", "integer"), ColumnDescriptor("raw", "binary")])
    assert (e.value.name, e.value.index) == ("raw", 1)
    assert isinstance(e.value.reason, ZeroSizedColumn)


@pytest.mark.parametrize("bad", [Logical("uint16"), Logical("list"), Logical("decimal", precision=3, scale=-2), Logical("timestamp", unit="s", tz="UTC")])
def test_unreadable(bad):
    with pytest.raises(ColumnFailure) as e:
        check_readable([("a", bad)])
    assert e.value.index == 0 and isinstance(e.value.reason, UnsupportedType)


def test_unwritable():
    with pytest.raises(UnsupportedForInsertion):
        check_writable([("a", Logical("list"))])
    with pytest.raises(InvalidTimeZone) as e:
        check_writable([("a", Logical("timestamp", unit="s", tz="Foobar"))])
    assert str(e.value) == "Unable to parse 'Foobar' into a valid IANA time zone."
    check_writable([("a", Logical("timestamp", unit="s", tz="Europe/Berlin")), ("b", Logical("decimal", precision=3, scale=-2))])
