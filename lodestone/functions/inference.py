"""Schema inference from what a database says about the columns of a statement."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from lodestone.errors import ColumnFailure, ZeroSizedColumn
from lodestone.types import Logical

# Vendor type codes and the databases that give them a meaning.
VENDOR_TIME, VENDOR_TIME_DBMS = -154, "Microsoft SQL Server"
VENDOR_BLOB, VENDOR_BLOB_DBMS_PREFIX = -98, "DB2/"

WIDEST_DECIMAL = 38
SINGLE_PRECISION_BITS = 24


@dataclass(frozen=True)
class ColumnDescriptor:
    """One column of a result set.

    sql_type: numeric decimal integer smallint bigint tinyint real float double bit date
    timestamp time char wchar varchar wvarchar longvarchar wlongvarchar binary varbinary
    longvarbinary unknown other. code: the vendor's code for `other`.
    """

    name: str
    sql_type: str
    precision: int = 0
    scale: int = 0
    length: int | None = None
    nullable: bool = True
    unsigned: bool = False
    code: int = 0


def unit_of(digits: int) -> str | None:
    """The unit that holds so many fractional digits of a second; None beyond nanoseconds."""
    for unit, most in (("s", 0), ("ms", 3), ("us", 6), ("ns", 9)):
        if 0 <= digits <= most:
            return unit
    return None


def time_of(digits: int) -> Logical:
    unit = unit_of(digits)
    return Logical("time", unit=unit) if unit else Logical("utf8")


def infer_logical(column: ColumnDescriptor, index: int = 0, dbms_name: str | None = None) -> Logical:
    kind, digits = column.sql_type, column.scale
    simple = {"integer": "int32", "smallint": "int16", "bigint": "int64", "real": "float32", "double": "float64", "bit": "bool", "date": "date"}
    if kind in simple:
        return Logical(simple[kind])
    match kind:
        case "numeric" | "decimal" if column.precision <= WIDEST_DECIMAL:
            return Logical("decimal", precision=column.precision, scale=column.scale)
        case "float":
            return Logical("float32" if column.precision <= SINGLE_PRECISION_BITS else "float64")
        case "tinyint":
            return Logical("uint8" if column.unsigned else "int8")
        case "timestamp":
            return Logical("timestamp", unit=unit_of(digits) or "ns")
        case "time":
            return time_of(digits)
        case "binary":
            if column.length is None:
                raise ColumnFailure(column.name, index, ZeroSizedColumn(kind))
            return Logical("fixed_binary", length=column.length)
        case "varbinary" | "longvarbinary":
            return Logical("binary")
        case "other" if column.code == VENDOR_TIME and dbms_name == VENDOR_TIME_DBMS:
            return time_of(digits)
        case "other" if column.code == VENDOR_BLOB and (dbms_name or "").startswith(VENDOR_BLOB_DBMS_PREFIX):
            return Logical("binary")
    return Logical("utf8")


def infer_field(column: ColumnDescriptor, index: int = 0, dbms_name: str | None = None, errors_to_null: bool = False) -> T.StructField:
    logical = infer_logical(column, index, dbms_name)
    loses = errors_to_null and logical.kind == "timestamp" and logical.unit == "ns"
    return logical.field(column.name, column.nullable or loses)


def infer_schema(columns: list[ColumnDescriptor], dbms_name: str | None = None, errors_to_null: bool = False) -> T.StructType:
    """Fields in order; a result without columns has the empty schema."""
    return T.StructType([infer_field(c, k, dbms_name, errors_to_null) for k, c in enumerate(columns)])


#: java.sql.Types by name; JDBC's codes are not those of other interfaces.
JDBC_KINDS = {
    -7: "bit", 16: "bit", -6: "tinyint", 5: "smallint", 4: "integer", -5: "bigint", 6: "float", 7: "real", 8: "double", 2: "numeric", 3: "decimal",
    91: "date", 92: "time", 93: "timestamp", 1: "char", -15: "wchar", 12: "varchar", -9: "wvarchar", -1: "longvarchar", -16: "wlongvarchar",
    -2: "binary", -3: "varbinary", -4: "longvarbinary", 2004: "longvarbinary", 2005: "longvarchar", 2011: "wlongvarchar",
}


def jdbc_descriptor(name: str, code: int, precision: int, scale: int, display: int, nullable: bool, signed: bool) -> ColumnDescriptor:
    """A column of java.sql.ResultSetMetaData; FLOAT precision is in bits here."""
    kind = JDBC_KINDS.get(code, "other")
    if kind == "float":
        precision = 53 if precision > 7 else 24
    length = precision if kind in ("binary", "varbinary", "char", "varchar", "wchar", "wvarchar") and precision > 0 else display or None
    return ColumnDescriptor(name, kind, precision, scale, length, nullable, not signed, code)
