"""Logical column types and their Spark fields.

Spark has no nanosecond timestamps, no unsigned bytes and no enabled TIME type. Such
columns are integers whose meaning is in the field's metadata (`kind`, `unit`, `tz`,
`length`, `precision`, `scale`, `unsigned`), so it survives Parquet and any projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

from lodestone.errors import ColumnFailure, UnsupportedForInsertion, UnsupportedType

UNITS = {"s": 0, "ms": 3, "us": 6, "ns": 9}


@dataclass(frozen=True)
class Logical:
    """kind: bool int8 int16 int32 int64 uint8 uint16 float16 float32 float64 utf8 binary
    fixed_binary decimal date date64 timestamp time list."""

    kind: str
    unit: str | None = None
    tz: str | None = None
    length: int | None = None
    precision: int | None = None
    scale: int | None = None

    def spark_type(self) -> T.DataType:
        plain = {
            "bool": T.BooleanType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
            "uint8": T.ShortType(), "uint16": T.IntegerType(), "float16": T.FloatType(), "float32": T.FloatType(), "float64": T.DoubleType(),
            "utf8": T.StringType(), "binary": T.BinaryType(), "fixed_binary": T.BinaryType(), "date": T.DateType(), "date64": T.DateType(), "list": T.ArrayType(T.StringType()),
        }
        if self.kind in plain:
            return plain[self.kind]
        if self.kind == "decimal":
            return T.DecimalType(self.precision, max(self.scale, 0)) if self.precision <= 38 else T.StringType()
        if self.kind == "time":
            return T.IntegerType() if self.unit in ("s", "ms") else T.LongType()
        if self.kind == "timestamp":
            return T.LongType() if self.unit == "ns" else T.TimestampType() if self.tz else T.TimestampNTZType()
        raise UnsupportedType(self.kind)

    def field(self, name: str, nullable: bool = True) -> T.StructField:
        meta: dict[str, Any] = {"kind": self.kind} | {k: v for k in ("unit", "tz", "length", "precision", "scale") if (v := getattr(self, k)) is not None}
        return T.StructField(name, self.spark_type(), nullable, meta)


def logical_of(field: T.StructField) -> Logical:
    """The logical type of a Spark field, from its metadata or else its type."""
    meta = field.metadata or {}
    if "kind" in meta:
        return Logical(meta["kind"], *(meta.get(k) for k in ("unit", "tz", "length", "precision", "scale")))
    kinds = {
        T.BooleanType: "bool", T.ByteType: "int8", T.ShortType: "int16", T.IntegerType: "int32", T.LongType: "int64",
        T.FloatType: "float32", T.DoubleType: "float64", T.StringType: "utf8", T.BinaryType: "binary", T.DateType: "date",
    }
    if type(field.dataType) in kinds:
        return Logical(kinds[type(field.dataType)])
    if isinstance(field.dataType, T.DecimalType):
        return Logical("decimal", precision=field.dataType.precision, scale=field.dataType.scale)
    if isinstance(field.dataType, T.TimestampNTZType):
        return Logical("timestamp", unit="us")
    if isinstance(field.dataType, T.TimestampType):
        return Logical("timestamp", unit="us", tz="UTC")
    raise UnsupportedType(field.dataType.simpleString())


READABLE = frozenset("bool int8 int16 int32 int64 uint8 float32 float64 utf8 binary fixed_binary decimal date timestamp time".split())
WRITABLE = READABLE | {"float16", "date64"}


def check_readable(fields: list[tuple[str, Logical]]) -> None:
    """Raises for the first column that can't be read, before anything is planned."""
    for index, (name, logical) in enumerate(fields):
        negative = logical.kind == "decimal" and logical.scale < 0
        if logical.kind not in READABLE or negative or logical.kind == "timestamp" and logical.tz:
            raise ColumnFailure(name, index, UnsupportedType(f"decimal({logical.precision},{logical.scale})" if negative else logical.kind))


def check_writable(fields: list[tuple[str, Logical]]) -> None:
    """Raises for the first column that can't be written, bad time zones included."""
    from lodestone.functions.write import check_time_zone

    for _, logical in fields:
        if logical.kind not in WRITABLE:
            raise UnsupportedForInsertion(logical.kind)
        if logical.kind == "timestamp" and logical.tz:
            check_time_zone(logical.tz)
