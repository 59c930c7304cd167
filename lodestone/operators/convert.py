"""Whole-row conversions: one projection for reading, one for writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.errors import BindParameters
from lodestone.functions import read, write
from lodestone.functions.inference import ColumnDescriptor
from lodestone.operators.limits import ReaderOptions
from lodestone.types import UNITS, Logical, check_readable, check_writable, logical_of


#: Types whose texts are padded to their length.
FIXED_TEXT = ("char", "wchar")


def read_column(c: Column, source: T.DataType, logical: Logical, options: ReaderOptions, fixed_text: bool = False) -> Column:
    match logical.kind:
        case "bool":
            return read.boolean(c)
        case "int8" | "int16" | "int32" | "int64" | "uint8" | "float32" | "float64":
            return read.identical(c, logical.kind)
        case "utf8":
            text = read.text_utf8(c) if isinstance(source, T.BinaryType) and options.encoding == "utf8" else read.text_utf16(c) if isinstance(source, T.BinaryType) else c.cast("string")
            text = read.capped(text, options.max_text_size, "text") if options.max_text_size else text
            return read.trimmed(text) if fixed_text and options.trim_fixed_sized_characters else text
        case "binary":
            return read.capped(c.cast("binary"), options.max_binary_size, "binary") if options.max_binary_size else c.cast("binary")
        case "fixed_binary":
            return read.fixed_binary(c.cast("binary"), logical.length)
        case "decimal" if source == logical.spark_type():
            return c  # as it is, so that filters reach the source
        case "decimal":
            return read.decimal_text(c.cast("string"), logical.precision, logical.scale) if logical.precision <= 38 else c.cast("string")
        case "date":
            return c.cast("date")
        case "timestamp" if logical.unit == "ns":
            return read.epoch_ns_text(c) if isinstance(source, T.StringType) else read.epoch_ns(c, options.value_errors_as_null)
        case "timestamp" if logical.unit == "us" and isinstance(source, T.TimestampNTZType):
            return c
        case "timestamp":
            return F.date_trunc({"s": "second", "ms": "millisecond", "us": "microsecond"}[logical.unit], c.cast("timestamp")).cast("timestamp_ntz")
    text = c if isinstance(source, T.StringType) else F.date_format(c.cast("timestamp"), "HH:mm:ss" + ("." + "S" * min(6, UNITS[logical.unit]) if logical.unit != "s" else ""))
    return read.time_ticks(text, logical.unit)


def read_projection(df: DataFrame, schema: list[tuple[str, Logical]], options: ReaderOptions | None = None, columns: list[ColumnDescriptor] | None = None) -> DataFrame:
    """Columns by position, converted to the given types; bad types raise here, not later.

    columns: what the source says about them. Fixed-size texts are trimmed if asked for, and
    whether a column may be null stays in its metadata; ``enforce_not_null`` also checks that.
    """
    options = options or ReaderOptions()
    check_readable(schema)
    if len(schema) != len(df.schema):
        raise BindParameters(f"{len(schema)} columns are asked for, the source has {len(df.schema)}")
    out = []
    for k, (source, (name, logical)) in enumerate(zip(df.schema, schema, strict=True)):
        column = columns[k] if columns else None
        metadata = logical.field(name).metadata | ({"nullable": column.nullable} if column else {})
        value = read_column(F.col(f"`{source.name}`"), source.dataType, logical, options, bool(column and column.sql_type in FIXED_TEXT))
        if options.enforce_not_null and column and not column.nullable:
            value = write.not_null(value, name)
        out.append(value.alias(name, metadata=metadata))
    return df.select(*out)


def write_column(c: Column, logical: Logical) -> Column:
    match logical.kind:
        case "bool":
            return write.bit(c)
        case "float16":
            return write.widened(c)
        case "date64":
            return write.date_from_ms(c)
        case "decimal":
            return c if logical.scale >= 0 else write.decimal_text(c, logical.precision, logical.scale)
        case "timestamp" if logical.tz:
            return write.timestamp_tz_text(c if logical.unit == "ns" else read.epoch(c, logical.unit), logical.unit, logical.tz)
        case "timestamp" if logical.unit == "ns":
            return write.timestamp_ns_text(c)
        case "time":
            return write.time_text(c, logical.unit)
    return c


def write_projection(df: DataFrame) -> DataFrame:
    """Every column as the parameter that a statement takes; bad types and zones raise here."""
    logicals = [logical_of(f) for f in df.schema]
    check_writable(list(zip(df.columns, logicals, strict=True)))
    out = []
    for f, logical in zip(df.schema, logicals, strict=True):
        value = F.col(f"`{f.name}`")
        if f.metadata.get("nullable") is False:  # declared so by its source
            value = write.not_null(value, f.name)
        out.append(write_column(value, logical).alias(f.name))
    return df.select(*out)
