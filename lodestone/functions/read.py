"""Read conversions: what a database delivers, as Spark columns.

All are expressions over built-in functions, so a scan with its conversions is one
projection in whole-stage codegen. Strict forms raise, `or_null` forms give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.errors import OUT_OF_RANGE_NS
from lodestone.types import UNITS

SPACE = r"(?U)^\s+|\s+$"


def boolean(c: Column) -> Column:
    return c.cast("boolean")


def identical(c: Column, kind: str) -> Column:
    """Integers and floats of the same width; uint8 is checked, as Spark holds it in 16 bits."""
    spark = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "uint8": "smallint", "float32": "float", "float64": "double"}[kind]
    value = c.cast(spark)
    if kind == "uint8":
        return F.when(value.between(0, 255) | value.isNull(), value).otherwise(F.raise_error(F.concat(F.lit("not an unsigned byte: "), value.cast("string"))).cast("smallint"))
    return value


def date_days(c: Column) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(c)


def epoch(ts: Column, unit: str) -> Column:
    """Ticks since 1970; units coarser than microseconds round down, before 1970 too."""
    instant = ts.cast("timestamp")
    return {"s": F.unix_seconds, "ms": F.unix_millis, "us": F.unix_micros}[unit](instant)


def epoch_ns(ts: Column, or_null: bool = False) -> Column:
    """Nanoseconds since 1970; beyond 64 bits an error that names the value, or null."""
    product = F.try_multiply(F.unix_micros(ts.cast("timestamp")), F.lit(1000).cast("long"))
    if or_null:
        return product
    before, after = OUT_OF_RANGE_NS.split("{value}")
    message = F.concat(F.lit(before), F.date_format(ts.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(after))
    return F.when(product.isNotNull() | ts.isNull(), product).otherwise(F.raise_error(message).cast("long"))


def epoch_ns_text(text: Column) -> Column:
    """Nanoseconds of a timestamp as text, which keeps the digits that Spark's type drops."""
    seconds = F.unix_seconds(F.substring(text, 1, 19).cast("timestamp"))
    fraction = F.coalesce(F.nullif(F.substring(text, 21, 9), F.lit("")), F.lit("0"))
    return seconds * F.lit(1_000_000_000).cast("long") + F.rpad(fraction, 9, "0").cast("long")


def time_ticks(text: Column, unit: str) -> Column:
    """Ticks since midnight of `HH:MM:SS[.fraction]`; more digits than the unit has are an error."""
    digits = UNITS[unit]
    whole = (F.substring(text, 1, 2).cast("long") * 60 + F.substring(text, 4, 2).cast("long")) * 60 + F.substring(text, 7, 2).cast("long")
    if digits == 0:
        return whole.cast("int")
    fraction = F.substring(text, 10, 64)
    good = F.when(F.length(fraction) <= digits, fraction).otherwise(F.raise_error(F.concat(F.lit(f"more than {digits} digits: "), text)).cast("string"))
    ticks = whole * F.lit(10**digits).cast("long") + F.rpad(good, digits, "0").cast("long")
    return ticks.cast("int") if unit == "ms" else ticks


def decimal_text(text: Column, precision: int, scale: int) -> Column:
    """A decimal from text with a point or a comma."""
    return F.translate(text, ",", ".").cast(f"decimal({precision},{scale})")


def text_utf8(raw: Column, or_null: bool = False, trim: bool = False) -> Column:
    """Text from UTF-8 bytes; invalid bytes are an error that shows the readable part."""
    if or_null:
        value = F.try_validate_utf8(raw.cast("string"))
    else:
        text = raw.cast("string")
        value = F.when(F.is_valid_utf8(text) | text.isNull(), text).otherwise(F.raise_error(F.concat(F.lit("invalid UTF-8; readable part: "), F.make_valid_utf8(text))).cast("string"))
    return trimmed(value) if trim else value


def text_utf16(raw: Column, trim: bool = False) -> Column:
    """Text from UTF-16 bytes, little end first."""
    value = F.decode(raw, "UTF-16LE")
    return trimmed(value) if trim else value


def trimmed(text: Column) -> Column:
    """Without Unicode white space at both ends, as fixed-size columns are padded."""
    return F.regexp_replace(text, SPACE, "")


def capped(value: Column, limit: int, what: str = "value", or_null: bool = False) -> Column:
    """The value, or an error (or null) if it has more bytes than the limit; nothing is cut silently."""
    if or_null:
        return F.when(F.octet_length(value) <= limit, value)
    return F.when(F.octet_length(value) > limit, F.raise_error(F.concat(F.lit(f"{what} of "), F.octet_length(value).cast("string"), F.lit(f" bytes is beyond the limit of {limit}")))).otherwise(value)


def fixed_binary(value: Column, length: int | Column) -> Column:
    """The bytes, or an error if they are not ``length``; a column has a length a row."""
    bad = F.octet_length(value) != length
    return F.when(bad, F.raise_error(F.concat(F.lit(f"expected {length} bytes, got "), F.octet_length(value).cast("string"))).cast("binary")).otherwise(value)
