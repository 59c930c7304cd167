"""Write conversions: Spark columns as the parameters that a database takes."""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.errors import InvalidTimeZone
from lodestone.types import UNITS

#: Characters of a timestamp with offset by unit, and of a time.
TZ_WIDTH = {"s": 25, "ms": 29, "us": 32, "ns": 35}
TIME_WIDTH = {"ms": 12, "us": 15, "ns": 18}


def floor_div(value: Column, by: int) -> Column:
    """Whole division that rounds down, in integers throughout."""
    unit = F.lit(by).cast("long")
    return F.call_function("div", value.cast("long") - F.pmod(value.cast("long"), unit), unit)


def bit(c: Column) -> Column:
    return c.cast("tinyint")


def widened(c: Column) -> Column:
    """Half and single precision as single."""
    return c.cast("float")


def date_from_days(days: Column) -> Column:
    return F.date_from_unix_date(days.cast("int"))


def date_from_ms(ms: Column) -> Column:
    """64-bit dates count milliseconds, so the day is the floor, not the number itself."""
    return F.date_from_unix_date(floor_div(ms, 86_400_000).cast("int"))


def timestamp_from_epoch(ticks: Column, unit: str) -> Column:
    if unit == "ns":
        return F.timestamp_micros(floor_div(ticks, 1000)).cast("timestamp_ntz")
    return {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}[unit](ticks).cast("timestamp_ntz")


def truncated_ns(ns: Column) -> Column:
    """Seven fractional digits, toward zero."""
    return ns - ns % 100


def timestamp_ns_text(ns: Column) -> Column:
    """Seven digits as text: Spark's own type ends at six. Truncated toward zero."""
    kept = truncated_ns(ns)
    whole = F.date_format(F.timestamp_seconds(floor_div(kept, 1_000_000_000)).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    digits = F.lpad(F.call_function("div", F.pmod(kept, F.lit(1_000_000_000).cast("long")), F.lit(100).cast("long")).cast("string"), 7, "0")
    return F.concat(whole, F.lit("."), digits)


def check_time_zone(tz: str) -> None:
    """IANA names and fixed offsets; raises when the writer is made, not when it runs."""
    import re

    if re.fullmatch(r"[+-]\d{2}:?\d{2}", tz):
        return
    try:
        zoneinfo.ZoneInfo(tz)
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        raise InvalidTimeZone(tz) from None


def offset_text(ts: Column, tz: str) -> Column:
    """`+HH:MM` of the zone at an instant."""
    shift = F.unix_seconds(F.from_utc_timestamp(ts, tz)) - F.unix_seconds(ts)
    size = F.abs(shift)
    return F.format_string("%s%02d:%02d", F.when(shift < 0, "-").otherwise("+"), F.floor(size / 3600).cast("int"), F.floor(size % 3600 / 60).cast("int"))


def timestamp_tz_text(ticks: Column, unit: str, tz: str) -> Column:
    """Wall time with offset. Fractions floor, so instants before 1970 are right as well."""
    check_time_zone(tz)
    scale = 10 ** UNITS[unit]
    instant = F.timestamp_seconds(floor_div(ticks, scale))
    wall = F.date_format(F.from_utc_timestamp(instant, tz), "yyyy-MM-dd HH:mm:ss")
    fraction = [] if unit == "s" else [F.lit("."), F.lpad(F.pmod(ticks, F.lit(scale).cast("long")).cast("string"), UNITS[unit], "0")]
    return F.concat(wall, *fraction, offset_text(instant, tz))


def time_text(ticks: Column, unit: str) -> Column:
    """`HH:MM:SS` with 0, 3, 6 or 9 fractional digits."""
    scale, digits = 10 ** UNITS[unit], UNITS[unit]
    seconds = floor_div(ticks, scale)
    whole = F.format_string("%02d:%02d:%02d", F.floor(seconds / 3600).cast("int"), F.floor(seconds % 3600 / 60).cast("int"), (seconds % 60).cast("int"))
    return whole if unit == "s" else F.concat(whole, F.lit("."), F.lpad((ticks % F.lit(scale)).cast("string"), digits, "0"))


def decimal_width(precision: int, scale: int) -> int:
    """Characters of a decimal as text: sign, digits, and a point or the zeros of a negative scale."""
    return precision - scale + 1 if scale < 0 else precision + 1 + (scale > 0)


def decimal_text(value: Column, precision: int, scale: int) -> Column:
    """Sign, digits padded with zeros to the precision, a point if there is a scale.

    ``value`` is a decimal of the scale, or text of one if the precision is beyond
    Spark's; with a negative scale it is the unscaled integer.
    """
    text = F.regexp_replace(value.cast("string"), "^[+-]", "")
    sign = F.when(value.cast("string").startswith("-"), "-").otherwise("+")
    if scale <= 0:
        return F.when(value.isNotNull(), F.concat(sign, F.lpad(text, precision, "0"), F.lit("0" * -scale)))
    # without a whole part Spark still writes a zero before the point
    text = F.regexp_replace(text, r"^0\.", ".") if precision == scale else text
    return F.when(value.isNotNull(), F.concat(sign, F.lpad(text, precision + 1, "0")))


def text_utf16(text: Column) -> Column:
    return F.encode(text, "UTF-16LE")


def longest(text: Column) -> Column:
    """Aggregate: bytes of the longest value, 0 if there is none."""
    return F.coalesce(F.max(F.octet_length(text)), F.lit(0))


def not_null(value: Column, name: str) -> Column:
    """For columns that are declared without nulls."""
    return F.when(value.isNull(), F.raise_error(F.lit(f"null in column {name!r}, which is declared without nulls"))).otherwise(value)
