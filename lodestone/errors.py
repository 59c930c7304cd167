"""Errors of the exchange, raised before any row moves wherever that is possible."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator

from pyspark.errors import PySparkException

# Texts that callers compare.
OUT_OF_RANGE_NS = (
    "Timestamp is not representable in arrow: {value}\n"
    "Timestamps with nanoseconds precision are represented using a signed 64 Bit integer. This "
    "limits their range to values between 1677-09-21 00:12:44 and 2262-04-11 "
    "23:47:16.854775807. The value returned from the database is outside of this range. "
    "Suggestions to fix this error either reduce the precision or fetch the values as text."
)
INVALID_TIME_ZONE = "Unable to parse '{time_zone}' into a valid IANA time zone."


class ExchangeError(Exception):
    """Base of all errors here."""


class MetadataUnavailable(ExchangeError):
    """The source does not say which columns a statement returns."""


class ColumnFailure(ExchangeError):
    """A column can't be exchanged: its name, zero-based index and the reason."""

    def __init__(self, name: str, index: int, reason: Exception):
        super().__init__(f"column {name!r} (index {index}): {reason}")
        self.name, self.index, self.reason = name, index, reason


class ZeroSizedColumn(ExchangeError):
    def __init__(self, sql_type: object):
        super().__init__(f"no upper bound is known for values of {sql_type}; set a size limit or cast the column")
        self.sql_type = sql_type


class UnknownStringLength(ExchangeError):
    def __init__(self, sql_type: object, cause: Exception | None = None):
        super().__init__(f"the length of texts of {sql_type} can't be found out: {cause}")
        self.sql_type, self.cause = sql_type, cause


class UnsupportedType(ExchangeError):
    def __init__(self, data_type: object):
        super().__init__(f"{data_type} can't be read from a database")
        self.data_type = data_type


class FailedToDescribeColumn(ExchangeError):
    """The source gave no description of a column."""


class TooLarge(ExchangeError):
    def __init__(self, num_elements: int, element_size: int):
        super().__init__(f"a buffer of {num_elements} elements of {element_size} bytes is beyond the limit")
        self.num_elements, self.element_size = num_elements, element_size


class BufferTooSmall(ExchangeError):
    def __init__(self, max_bytes_per_batch: int, bytes_per_row: int):
        super().__init__(f"a batch is limited to {max_bytes_per_batch} bytes, but one row may take {bytes_per_row}")
        self.max_bytes_per_batch, self.bytes_per_row = max_bytes_per_batch, bytes_per_row


class MappingError(ExchangeError):
    """A value has no counterpart in its target type."""


class OutOfRangeTimestampNs(MappingError):
    def __init__(self, value: object):
        super().__init__(OUT_OF_RANGE_NS.format(value=value))
        self.value = value


class InvalidUtf8(MappingError):
    def __init__(self, lossy_value: str):
        super().__init__(f"invalid UTF-8; readable part: {lossy_value}")
        self.lossy_value = lossy_value


class WriterError(ExchangeError):
    """Base of what can go wrong when rows are sent to a database."""


class BindParameters(WriterError):
    """The statement does not take the given columns as parameters."""


class ExecuteStatement(WriterError):
    """The database refused a chunk of rows."""


class UnsupportedForInsertion(WriterError):
    def __init__(self, data_type: object):
        super().__init__(f"{data_type} can't be inserted")
        self.data_type = data_type


class ReadingBatch(WriterError):
    """The rows to be written could not be produced."""


class InvalidTimeZone(WriterError):
    def __init__(self, time_zone: str):
        super().__init__(INVALID_TIME_ZONE.format(time_zone=time_zone))
        self.time_zone = time_zone


class PreparingStatement(WriterError):
    def __init__(self, sql: str, cause: Exception):
        super().__init__(f"the database does not accept the statement {sql}: {cause}")
        self.sql, self.cause = sql, cause


@contextlib.contextmanager
def typed_errors() -> Iterator[None]:
    """Values that a scan refuses come out of an action inside as the errors of this module."""
    try:
        yield
    except PySparkException as e:
        text = str(e)
        before, after = OUT_OF_RANGE_NS.split("{value}")
        if m := re.search(re.escape(before) + "(.*?)" + re.escape(after.split("\n")[0]) + "\n" + re.escape(after.split("\n")[1][:40]), text):
            raise OutOfRangeTimestampNs(m[1]) from e
        if m := re.search(r"invalid UTF-8; readable part: ([^\n]*)", text):
            raise InvalidUtf8(m[1]) from e
        raise


@contextlib.contextmanager
def writer_errors() -> Iterator[None]:
    """What stops a sink comes out as a writer's error: the database's refusal, or rows that
    could not be produced."""
    try:
        yield
    except PySparkException as e:
        text = str(e)
        refused = "ExecuteStatement" in text or "java.sql." in text or "SQLException" in text
        raise (ExecuteStatement if refused else ReadingBatch)(text) from e
