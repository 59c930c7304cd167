"""Bounded transfer: how many rows a batch may have, and what a value may weigh.

A row's width is the sum of its columns' widths. A fixed-width column takes its value
and an 8-byte indicator; text and binary take their longest possible value, so a column
without a known bound needs a cap. Text counts four bytes a character in UTF-8 and two
in UTF-16, and a closing zero.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

from lodestone.errors import BufferTooSmall, ColumnFailure, TooLarge, UnknownStringLength, ZeroSizedColumn
from lodestone.functions.inference import ColumnDescriptor
from lodestone.functions.write import TIME_WIDTH
from lodestone.types import Logical

MAX_ROWS, MAX_BYTES = 65_535, 512 << 20
INDICATOR = 8
FIXED = {"bool": 1, "int8": 1, "uint8": 1, "int16": 2, "int32": 4, "int64": 8, "float32": 4, "float64": 8, "date": 6, "timestamp": 16}


def bounded_length(reported: int | None, cap: int | None, sql_type: str) -> int:
    """The smaller of what is known; an error if neither is."""
    known = [n for n in (reported or None, cap) if n is not None]
    if not known:
        raise ZeroSizedColumn(sql_type)
    return min(known)


def column_width(logical: Logical, column: ColumnDescriptor, max_text: int | None, max_binary: int | None, encoding: str = "utf8") -> int:
    match logical.kind:
        case "utf8":
            if column.length is not None and column.length < 0:
                raise UnknownStringLength(column.sql_type)
            size = bounded_length(column.length, max_text, column.sql_type)
            return INDICATOR + (size * 2 + 2 if encoding == "utf16" else size * 4 + 1)
        case "binary":
            return INDICATOR + bounded_length(column.length, max_binary, column.sql_type)
        case "fixed_binary":
            return INDICATOR + logical.length
        case "decimal":
            return INDICATOR + logical.precision + 2 + 1
        case "time":
            return INDICATOR + (6 if logical.unit == "s" else TIME_WIDTH[logical.unit] + 1)
    return INDICATOR + FIXED[logical.kind]


def rows_per_batch(bytes_per_row: int, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> int:
    """Rows that fit; without columns the byte limit itself is the row count."""
    if bytes_per_row == 0:
        return max_bytes
    rows = max_bytes // bytes_per_row
    if rows == 0:
        raise BufferTooSmall(max_bytes, bytes_per_row)
    return min(max_rows, rows)


@dataclass
class ReaderOptions:
    """All options of a scan. The same object may configure many scans."""

    max_num_rows_per_batch: int = MAX_ROWS
    max_bytes_per_batch: int = MAX_BYTES
    schema: list[tuple[str, Logical]] | None = None
    max_text_size: int | None = None
    max_binary_size: int | None = None
    fallible_allocations: bool = False
    allocation_limit: int = 1 << 31
    value_errors_as_null: bool = False
    trim_fixed_sized_characters: bool = False
    payload_text_encoding: str = "auto"
    enforce_not_null: bool = False
    dbms_name: str | None = None
    widths: dict[str, int] = field(default_factory=dict, init=False)

    @property
    def encoding(self) -> str:
        """utf8 or utf16; "auto" is what the platform's databases speak: UTF-16 on Windows only."""
        if self.payload_text_encoding == "auto":
            return "utf16" if sys.platform == "win32" else "utf8"
        return self.payload_text_encoding

    def row_width(self, columns: list[ColumnDescriptor], logicals: list[Logical]) -> int:
        """Bytes of a row; the widths by column stay in ``widths``."""
        self.widths = {}
        for index, (column, logical) in enumerate(zip(columns, logicals, strict=True)):
            try:
                self.widths[column.name] = column_width(logical, column, self.max_text_size, self.max_binary_size, self.encoding)
            except (ZeroSizedColumn, UnknownStringLength) as e:
                raise ColumnFailure(column.name, index, e) from None
        return sum(self.widths.values())

    def max_rows_per_batch(self, columns: list[ColumnDescriptor], logicals: list[Logical]) -> int:
        rows = rows_per_batch(self.row_width(columns, logicals), self.max_num_rows_per_batch, self.max_bytes_per_batch)
        if self.fallible_allocations:
            for index, (name, width) in enumerate(self.widths.items()):
                if rows * width > self.allocation_limit:
                    raise ColumnFailure(name, index, TooLarge(rows, width))
        return rows
