import pytest

from lodestone.errors import BufferTooSmall, ColumnFailure, TooLarge, ZeroSizedColumn
from lodestone.functions.inference import ColumnDescriptor
from lodestone.operators.limits import MAX_BYTES, MAX_ROWS, ReaderOptions, bounded_length, rows_per_batch
from lodestone.types import Logical


def test_rule():
    assert rows_per_batch(0) == MAX_BYTES
    assert rows_per_batch(4) == MAX_ROWS
    assert rows_per_batch(100, 10, 1000) == 10
    assert rows_per_batch(101, 10, 1000) == 9
    with pytest.raises(BufferTooSmall) as e:
        rows_per_batch(2, 10, 1)
    assert (e.value.max_bytes_per_batch, e.value.bytes_per_row) == (1, 2)


def test_defaults():
    assert (ReaderOptions().max_num_rows_per_batch, ReaderOptions().max_bytes_per_batch) == (65_535, 536_870_912)


@pytest.mark.parametrize(("reported", "cap", "size"), [(10, None, 10), (None, 5, 5), (10, 5, 5), (3, 5, 3), (0, 7, 7)])
def test_caps(reported, cap, size):
    assert bounded_length(reported, cap, "varchar") == size


def test_no_bound():
    with pytest.raises(ZeroSizedColumn):
        bounded_length(0, None, "varchar")


def test_byte_limit_of_text():
    column = [ColumnDescriptor("a", "varchar", length=512)]
    assert ReaderOptions(max_bytes_per_batch=10 << 20).max_rows_per_batch(column, [Logical("utf8")]) < 65_535
    with pytest.raises(ColumnFailure):
        ReaderOptions().max_rows_per_batch([ColumnDescriptor("a", "varchar")], [Logical("utf8")])
    assert ReaderOptions(max_text_size=1024).max_rows_per_batch([ColumnDescriptor("a", "varchar")], [Logical("utf8")]) > 0


def test_fallible_allocation():
    options = ReaderOptions(fallible_allocations=True, allocation_limit=1000)
    with pytest.raises(ColumnFailure) as e:
        options.max_rows_per_batch([ColumnDescriptor("a", "varchar", length=512)], [Logical("utf8")])
    assert isinstance(e.value.reason, TooLarge)
