"""Arrow batches as NumPy blocks, and stored intermediate tables, for the operators of this package.

The operators run NumPy inside ``mapInArrow`` over bounded blocks of rows. A block holds at most
``BLOCK_BYTES`` of text, or one row if that row alone is longer, so memory follows the longest
text and never the number of rows in a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

BLOCK_BYTES = 1 << 18


def utf8(column: str | Column) -> Column:
    """The column's UTF-8 bytes; null text counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def table_path(sf_dir: str, name: str) -> str:
    """Where a given table lies."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a binary column, n + 1 offsets into them), without a copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    dtype = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``most`` bytes of ``text`` each (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = flat_bytes(batch.column(batch.schema.get_field_index(text)))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(at, at[row] + most, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the given ranges, one range after the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its flat values and the length of each row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


class Powers:
    """Polynomial hashes modulo 2^64 of byte ranges, all ranges of a block at once."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)
        mixed = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.values = mixed * np.uint64(2) + np.uint64(1)

    def _grow(self, size: int) -> None:
        if len(self.up) <= size:
            for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(2 * size + 1, np.uint64(base & (1 << 64) - 1), np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def hashes(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A hash of each range; ranges of equal bytes have equal hashes."""
        self._grow(len(flat))
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(self.values[flat] * self.up[: len(flat)], out=sums[1:])
        ranges = (sums[starts + lengths] - sums[starts]) * self.down[starts]
        ranges ^= ranges >> np.uint64(29)
        return (ranges + lengths.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)


# The white space that separates words, and lower case for A to Z only.
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte of each word, its length, its row): runs of bytes that are not white space."""
    if not len(flat):
        return (np.zeros(0, np.int64),) * 3
    solid = ~WHITE[flat]
    border = np.zeros(len(flat) + 1, bool)
    border[at] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | border[1:-1]
    ends = solid
    ends[:-1] &= ~solid[1:] | border[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends - starts, np.searchsorted(at, starts, side="right") - 1
