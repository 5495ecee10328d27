"""Arrow text columns as numpy arrays: slices of rows, word bounds and hashes, grouped values.

Hashes are 64-bit polynomials over random byte values, mixed at the end; they depend on the text alone,
so they are equal in every task and every run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructType

SLICE_BYTES = 1 << 20
WHITE_SPACE = b" \t\n\x0b\x0c\r"

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each 64-bit value (a bijection)."""
    x = np.array(x, np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def lower_ascii(values: np.ndarray) -> np.ndarray:
    """The byte table ``values`` with A-Z taken as a-z."""
    values = values.copy()
    values[65:91] = values[97:123]
    return values


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        factors = np.full(size, base & (2**64 - 1), np.uint64)
        factors[0] = 1
        have = _powers[base] = np.multiply.accumulate(factors)
    return have[:n]


def inverse_powers(n: int) -> np.ndarray:
    return powers(n, _INVERSE)


def sums(values: np.ndarray) -> np.ndarray:
    """Running sums with a leading zero, modulo 2**64."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


class Spans:
    """Polynomial hashes of any spans of one sequence of 64-bit values, each in constant time."""

    def __init__(self, values: np.ndarray):
        self.sums = sums(values * powers(len(values)))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * inverse_powers(len(self.sums))[start]


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; nulls are empty."""
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data or b"", np.uint8), offsets


def slices(array: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, end row, bytes, n + 1 offsets from zero."""
    data, offsets = utf8(array)
    row, n = 0, len(array)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def received(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task. What Arrow's pool keeps of earlier ones is given back: a worker keeps it while it waits, too."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(WHITE_SPACE)] = True


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes outside ``is_space``; no run crosses an offset."""
    inside = ~is_space[data]
    if not inside.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    starts[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def rows_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row that holds each position (rows without bytes hold none)."""
    return np.searchsorted(offsets, positions, "right") - 1


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.diff(np.append(first, len(keys)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def with_text_columns(
    df: DataFrame, fn: Callable[[pa.Array], list[pa.Array]], added: str, text: str = "text"
) -> DataFrame:
    """``df`` with the columns that ``fn`` makes from each batch of texts; columns of the same names are replaced."""
    new = DataType.fromDDL(added)
    taken = {field.name.lower() for field in new}
    kept = df.select(*[df[c] for c in df.columns if c.lower() not in taken])
    at = [c.lower() for c in kept.columns].index(text)
    schema = StructType([*kept.schema.fields, *new.fields])
    names = schema.names

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in received(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *fn(batch.column(at))], names=names)
            del batch

    return kept.mapInArrow(task, schema)


def list_column(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A list column from concatenated values and the n + 1 bounds of its rows."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
