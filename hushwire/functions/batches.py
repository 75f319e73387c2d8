"""Arrow batches cut by bytes, so that the memory of a worker follows bytes and not rows."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a part, unless a single row is longer.
BYTES = 4 << 20


def weights(c: pa.Array) -> np.ndarray:
    """Bytes of every row of a column, about: strings by their own lengths, lists by their number of values."""
    if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type):
        return pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if pa.types.is_list(c.type):
        n = pc.list_value_length(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        held = c.flatten()
        return n * (held.nbytes // max(1, len(held)))
    return np.full(len(c), 8, np.int64)


def parts(batch: pa.RecordBatch, most: int = BYTES) -> Iterator[pa.RecordBatch]:
    """batch in parts of at most `most` bytes, one row at least."""
    if not batch.num_rows:
        return
    size = sum((weights(c) for c in batch.columns), np.zeros(batch.num_rows, np.int64))
    part = np.cumsum(size) // most
    for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def lists(values: np.ndarray, lengths: np.ndarray, null: np.ndarray) -> pa.Array:
    """A column of lists from their values side by side."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(null))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of lengths[0] numbers, then those of the next."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))
