"""64-bit keys of blocks, cut into equal ranges of all keys: what one block sends to one range is a row of packed arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Keys that one range gets on average, which bounds what a task holds.
RANGE_MASS = 1 << 22


def n_ranges(spark, mass: int) -> int:
    """Ranges for ``mass`` keys in all: one per shuffle partition, or more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-mass // RANGE_MASS))


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)


def run_bounds(sorted_parts: np.ndarray) -> np.ndarray:
    """Where runs of equal parts begin, and the end."""
    changes = np.flatnonzero(sorted_parts[1:] != sorted_parts[:-1]) + 1
    return np.concatenate(([0], changes, [len(sorted_parts)]) if len(sorted_parts) else ([0],)).astype(np.int32)


def cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The runs' values as one binary each."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds * values.itemsize), pa.py_buffer(values)])


def packed(batch: pa.RecordBatch | pa.Table, name: str, kind: type) -> Iterator[np.ndarray]:
    """The arrays of a column of binaries."""
    return (np.frombuffer(v.as_buffer(), kind) for v in batch.column(name))
