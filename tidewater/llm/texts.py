"""Vectorised helpers over Arrow text batches, used inside tasks.

Words are runs of characters other than the six ASCII white-space characters; NULL texts count as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
#: glibc's ``malloc_trim``, where the C library has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


class Words(NamedTuple):
    """Word ``i`` of the slice is ``vocabulary[codes[i]]``; text ``d`` has the words ``bounds[d]:bounds[d + 1]``."""

    codes: np.ndarray
    bounds: np.ndarray
    vocabulary: pa.Array


def give_back() -> None:
    """Free memory of this worker goes back to the system, as the worker shares its machine with the JVM and lives on.

    Arrow and the C library keep freed memory for the next step, which may be another operator's.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text each; a longer text is a run of its own.

    Arrow's spare memory goes back to the system with each batch, as a worker shares its machine with the JVM.
    """
    if batch.num_rows == 0:
        return
    pa.default_memory_pool().release_unused()
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(size):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    yield batch.slice(start)


def filled(column: pa.Array) -> pa.Array:
    """The texts as large strings, NULL as empty; copied, as pyarrow's ascii_lower misreads arrays that begin inside a buffer."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    return texts.take(pa.array(np.arange(len(texts))))


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    """Words of each text with codes into the distinct words of the slice; ``lower`` lower-cases A-Z only."""
    if lower:
        texts = pc.ascii_lower(texts)
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    bounds = np.asarray(split.offsets).astype(np.int64)
    bounds = bounds - bounds[0]
    some = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False).astype(bool)
    if not some.all():
        before = np.concatenate(([0], np.cumsum(some)))
        bounds = before[bounds]
        flat = flat.filter(pa.array(some))
    coded = flat.dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds, coded.dictionary)


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each element, from the rows' bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i]`` of all i, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a large string array together, and the bounds of each."""
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in vocabulary.cast(pa.large_binary()).to_pylist()), dtype=np.uint64, count=len(vocabulary))
