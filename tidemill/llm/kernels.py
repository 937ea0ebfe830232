"""Numpy work on the bytes of many texts at once, used inside tasks.

Texts come as one byte buffer with bounds, the way Arrow stores a string column. Hashes of words
and of runs of words are polynomials modulo 2**64 taken from prefix sums, so every window costs the
same whatever its length; :func:`mix` then spreads their bits.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Bytes between words: space and the five ASCII controls from tab to carriage return.
SEPARATORS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
BLOCK_BYTES = 1 << 19
BATCH_ROWS = 500  # texts that are handed to Python at once
_POWER_STEP = 1 << 16

_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BYTE_VALUES = np.random.default_rng(20_261).integers(1, 2**63, 256, dtype=np.uint64)
BYTE_BASE, WORD_BASE = 0x9E37_79B9_7F4A_7C15, 0xD6E8_FEB8_6659_FD93
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values; different salts give unrelated results."""
    x = values + np.uint64((0x9E37_79B9_7F4A_7C15 * (salt + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D0_49BB_1331_11EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count`` powers of an odd base modulo 2**64, and of its inverse."""
    found = _POWERS.get(base)
    if found is None or len(found[0]) < count:
        size = -(-count // _POWER_STEP) * _POWER_STEP  # they stay with the worker: not doubled to be sure
        tables = []
        for factor in (base, pow(base, -1, 2**64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        found = tuple(tables)
        if size <= 2 * BLOCK_BYTES:  # larger ones are not kept for a worker's life
            _POWERS[base] = found
    up, down = found
    return up[:count], down[:count]


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums from which :func:`span_hash` takes the hash of any span of ``values``."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, max(1, len(values)))[0][: len(values)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of the spans ``start:end``, the same wherever the same values stand."""
    down = powers(base, len(sums))[1]
    return (sums[end] - sums[start]) * down[start]


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python :data:`BATCH_ROWS` at a time, where the submitter has not set a number.

    Spark's own ten thousand make buffers of tens of megabytes of text on both sides of every running task, which
    its executors keep. The setting stays with the session, since plans are run after the operators have returned.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, BATCH_ROWS)


def blocks(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches whose texts have about ``most`` bytes at most.

    Numpy's work on a block takes some fifty times its bytes, so this bounds a task's memory. A text longer than a
    block comes alone; :func:`slices` takes it in parts. What the task has used goes back to the system at its end, since the
    worker's next task may be of another kind.
    """
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = (np.cumsum(size) - size) // most
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)
    _give_back()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Words:
    """The words of a block of texts: maximal runs of bytes that are no separators."""

    def __init__(self, column: pa.Array | tuple[np.ndarray, np.ndarray], lower: bool = False):
        """``column`` may also be the bytes and bounds that :func:`text_buffer` gives."""
        self.data, self.bounds = column if isinstance(column, tuple) else text_buffer(column)
        if lower:
            self.data = _LOWER[self.data]
        apart = _IS_SEPARATOR[self.data]
        cut = np.zeros(len(self.data) + 1, bool)  # a text ends here, or the buffer
        cut[self.bounds] = True
        inside = ~apart
        before = np.concatenate(([True], apart[:-1])) if len(apart) else apart
        after = np.concatenate((apart[1:], [True])) if len(apart) else apart
        self.start = np.flatnonzero(inside & (before | cut[:-1]))
        self.end = np.flatnonzero(inside & (after | cut[1:])) + 1
        #: Words of text ``i`` are ``first[i]:first[i + 1]``.
        self.first = np.searchsorted(self.start, self.bounds)

    def hashes(self) -> np.ndarray:
        sums = prefix(BYTE_VALUES[self.data], BYTE_BASE)
        return mix(span_hash(sums, self.start, self.end, BYTE_BASE))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def slices(
    column: pa.Array, overlap: int, lower: bool = False, most: int | None = None
) -> Iterator[tuple[Words, int]]:
    """The words of a block in one part, or those of a single long text in several.

    Gives words with the number, in the text, of the first of them. Parts of a long text have about ``most`` bytes
    (:data:`BLOCK_BYTES`), end between words and begin with the last ``overlap`` words of the part before, so that a run of one word
    more lies whole in one part and in no other. Only a single word is never cut.
    """
    most = most or BLOCK_BYTES
    data, bounds = text_buffer(column)
    if len(bounds) != 2 or len(data) <= 2 * most:
        yield Words((data, bounds), lower), 0
        return
    begin = first = at = 0
    while at < len(data):
        stop = _next_separator(data, at + most)
        part = data[begin:stop]
        words = Words((part, np.array([0, len(part)], np.int64)), lower)
        yield words, first
        kept = min(overlap, len(words.start))
        first += len(words.start) - kept
        begin = begin + int(words.start[-kept]) if kept else stop
        at = stop


def _next_separator(data: np.ndarray, at: int) -> int:
    while at < len(data):
        found = np.flatnonzero(_IS_SEPARATOR[data[at : at + 4096]])
        if len(found):
            return at + int(found[0])
        at += 4096
    return len(data)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words of a block, also of those that leave their text."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    sums = prefix(hashes, WORD_BASE)
    at = np.arange(len(hashes) - size + 1)
    return mix(span_hash(sums, at, at + size, WORD_BASE), size)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values."""
    found, span = values, 1
    while span * 2 <= width:
        found = np.minimum(found[:-span], found[span:])
        span *= 2
    rest = width - span
    return np.minimum(found[: len(found) - rest], found[rest:]) if rest else found


def shingle_sets(column: pa.Array, size: int, lower: bool = True) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``size`` words.

    A text with fewer words has one shingle, all of it; one without words has none. Of a long text no more than its set
    and one part's shingles are held.
    """
    parts = slices(column, size - 1, lower)
    words, _ = next(parts)
    found = []
    for more, _ in parts:
        if not found:
            found.append(np.unique(windows(words.hashes(), size)))
        found.append(np.unique(windows(more.hashes(), size)))
    if found and (any(map(len, found))):
        yield np.unique(np.concatenate(found))
        return
    if found:  # a long text of a few very long words
        words = Words(column, lower)
    own = words.hashes()
    runs = windows(own, size)
    sums = prefix(own, WORD_BASE)
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if last - first >= size:
            yield np.unique(runs[first : last - size + 1])
        elif last > first:
            whole = span_hash(sums, np.array([first]), np.array([last]), WORD_BASE)
            yield mix(whole, last - first)
        else:
            yield np.zeros(0, np.uint64)


def binary_column(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, kind))
