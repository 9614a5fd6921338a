"""Whole batches of text as flat numpy arrays: spans, 64-bit span hashes and runs of equal values."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once, one row at least: a worker's memory follows the longest text, not the batch.
CHUNK = 1 << 20
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def returning(work: Callable) -> Callable:
    """A task's work on batches that gives freed memory back to the system at its end.

    Workers are kept from task to task and would hold on to what the largest one took.
    """

    @wraps(work)
    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library's
        if trim:
            trim(0)

    return done


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit moves every output bit."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_KEYS = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1 << 40))
_place_keys = mixed(np.arange(4096, dtype=np.uint64)) | np.uint64(1)


def place_keys(n: int) -> np.ndarray:
    global _place_keys
    if n > len(_place_keys):
        _place_keys = mixed(np.arange(1 << int(n - 1).bit_length(), dtype=np.uint64)) | np.uint64(1)
    return _place_keys


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offset of each row; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about `most` bytes each, and one row at least."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        yield low, min(high, rows)
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and how many words each row has."""
    inside = ~SEPARATOR[data]
    bounds = np.zeros(len(data) + 1, bool)
    bounds[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | bounds[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | bounds[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span (multilinear: one random key per byte value and place).

    Worked out over CHUNK bytes of spans at a time, so that one very long text takes little more than its words.
    """
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    for low, high in chunks(np.concatenate([[0], np.cumsum(lengths)])):
        size, first = lengths[low:high], np.cumsum(lengths[low:high]) - lengths[low:high]
        if high == low + 1 and size[0] > CHUNK:  # one very long word
            for at in range(0, int(size[0]), CHUNK):
                part = data[starts[low] + at : min(starts[low] + at + CHUNK, ends[low])]
                keys = mixed(np.arange(at, at + len(part), dtype=np.uint64)) | np.uint64(1)
                out[low] += (BYTE_KEYS[part] * keys).sum(dtype=np.uint64)
            continue
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        values = BYTE_KEYS[data[place + np.repeat(starts[low:high], size)]]
        values *= place_keys(int(size.max()))[place]
        out[low:high] = np.add.reduceat(values, first)
    return mixed(out + lengths.astype(np.uint64))


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, group): the index of one row of each group of equal keys and each row's group.

    Sorts (high key bits, index) as one number. Keys that differ in low bits alone may leave a
    group in two, which callers allow for.
    """
    n = len(keys)
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = (np.sort((keys & ~low) | np.arange(n, dtype=np.uint64)) & low).astype(np.int64)
    if not n:
        return order, order
    ranked = keys[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


def run_starts(ranked: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of a sorted array start."""
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return np.flatnonzero(new)


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of so many values."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
