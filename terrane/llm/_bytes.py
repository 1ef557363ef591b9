"""Vectorised words and hashes over Arrow text columns.

A batch is walked in runs of rows of about a mebibyte, so memory follows the longest text and not the batch. Word hashes
are 64-bit polynomials over a fixed random table, read from prefix sums: no Python object is made for a word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_MASK = (1 << 64) - 1
_rng = np.random.default_rng(20240229)
_TABLES = _rng.integers(1, 1 << 63, size=(2, 256), dtype=U64) * U64(2) + U64(1)
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1, 0x165667B19E3779F9 | 1, 0xD6E8FEB86659FD93 | 1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def tidy(work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of batches; when a task ends, the memory that its worker no longer uses goes back to the system,
    because workers live on for later stages."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            _powers.clear()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def as_binary(column) -> pa.Array:
    """A string or binary column as one large_binary array; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    column = column.cast(pa.large_binary())
    return pc.fill_null(column, b"") if column.null_count else column


def runs(column, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of consecutive whole texts; a run exceeds the limit only if one text does."""
    a = as_binary(column)
    if not len(a):
        return
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, off[i : j + 1] - off[i], data[off[i] : off[j]]
        i = j


def class_table(excluded: list[tuple[int, int]]) -> np.ndarray:
    """True for the bytes of a word: those outside the given closed ranges."""
    table = np.ones(256, bool)
    for a, b in excluded:
        table[a : b + 1] = False
    return table


#: Words that white space ends, and words of digits, small letters and bytes beyond ASCII.
SPACED = class_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = class_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each text's words begin in them (one more entry than texts)."""
    inside = table[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begin[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64, grown by doubling."""
    got = _powers.get(which)
    if got is None or len(got[0]) < n:
        size = max(1 << 17, 1 << (n - 1).bit_length()) if n else 1
        pair = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            p = np.full(size, base, U64)
            p[0] = 1
            pair.append(np.cumprod(p, dtype=U64))
        got = _powers[which] = (pair[0], pair[1])
    return got[0][:n], got[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64 bits: every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    power, inverse = powers(seed, len(data))
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(_TABLES[seed][data] * power, out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def window_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of each k consecutive entries; empty if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    power, inverse = powers(2 + seed, len(words))
    total = np.zeros(len(words) + 1, U64)
    np.cumsum(words * power, out=total[1:])
    return mix((total[k:] - total[:-k]) * inverse[:n])


def within(offsets: np.ndarray, n: int, k: int) -> np.ndarray:
    """Of the n - k + 1 windows of k entries, True for those that stay inside one text."""
    if n < k:
        return np.zeros(0, bool)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return owner[: n - k + 1] == owner[k - 1 :]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ranges start .. start + length."""
    lengths = np.asarray(lengths, np.int64)
    if not lengths.sum():
        return np.zeros(0, np.int64)
    first = np.repeat(np.asarray(starts, np.int64) - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return first + np.arange(lengths.sum())


def blobs(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A large_binary array whose value i is the bytes of data[bounds[i]:bounds[i + 1]]."""
    raw = np.ascontiguousarray(data)
    off = np.asarray(bounds, np.int64) * raw.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off.tobytes()), pa.py_buffer(raw.tobytes())])


def blob_table(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A record batch; large_binary columns are narrowed as Spark's binary wants them."""
    out = []
    for field in schema:
        value = columns[field.name]
        if not isinstance(value, pa.Array):
            value = pa.array(value, field.type, from_pandas=False)
        out.append(value.cast(field.type) if value.type != field.type else value)
    return pa.RecordBatch.from_arrays(out, schema=schema)
