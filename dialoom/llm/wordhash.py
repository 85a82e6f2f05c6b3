"""Words and shingles of Arrow text columns, hashed with numpy straight from the UTF-8 buffers.

Words are maximal runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased. A word's bytes are taken
eight at a time, each followed by a non-linear mixing of 64 bits; words of up to seven bytes have hashes of their
own, as every step is one to one. Words longer than LONG are hashed by xxh3.
"""

from __future__ import annotations

import contextlib
import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of the longest word that is hashed with all others, eight bytes at a time.
LONG = 64
#: Words hashed at a time.
CHUNK = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_frugal = False


def frugal() -> None:
    """In a worker of Spark's: have freed memory given back, which Arrow's default pool and the C library keep."""
    global _frugal
    if _frugal:
        return
    from pyspark import TaskContext

    if TaskContext.get() is not None:
        pa.set_memory_pool(pa.system_memory_pool())
        with contextlib.suppress(Exception):  # the C library does once the least size of large blocks is fixed
            ctypes.CDLL(None).mallopt(-3, 1 << 20)
        _frugal = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place, as a number; zeros follow the last."""
    return windows(np.concatenate([data, np.zeros(8, np.uint8)]))


def windows(data: np.ndarray) -> np.ndarray:
    """A view of contiguous bytes: the eight that begin at each place with as many left, as a number."""
    return np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))


def at_eight(numbers: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The bytes at each place as a number, without those beyond the ``left`` ones."""
    return numbers[at] & _KEEP[np.minimum(left, 8)]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans, by their bytes alone."""
    hashes = np.empty(len(start), dtype=np.uint64)
    rows = eights(data)
    for i in range(0, len(start), CHUNK):
        s, size = start[i : i + CHUNK], (end[i : i + CHUNK] - start[i : i + CHUNK]).astype(np.int64)
        h = mix(at_eight(rows, s, size) ^ (np.minimum(size, 255).astype(np.uint64) << np.uint64(56)))
        more = np.flatnonzero((size > 8) & (size <= LONG))
        at = 8
        while len(more):
            h[more] = mix(h[more] * np.uint64(0x9E3779B97F4A7C15) ^ at_eight(rows, s[more] + at, size[more] - at))
            at += 8
            more = more[size[more] > at]
        for k in np.flatnonzero(size > LONG).tolist():
            h[k] = xxhash.xxh3_64_intdigest(memoryview(np.ascontiguousarray(data[s[k] : s[k] + size[k]])))
        hashes[i : i + CHUNK] = h
    return hashes


def trim() -> None:
    """Give freed memory back to the system, where the C library can; for workers that wait for other stages."""
    with contextlib.suppress(Exception):
        ctypes.CDLL(None).malloc_trim(0)


@dataclass
class Words:
    """Words of a batch: byte spans in ``data`` (lower-cased), hashes, and each row's range of words."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    rows: np.ndarray  # row i has words rows[i]:rows[i + 1]
    bytes: np.ndarray  # row i has bytes bytes[i]:bytes[i + 1]


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]]
    return raw, off - off[0]


def words(texts: pa.Array) -> Words:
    raw, off = buffer(texts)
    data = LOWER[raw]
    n = len(data)
    inside = ~SPACE[data]
    first = np.zeros(n + 1, dtype=bool)
    first[off] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = span_hashes(data, start, end)
    return Words(data, start, end, hashes, np.searchsorted(start, off).astype(np.int64), off)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``size`` words and row offsets into them; a row with fewer words
    (but at least one) has its whole sequence as one, a row without words none."""
    h, rows = w.hash, w.rows
    counts = np.diff(rows)
    per = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    off = np.concatenate([[0], np.cumsum(per)])
    at = np.repeat(rows[:-1] - off[:-1], per) + np.arange(off[-1])
    short = np.repeat(np.where(counts < size, counts, size), per)
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    total = short.astype(np.uint64)
    for k in range(size):
        part = mix(padded[at + k] + np.uint64((2 * k + 1) * 0xD6E8FEB86659FD93 % (1 << 64)))
        total = total * np.uint64(0x2545F4914F6CDD1D) + np.where(k < short, part, np.uint64(0))
    return mix(total), off


def parts(batch: pa.RecordBatch, column: str, most_bytes: int = 3 << 20):
    """Slices of a batch that hold about ``most_bytes`` of text each, at least a row."""
    frugal()
    texts = batch.column(column)
    if not len(texts):
        return
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size, dtype=np.int64)
    i = 0
    while i < len(texts):
        before = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, before + most_bytes, "right")))
        yield batch.slice(i, j - i)
        i = j
    trim()
