"""Texts of an Arrow batch as numpy arrays: bytes, words, shingles and n-grams, a whole slice of documents at a time.

Every function takes the joined UTF-8 bytes of several documents with their
offsets, so that the cost of a call is shared by many documents and a document
may be of any length.  Hashes are 64 bits and depend on nothing but the bytes,
so that every task, and every run of a task, agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; one longer document is a slice of its own.
SLICE = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all (the finalizer of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_WEIGHTS = mix(np.arange(1000, 1064, dtype=np.uint64)) | _U(1)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), modulo 2^64."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        size = max(SLICE + 1, n)
        held = np.ones(size, dtype=np.uint64)
        held[1:] = _U(base)
        held = np.multiply.accumulate(held)
        if size <= 4 * SLICE:
            _POWERS[base] = held
    return held[:n]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first document, bytes, offsets) of runs of documents of about ``SLICE`` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and for each document the place of its first word (and the end).

    A word is a longest run of bytes other than space and \\t \\n \\v \\f \\r.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * _powers(_BASE, n), out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * _powers(_BASE_INVERSE, n)[start] + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(start, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each document the sorted distinct hashes of its shingles of ``size`` words.

    A document of fewer words, but one at least, has its whole sequence as its
    one shingle; a document without words has none.
    """
    hashes, first = words(data, offsets)
    n = len(hashes)
    runs = np.zeros(max(0, n - size + 1), dtype=np.uint64)
    for j in range(size):
        runs += hashes[j : j + len(runs)] * _WEIGHTS[j]
    runs = mix(runs)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            whole = (hashes[a:b] * _WEIGHTS[32 : 32 + b - a]).sum(dtype=np.uint64) + _U(b - a)
            out.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` bytes, by its start."""
    n = len(data)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, n), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * _powers(_BASE_INVERSE, n)[: n - width + 1])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each run of bytes [start, end); runs may overlap."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))
