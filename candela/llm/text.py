"""Vectorised words and word hashes over Arrow string columns.

A chunk of documents is one byte buffer; words are maximal runs of bytes of a
given class, and every word's 64-bit hash comes from one running sum over the
buffer (a polynomial over random byte values, modulo 2**64, then mixed), so no
Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: words `[^\x20\x09-\x0D]+`
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False

#: words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_LOWERED = _VALUE[LOWER]
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()  # as the chunks need: small ones leave the memory
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p, out=p)
    return _powers[0], _powers[1]


def drop_powers() -> None:
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Words(NamedTuple):
    hashes: np.ndarray  #: uint64 per word
    starts: np.ndarray  #: byte offset in the chunk
    ends: np.ndarray
    first: np.ndarray   #: per document, the index of its first word; one more at the end


def words(buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    """Lower-cased (A-Z) words of the documents ``buf[offsets[i]:offsets[i+1]]``."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64))
    inside = kind[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    begins[cut] = inside[cut]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    stops[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    power, inverse = _pow(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.multiply(_LOWERED[buf], power[:n], out=sums[1:])
    np.cumsum(sums, out=sums)
    h = mix((sums[ends] - sums[starts]) * inverse[starts])
    return Words(h, starts, ends, np.searchsorted(starts, offsets))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of row ranges of about
    ``limit`` bytes; a longer text is a chunk of its own. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi
