"""Hashed word shingles of whole texts, as numpy over Arrow batches.

Words are runs of bytes other than 0x20 and 0x09-0x0D; A-Z are lower-cased, nothing else is folded.  A word gets a
64-bit polynomial hash over a random byte table, a shingle a second polynomial over its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
_U = np.uint64


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**64, n, dtype=np.uint64, endpoint=False) | _U(1)


_BYTE = _odd(11, 256)
_BYTE[65:91] = _BYTE[97:123]  # A-Z read as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of a text column: (first row, end row, bytes, offsets of each row in the bytes).

    A chunk holds some CHUNK_BYTES; a longer text is a chunk of its own.  NULL reads as an empty text.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of each row (one more entry than rows)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    start = inside[1:] & ~inside[:-1]
    end = inside[:-1] & ~inside[1:]
    cut = offsets[1:-1]  # words end where a row ends
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = cut[inside[cut] & inside[cut + 1]]
    start[cut] = True
    end[cut] = True
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_STEP, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(_BACK, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; fewer words than ``size`` are one shingle, no words none."""
    factors = powers(0xD6E8FEB86659FD93, size)
    for first, end, data, offsets in chunks(texts):
        starts, ends, rows = words(data, offsets)
        hashes = word_hashes(data, starts, ends)
        n = max(len(hashes) - size + 1, 0)
        rolled = np.zeros(n, np.uint64)
        for k in range(size):
            rolled += hashes[k:k + n] * factors[k]
        rolled = mix(rolled + _U(size))
        for i in range(end - first):
            a, b = rows[i], rows[i + 1]
            if b - a >= size:
                yield np.unique(rolled[a:b - size + 1])
            elif b > a:
                yield mix(np.array([(hashes[a:b] * factors[:b - a]).sum(dtype=np.uint64)]) + _U(b - a))
            else:
                yield rolled[:0]


def set_id(values: np.ndarray) -> int:
    """A 64-bit identity of a set of hashes (signed, as Spark's long)."""
    body = (int(mix(values).sum(dtype=np.uint64)) + len(values) * _STEP) % 2**64
    return int(mix(np.array([body], np.uint64)).view(np.int64)[0])
