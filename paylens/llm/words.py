"""Words, shingles and their hashes over Arrow string columns, in numpy and without Python strings.

A word is a run of bytes outside blank, tab, line feed, vertical tab, form feed and carriage
return; A-Z are lower-cased first. Both rules work on UTF-8 bytes, so a column's own buffer is
hashed as it lies in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_TABLE = np.random.default_rng(0x5EED).integers(1, 2**63, size=256, dtype=np.uint64)
_TABLE[65:91] = _TABLE[97:123]  # A-Z hash like a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_LETTERS = np.ones(256, bool)  # for words of letters and digits; every byte beyond ASCII is in a word
NOT_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown by doubling and kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        filled = 1
        while filled < size:
            have[filled:2 * filled] = have[:filled] * np.uint64(pow(base, filled, 2**64))
            filled *= 2
        if size <= 1 << 20:  # longer tables are made anew
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that what is made of a slice stays small."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def utf8(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """Each value as a view of its UTF-8 bytes; a null is empty."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        chunk = chunk.cast(pa.large_string())
        _, offsets, data = chunk.buffers()
        if offsets is None or len(chunk) == 0:
            continue
        ends = np.frombuffer(offsets, np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
        view = memoryview(data) if data is not None else memoryview(b"")
        valid = chunk.is_valid().to_numpy(zero_copy_only=False)
        for i in range(len(chunk)):
            yield view[ends[i]:ends[i + 1]] if valid[i] else view[:0]


def word_spans(raw: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words start and end; ``between`` flags the bytes outside words."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~between[raw]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def word_hashes(raw: np.ndarray, between: np.ndarray = _SPACE) -> np.ndarray:
    """A 64-bit hash of every word, in order."""
    starts, ends = word_spans(raw, between)
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * powers(_BASE, len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(raw))[starts])


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """The Karp-Rabin hash of every run of ``size`` words, in order: sums of words times powers of
    a base, taken as differences of running sums and brought to the same power."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(_BASE, len(words)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(_INVERSE, len(words))[:len(sums) - size])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of `size` words; fewer words count as one run, none give none."""
    if not len(words):
        return words
    size = min(size, len(words))
    rolled = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        rolled = mix(rolled * np.uint64(0xD6E8FEB86659FD93) + words[k:len(words) - size + 1 + k] + np.uint64(size))
    return np.unique(rolled)


def shingle_set(text: bytes | memoryview, size: int) -> np.ndarray:
    return shingles(word_hashes(np.frombuffer(text, np.uint8)), size)
