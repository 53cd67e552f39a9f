"""Static range asymmetric numeral system over integer symbols, in numpy.

Symbols are dealt round-robin to interleaved lanes; every lane is a 64-bit state that sheds 32-bit
words. One shared table of frequencies (they sum to 2**BITS) serves all blocks. A block can be
decoded by itself, and at every checkpoint inside it: the states of all lanes, the place in the
words and a checksum are kept there, so that the stretches of a block are decoded side by side.

A block in bytes, little-endian: magic, symbols, lanes, rows of a stretch (u32 each); for each
stretch its first word (u32), the CRC-32 of its symbols as u32 (u32) and its lane states (u64);
the CRC-32 of all that (u32); the words (u32).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BITS = 20
MAGIC = 0x31534E52
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


@dataclass(frozen=True)
class Table:
    """Frequency and first slot of every symbol, and the symbol of every slot."""

    freq: np.ndarray
    start: np.ndarray
    slots: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Table:
        """Counts scaled to a sum of 2**BITS; a symbol that occurs keeps at least one slot. What
        rounding leaves over or lacks goes to the most frequent symbols, the first of a tie first."""
        counts = np.asarray(counts, np.float64)
        seen = counts > 0
        if seen.sum() > 1 << BITS:
            raise ValueError("more symbols than slots")
        if not seen.any():
            return cls(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        freq = np.where(seen, np.maximum(1, np.floor(counts * ((1 << BITS) / counts.sum()))), 0).astype(np.int64)
        left = (1 << BITS) - int(freq.sum())
        order = np.argsort(-freq, kind="stable")
        if left > 0:
            freq[order[0]] += left
        while left < 0:
            for s in order:
                take = min(-left, int(freq[s]) // 2)
                freq[s] -= take
                left += take
                if not left:
                    break
        ends = np.cumsum(freq)
        slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        return cls(freq.astype(np.uint64), (ends - freq).astype(np.uint64), slots)


def encode_all(blocks: list[np.ndarray], table: Table, lanes: int = 256, rows: int = 128) -> list[bytes]:
    """Several blocks, side by side. Works from the last row of symbols to the first, as a decoder
    reads them forward. A lane without a symbol in a row takes a step that leaves its state alone."""
    sizes = [len(b) for b in blocks]
    height = max((-(-n // lanes) for n in sizes), default=0)
    freq = np.full((height, len(blocks), lanes), 1 << BITS, np.uint64)
    start = np.zeros_like(freq)
    for k, block in enumerate(blocks):
        flat = np.full(height * lanes, 1 << BITS, np.uint64)
        flat[:len(block)] = table.freq[block]
        freq[:, k] = flat.reshape(height, lanes)
        flat[:] = 0
        flat[:len(block)] = table.start[block]
        start[:, k] = flat.reshape(height, lanes)
    states = np.full((len(blocks), lanes), _LOW, np.uint64)
    shed = np.zeros((height, len(blocks), lanes), bool)
    words = np.zeros((height, len(blocks), lanes), np.uint32)
    marks = {}
    shift, limit = np.uint64(BITS), freq << np.uint64(63 - BITS)
    for row in range(height - 1, -1, -1):
        full = np.greater_equal(states, limit[row], out=shed[row])
        words[row] = states
        states = np.where(full, states >> _WORD, states)
        quotient = states // freq[row]
        states += (quotient << shift) - quotient * freq[row] + start[row]
        if row % rows == 0:
            marks[row // rows] = states.copy()
    out = []
    for k, block in enumerate(blocks):
        counts = shed[:, k].sum(axis=1)
        before = np.concatenate([[0], np.cumsum(counts)])
        head = np.array([MAGIC, sizes[k], lanes, rows], "<u4").tobytes()
        for mark in range(-(-sizes[k] // (lanes * rows))):
            part = np.ascontiguousarray(block[mark * rows * lanes:(mark + 1) * rows * lanes], "<u4")
            head += np.array([before[mark * rows], zlib.crc32(part.tobytes())], "<u4").tobytes() + marks[mark][k].astype("<u8").tobytes()
        out.append(head + np.array([zlib.crc32(head)], "<u4").tobytes() + words[:, k][shed[:, k]].astype("<u4").tobytes())
    return out


def encode(symbols: np.ndarray, table: Table, lanes: int = 256, rows: int = 128) -> bytes:
    return encode_all([symbols], table, lanes, rows)[0]


def decode(block: bytes, table: Table) -> np.ndarray:
    """The symbols of a block; raises ValueError where a checksum does not hold."""
    magic, n, lanes, rows = (int(v) for v in np.frombuffer(block, "<u4", 4))
    if magic != MAGIC or not lanes or not rows:
        raise ValueError("not a block")
    stretch = rows * lanes
    parts = -(-n // stretch)
    size = 16 + parts * (8 + 8 * lanes)
    if len(block) < size + 4 or zlib.crc32(block[:size]) != int(np.frombuffer(block, "<u4", 1, size)[0]):
        raise ValueError("damaged block header")
    marks = np.frombuffer(block, np.dtype([("at", "<u4"), ("crc", "<u4"), ("state", "<u8", (lanes,))]), parts, 16)
    words = np.frombuffer(block, "<u4", offset=size + 4).astype(np.uint64)
    words = np.append(words, np.uint64(0))
    x, at = marks["state"].astype(np.uint64), marks["at"].astype(np.int64)
    left = n - np.arange(parts)[:, None] * stretch - np.arange(lanes)  # symbols at or after a lane's first row
    out = np.zeros((parts, rows, lanes), np.uint32)
    mask, shift = np.uint64((1 << BITS) - 1), np.uint64(BITS)
    whole = (parts - 1) * stretch  # all but the last stretch are full
    for row in range(rows):
        slot = x & mask
        symbol = table.slots[slot.astype(np.int64)]
        new = table.freq[symbol] * (x >> shift) + slot - table.start[symbol]
        if row * lanes + lanes > n - whole:  # the last stretch ends in this row or before
            new = np.where(left > row * lanes, new, x)
            need = (new < _LOW) & (left > row * lanes)
        else:
            need = new < _LOW
        rank = np.cumsum(need, axis=1)
        place = np.minimum((at[:, None] + rank - 1)[need], len(words) - 1)
        new[need] = (new[need] << _WORD) | words[place]
        at += rank[:, -1]
        x = new
        out[:, row] = symbol
    if parts and (x[-1] != _LOW).any():
        raise ValueError("damaged block")
    symbols = out.reshape(-1)[:n] if parts else np.zeros(0, np.uint32)
    for k in range(parts):
        if zlib.crc32(np.ascontiguousarray(symbols[k * stretch:(k + 1) * stretch], "<u4").tobytes()) != int(marks["crc"][k]):
            raise ValueError("damaged block")
    return symbols
