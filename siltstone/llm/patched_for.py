"""Patched frame-of-reference segments of token ids.

A segment holds the ids of a run of documents, cut into blocks of 128 values.
Each block keeps its minimum and the differences to it. The differences are
packed at the width that holds a given share of them; of the rest, the outliers,
the low bits are packed with the others and position and high bits stand in an
exception list. An index of block starts and exception starts lets a reader
decode any run of values without touching the other blocks.

Layout, little-endian: the magic, n_values u32, n_blocks u32, n_exceptions u32,
block minima u32[b], widths u8[b], block starts u32[b+1] (in 16-byte units),
exception starts u32[b+1], packed blocks, exception positions u8[e], high bits u32[e].
A block of width w takes w rows of four 32-bit words; value i lies in lane i % 4.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"PFR1"
BLOCK = 128
_LANES = 4
_ROWS = BLOCK // _LANES


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """[n, 128] values below 2**width -> [n, width, 4] words."""
    rows = values.reshape(-1, _ROWS, _LANES)
    words = np.zeros((len(rows), width, _LANES), dtype=np.uint32)
    for i in range(_ROWS):
        word, shift = divmod(i * width, 32)
        words[:, word] |= rows[:, i] << np.uint32(shift)
        if shift + width > 32:
            words[:, word + 1] |= rows[:, i] >> np.uint32(32 - shift)
    return words


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    rows = np.empty((len(words), _ROWS, _LANES), dtype=np.uint32)
    mask = np.uint32((1 << width) - 1) if width < 32 else np.uint32(0xFFFFFFFF)
    for i in range(_ROWS):
        word, shift = divmod(i * width, 32)
        value = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            value = value | (words[:, word + 1] << np.uint32(32 - shift))
        rows[:, i] = value & mask
    return rows.reshape(-1, BLOCK)


def encode(ids: np.ndarray, percentile: float = 0.9) -> bytes:
    """One segment of ``ids`` (unsigned 32-bit); no ids give a segment without blocks."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    grid = np.empty(blocks * BLOCK, dtype=np.uint32)
    grid[:n] = ids
    if n:
        grid[n:] = ids[-1]
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1) if n else np.zeros(0, dtype=np.uint32)
    grid -= low[:, None]
    lengths = _bit_lengths(grid)
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    widths = np.partition(lengths, rank, axis=1)[:, rank] if n else np.zeros(0, dtype=np.uint8)
    block, position = np.nonzero(lengths > widths[:, None])
    high = grid[block, position] >> widths[block].astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(widths, dtype=np.uint32)]).astype(np.uint32)
    exceptions = np.searchsorted(block, np.arange(blocks + 1)).astype(np.uint32)
    packed = np.empty((int(starts[-1]), _LANES), dtype=np.uint32)
    for width in np.unique(widths).tolist():
        if width:
            own = np.flatnonzero(widths == width)
            mask = np.uint32((1 << width) - 1) if width < 32 else np.uint32(0xFFFFFFFF)
            packed[starts[own][:, None] + np.arange(width)] = _pack(grid[own] & mask, width)
    head = np.array([n, blocks, len(block)], dtype="<u4")
    parts = (head, low, widths, starts, exceptions, packed, position.astype(np.uint8), high)
    return MAGIC + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


class Segment:
    """A reader of one segment."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a segment")
        self.n, blocks, n_exceptions = np.frombuffer(raw, "<u4", 3, 4).tolist()
        at = 16

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, count, at)
            at += found.nbytes
            return found

        self.low = take("<u4", blocks)
        self.widths = take("u1", blocks)
        self.starts = take("<u4", blocks + 1)
        self.exceptions = take("<u4", blocks + 1)
        self.packed = take("<u4", int(self.starts[-1]) * _LANES).reshape(-1, _LANES)
        self.position = take("u1", n_exceptions)
        self.high = take("<u4", n_exceptions)

    def decode(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Values ``start`` to ``stop``; only the blocks that hold them are read."""
        stop = self.n if stop is None else min(stop, self.n)
        if start >= stop:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // BLOCK, -(-stop // BLOCK)
        widths, starts = self.widths[first:last], self.starts[first:last]
        grid = np.zeros((last - first, BLOCK), dtype=np.uint32)
        for width in np.unique(widths).tolist():
            if width:
                own = np.flatnonzero(widths == width)
                grid[own] = _unpack(self.packed[starts[own][:, None] + np.arange(width)], width)
        ends = self.exceptions[first : last + 1]
        block = np.repeat(np.arange(last - first), np.diff(ends))
        listed = slice(int(ends[0]), int(ends[-1]))
        grid[block, self.position[listed]] |= self.high[listed] << widths[block].astype(np.uint32)
        grid += self.low[first:last, None]
        return grid.reshape(-1)[start - first * BLOCK : stop - first * BLOCK]
