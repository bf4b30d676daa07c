"""Words and span hashes of a text column, computed by numpy over blocks of an Arrow batch.

A block holds whole rows and about BLOCK_BYTES bytes, so that memory does not depend on the
size of the batch; a longer text is a block of its own. Words are maximal runs of bytes that
a table marks. As every byte of a multi-byte code point is marked, or none, runs of bytes are
runs of code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

SPACES = b" \t\n\x0b\x0c\r"
# The odd base of a polynomial hash modulo 2**64, and its inverse.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_table(marked: bytes | range | list[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(marked)] = True
    return table


IS_SPACE = byte_table(SPACES)
NO_SPACE = ~IS_SPACE
# [0-9a-z] and everything beyond ASCII, for lower-cased text.
IS_ALNUM = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass(frozen=True)
class Block:
    """Rows `first` to `first + rows` of a column, as their bytes end to end."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many of a row's bytes are flagged, or the sum of their values."""
        kind = np.float64 if flags.dtype.kind == "f" else np.int64
        before = np.zeros(len(flags) + 1, kind)
        np.cumsum(flags, out=before[1:])
        return before[self.bounds[1:]] - before[self.bounds[:-1]]

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, side="right") - 1


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column's rows in order; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    values = column.cast(pa.large_binary()).fill_null(b"")
    if not len(values):
        return
    _, offsets, data = values.buffers()
    bounds = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(values):
        end = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(values))
        yield Block(row, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row])
        row = end


def spans(block: Block, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked bytes; no run crosses the bounds of a row."""
    n = len(block.data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    firsts = block.bounds[:-1][block.bounds[:-1] < block.bounds[1:]]
    starts = marked.copy()
    starts[1:] &= ~marked[:-1]
    starts[firsts] = marked[firsts]
    ends = marked.copy()
    ends[:-1] &= ~marked[1:]
    lasts = firsts[1:] - 1
    ends[lasts] = marked[lasts]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every \\n-split line; an empty row is one empty line."""
    breaks = np.flatnonzero(block.data == 10)
    rows = np.concatenate([np.arange(block.rows), block.row_of(breaks)])
    starts = np.concatenate([block.bounds[:-1], breaks + 1])
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = np.append(rows[1:] != rows[:-1], True)
    ends[last] = block.bounds[1:]
    return rows, starts, ends


class _Powers:
    """Powers of the hash's base and its inverse, as long as the largest block so far."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            size = max(n + 1, BLOCK_BYTES + 1)
            up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
            up[0] = down[0] = 1
            if size > 4 * BLOCK_BYTES:  # one very long text: not kept
                return np.multiply.accumulate(up), np.multiply.accumulate(down)
            cls.up, cls.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return cls.up, cls.down


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes and length."""
    up, down = _Powers.upto(len(data))
    before = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=before[1:])
    hashed = (before[ends] - before[starts]) * down[starts]
    return mixed(hashed + (ends - starts).astype(np.uint64))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each position on; the last k - 1 positions are left out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for j in range(1, k):
        total = total * np.uint64(_BASE) + hashes[j : n + j]
    return mixed(total + np.uint64(k))


def first_words(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Index of each row's first word (bounds of the rows in the list of words)."""
    return np.searchsorted(rows, np.arange(n_rows + 1))
