"""Array kernels over a batch of texts: bytes, word boundaries and hashes, without per-word Python.

They run inside Arrow tasks.  A batch is cut into pieces of bounded size first, so memory
does not follow the size of a batch; a single long text is one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 21

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Odd multiplier of the rolling polynomial and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


_VALUES = _byte_values()


class Powers:
    """Powers of the multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = _powers(_BASE, size)
            self.down = _powers(_INVERSE, size)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; a null is an empty text.

    ``offsets`` has one more entry than rows and starts at 0.  The bytes are a view.
    """
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=column.offset + n + 1)[column.offset :]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and words before each text (one more entry than texts).

    No word crosses from one text into the next.
    """
    n = len(data)
    inside = np.zeros(n + 1, dtype=bool)
    np.logical_not(_IS_SPACE[data], out=inside[:n])
    opens = inside[:n].copy()
    opens[1:] &= ~inside[: n - 1]
    cuts = offsets[:-1]
    cuts = cuts[cuts < n]
    opens[cuts] |= inside[cuts]
    starts = np.flatnonzero(opens)
    closes = inside[:n] & ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] |= inside[last]
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever the span lies."""
    n = len(data)
    powers.reach(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * powers.up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers.down[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words with A-Z lower-cased, and words before each text."""
    starts, ends, before = words(data, offsets)
    return span_hashes(LOWER[data], starts, ends, powers), before


def rows_of(before: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(before) - 1), np.diff(before))


def shingles(hashes: np.ndarray, before: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within a text, and shingles before each text.

    A text of fewer words is one shingle; one without words has none.
    """
    counts = np.diff(before)
    made = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out_before = np.concatenate([[0], np.cumsum(made)])
    if not len(hashes):
        return hashes[:0], out_before
    text = np.repeat(np.arange(len(counts)), made)
    first = before[:-1][text] + (np.arange(out_before[-1]) - out_before[text])
    short = counts[text] < k
    out = np.zeros(len(first), dtype=np.uint64)
    padded = np.concatenate([hashes, np.zeros(k, dtype=np.uint64)])
    factor = np.uint64(0x9FB21C651E98DF25)
    for j in range(k):
        part = padded[first + j]
        if short.any():
            part = np.where(short & (j >= counts[text]), np.uint64(j + 1), part)
        out = mix(out * factor + part)
    return out, out_before
