"""Vectorised word work on Arrow text columns: small numpy helpers for Python tasks.

Rows are handled in blocks of a tenth of a megabyte, so memory does not follow the batch or the table.
All arithmetic is on unsigned 64-bit integers and wraps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 100_000
_U = np.uint64
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A random 64-bit value for each byte, and an odd base whose powers place the bytes of a word.
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0 to n, and their inverses; kept for the next block."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        inverse = pow(_BASE, -1, 2**64)
        up, down = np.full(size, _U(_BASE)), np.full(size, _U(inverse))
        up[0] = down[0] = _U(1)
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets into them) for blocks of rows; null reads as empty."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


#: White space and ASCII marks, for callers that want letters and digits only.
MARKS = _SPACES.copy()
MARKS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; words never cross rows."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    word = ~separators[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes, A-Z lower-cased first if wanted."""
    up, down = _base_powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, ascending, and the row bounds in that array.

    A row with fewer words than the width has its whole word sequence as its one shingle; a row without words has none.
    """
    rows_n = len(offsets) - 1
    starts, ends, rows = word_bounds(data, offsets)
    w = word_hashes(data, starts, ends)
    at = np.searchsorted(rows, np.arange(rows_n + 1))
    count = np.diff(at)
    fold = np.zeros(max(0, len(w) - width + 1), np.uint64)
    for k in range(width):
        fold = fold * _U(_BASE) + w[k : k + len(fold)]
    inside = rows[: len(fold)] == rows[width - 1 :] if len(fold) else np.zeros(0, bool)
    out, row = mix(fold[inside]), rows[: len(fold)][inside]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for i, r in enumerate(short):
            value = _U(0)
            for x in w[at[r] : at[r + 1]]:
                value = _U((int(value) * _BASE + int(x)) % 2**64)
            extra[i] = value + _U(count[r])
        out, row = np.concatenate([out, mix(extra)]), np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        out, row = out[order], row[order]
    bounds = np.searchsorted(row, np.arange(rows_n + 1))
    for r in np.flatnonzero(np.diff(bounds) > 1):
        out[bounds[r] : bounds[r + 1]].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    out, row = out[keep], row[keep]
    return out, np.searchsorted(row, np.arange(rows_n + 1))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span; equal runs of values hash alike wherever they stand."""
    up, down = _base_powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values ^ _U(salt)) * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
