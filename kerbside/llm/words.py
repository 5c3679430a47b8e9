"""Words and word shingles of whole text columns, as numpy arrays over Arrow's UTF-8 bytes.

A text is worked on whole, never cut; a slice is as many whole texts as fit some bytes.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Odd multipliers of the hashes.
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


@dataclass
class Text:
    """Rows ``first`` to ``first + len(ends) - 1`` of a column: their bytes, end to end."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.ends)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Text]:
    """The rows of a string column in slices of about ``limit`` bytes; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        at = offsets[row : end + 1] - offsets[row]
        yield Text(row, data[offsets[row] : offsets[end]], at[:-1], at[1:])
        row = end
    # What a batch has left free goes back to the system: workers live on between stages.
    pa.default_memory_pool().release_unused()


@dataclass
class Words:
    """The words of a slice in order: row within the slice, first byte, end, and hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from one running sum over the bytes."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start])


def words_of(text: Text, lower: bool = True, is_space: np.ndarray = _SPACE) -> Words:
    """Words between white space; A-Z lower-cased for the hash."""
    data = _LOWER[text.data] if lower else text.data
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~is_space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[text.starts] = True
    edge[text.ends] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    row = np.searchsorted(text.ends, start, "right")
    return Words(row, start, end, hash_spans(data, start, end))


@dataclass
class Shingles:
    """All shingles of a slice, by row; ``starts[i]`` is the first of the i-th row that has any."""

    rows: np.ndarray
    starts: np.ndarray
    hash: np.ndarray

    def ends(self) -> np.ndarray:
        return np.append(self.starts[1:], len(self.hash))


def shingles_of(words: Words, width: int = 5) -> Shingles:
    """Runs of ``width`` words; a row with fewer words gives all of them as one shingle."""
    count = len(words.row)
    if count == 0:
        return Shingles(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    rows, first, held = np.unique(words.row, return_index=True, return_counts=True)
    full = max(count - width + 1, 0)
    run = np.zeros(full, np.uint64)
    for step in range(width):
        run = run * _STEP + words.hash[step : step + full]
    inside = words.row[:full] == words.row[width - 1 :] if full else np.zeros(0, bool)
    at, run = np.flatnonzero(inside), run[inside]
    for i in np.flatnonzero(held < width):
        whole = np.full(1, held[i], np.uint64)
        for value in words.hash[first[i] : first[i] + held[i]]:
            whole = whole * _STEP + value
        at, run = np.append(at, first[i]), np.append(run, whole)
    order = np.argsort(at, kind="stable")
    at, run = at[order], run[order]
    return Shingles(rows, np.searchsorted(words.row[at], rows), mix(run))
