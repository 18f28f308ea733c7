"""Words of Arrow text columns as 64-bit hashes, computed on the byte buffers without Python strings.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z read as a-z; on request, a run of
ASCII letters, digits and non-ASCII characters. A null text counts as an empty one. Columns are taken in blocks of whole rows of about `BLOCK` bytes; a longer row is hashed
in pieces cut at white space, so that memory does not grow with a text beyond its words' hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MARKS = np.ones(256, bool)  # all ASCII but letters and digits
_MARKS[128:] = _MARKS[48:58] = _MARKS[65:91] = _MARKS[97:123] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, np.uint64)[_LOWER]
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 2 * BLOCK)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _word_hashes(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray, stem: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (or of its first `stem` bytes), and the number of words up to each offset."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~gaps[data]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if stem:
        last = np.minimum(last, first + stem)
    up, down = _powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUES[data] * up, out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(first, offsets)


def _cut(data: np.ndarray, start: int, stop: int) -> int:
    """End of a piece of a long row: after the last white space within BLOCK, else before the next."""
    if stop - start <= BLOCK:
        return stop
    spaces = np.flatnonzero(_SPACE[data[start : start + BLOCK]])
    if len(spaces):
        return start + int(spaces[-1]) + 1
    at = start + BLOCK
    while at < stop:
        spaces = np.flatnonzero(_SPACE[data[at : at + BLOCK]])
        if len(spaces):
            return min(stop, at + int(spaces[0]) + 1)
        at += BLOCK
    return stop


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    return np.frombuffer(held, np.uint8) if held else np.empty(0, np.uint8), offsets


def hashed_words(
    column, marks_apart: bool = False, stem: int = 0
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bounds, hashes): the words of row `first + i` are hashes[bounds[i]:bounds[i + 1]]."""
    gaps = _MARKS if marks_apart else _SPACE
    data, offsets = buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        until = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        start, stop = int(offsets[row]), int(offsets[until])
        if until > row + 1 or stop - start <= BLOCK:
            hashes, bounds = _word_hashes(data[start:stop], offsets[row : until + 1] - start, gaps, stem)
        else:
            parts = []
            while start < stop:
                cut = _cut(data, start, stop)
                parts.append(_word_hashes(data[start:cut], np.array([0, cut - start]), gaps, stem)[0])
                start = cut
            hashes = np.concatenate(parts)
            bounds = np.array([0, len(hashes)])
        yield row, bounds, hashes
        row = until


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
