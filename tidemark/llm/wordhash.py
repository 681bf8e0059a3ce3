"""64-bit hashes of the words of many texts at once, on the bytes of Arrow columns.

A word's hash is a polynomial in its bytes modulo 2^64, taken from running sums,
then mixed. Texts are handled in pieces of about a megabyte, so neither many nor
very long texts need more memory than a few pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole number."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from 0 on."""
    if not _powers or len(_powers["up"]) < n:
        n = max(n, PIECE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            step = np.full(n, base, dtype=np.uint64)
            step[0] = 1
            _powers[name] = np.multiply.accumulate(step)
    return _powers["up"], _powers["down"]


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    ends = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def row_groups(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of rows of up to ``limit`` bytes; a longer row is a run of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def _piece_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word; no word spans a break (a position in the bytes)."""
    n = len(data)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[breaks] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * up[:n], out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), starts


def word_parts(data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word, and a row per word: hashes of the word and of its first so many bytes (0 where not longer)."""
    n = len(data)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * up[:n], out=total[1:])
    out = np.zeros((len(starts), 1 + len(sizes)), dtype=np.uint64)
    base, back = total[starts], down[starts]
    out[:, 0] = mix((total[ends] - base) * back + (ends - starts).astype(np.uint64))
    for j, k in enumerate(sizes):
        longer = np.flatnonzero(ends - starts > k)
        out[longer, j + 1] = mix((total[starts[longer] + k] - base[longer]) * back[longer] + np.uint64(k << 32))
    return starts, out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a run of rows, and where each row's words begin and end.

    Words are runs of bytes other than the six ASCII blanks; A-Z count as a-z.
    """
    if len(data) <= 2 * PIECE or len(offsets) > 2:
        hashes, starts = _piece_words(data, offsets[:-1][offsets[:-1] < len(data)])
        return hashes, np.searchsorted(starts, offsets)
    parts, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data):
            blank = np.flatnonzero(_SPACE[data[end : end + PIECE]])
            end = min(end + (int(blank[0]) if len(blank) else PIECE), len(data))
            if len(blank):
                break
        parts.append(_piece_words(data[at:end], np.zeros(1, dtype=np.int64))[0])
        at = end
    hashes = np.concatenate(parts)
    return hashes, np.array([0, len(hashes)])


_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; fewer words are one run, none give none."""
    n = len(hashes)
    size = min(n, width)
    if not size:
        return hashes
    total = np.full(n - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total += hashes[i : n - size + 1 + i] * _PLACE[i]
    return np.unique(mix(total))


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order."""
    data, offsets = string_parts(column)
    for lo, hi in row_groups(offsets):
        hashes, ends = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield shingles(hashes[a:b], width)
