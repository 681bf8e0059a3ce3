"""Runs of word bytes in many texts at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.wordhash import row_groups, string_parts

#: Bytes of text that are looked at together.
GROUP = 8 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _cuts(word: Callable[[np.ndarray], np.ndarray], data: np.ndarray) -> Iterator[np.ndarray]:
    """Stretches of a long text that begin outside of a run (or with one)."""
    at = 0
    while at < len(data):
        end = at + GROUP
        while end < len(data):
            # The stretch starts two bytes early, so that no byte of a character is taken for one of its own.
            gaps = np.flatnonzero(~word(data[end - 2 : end + GROUP])[2:])
            if len(gaps):
                end += int(gaps[0])
                break
            end += GROUP
        yield data[at : min(end, len(data))]
        at = end


def lower_runs(column: pa.Array, word: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, pa.Array, int, int]]:
    """``(row of each run, runs, first row, last row + 1)`` for groups of rows; A-Z are lower-cased.

    ``word`` tells which bytes belong to a run. Null and empty texts have none. A
    text longer than a group comes in several groups.
    """
    data, offsets = string_parts(column)
    for lo, hi in row_groups(offsets, GROUP):
        part, edges = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        if len(part) > 2 * GROUP:
            for span in _cuts(word, part):
                yield *_runs(span, np.array([0, len(span)]), word, lo), lo, hi
        else:
            yield *_runs(part, edges, word, lo), lo, hi


def _runs(part: np.ndarray, edges: np.ndarray, word: Callable[[np.ndarray], np.ndarray], row: int) -> tuple[np.ndarray, pa.Array]:
    inside = word(part)
    edge = np.zeros(len(part) + 1, dtype=bool)
    edge[edges] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    # Only bytes of runs are kept, so a run ends where the next one begins.
    kept = _LOWER[part[inside]]
    before = np.cumsum(inside)
    ends = np.append(before[starts] - 1, len(kept)).astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    return row + np.searchsorted(edges, starts, side="right") - 1, runs
