"""Token ids of many texts at once, by a vocabulary file that is given.

A byte-level vocabulary splits a text before it merges bytes, and some of these
splits can be told from two bytes alone: before a blank that a character other
than white space follows, around a lone line feed, and between an ASCII letter
and a full stop or comma. Texts are cut there, the distinct pieces of a batch are encoded
once, and the ids are laid out by taking those of each piece.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.wordhash import row_groups, string_parts

#: Bytes of text that are cut and laid out at a time (a longer text is a group of its own).
GROUP = 16 << 20

# First bytes of characters that no expression takes for white space, and ASCII characters of that kind.
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xF5] = True
_SOLID[[0xE1, 0xE2, 0xE3]] = False
_ASCII = np.zeros(256, dtype=bool)
_ASCII[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
# White space that the two libraries may tell differently.
_RARE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".,;:!?")] = True


def piece_starts(data: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each byte, by the bytes beside it."""
    n = len(data)
    first = np.zeros(n, dtype=bool)
    if n < 2:
        return first
    solid = _SOLID[data]
    first[:-1] |= (data[:-1] == 0x20) & solid[1:]
    first[1:] |= _LETTER[data[:-1]] & _STOP[data[1:]]
    feed = np.flatnonzero(data[1:-1] == 0x0A) + 1
    feed = feed[_ASCII[data[feed - 1]] & solid[feed + 1]]
    first[feed] = True
    first[feed + 1] = True
    return first


class Encoder:
    """Ids of texts by a vocabulary file of the tokenizers library.

    ``path`` is the file. Where the ranks of the same vocabulary lie beside it,
    pieces are encoded by the faster library that reads these.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.size = self.whole.get_vocab_size()
        self.kind = np.dtype(np.uint16 if self.size <= 1 << 16 else np.uint32)
        self.ranks = self._ranks(path)

    @staticmethod
    def _ranks(path: str):
        beside = path.removesuffix(".json") + ".tiktoken"
        if not os.path.exists(beside):
            return None
        import tiktoken
        from public_tokenizers import PATTERN

        with open(beside, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        """The ids of one short text as bytes of ``kind``."""
        known = self.ranks is not None and not _RARE.search(text)
        ids = self.ranks.encode_ordinary(text) if known else self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self.kind).tobytes()

    def _together(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of pieces without other white space than a blank in front, as lines of one text."""
        feed = self.ranks.encode_ordinary("\n")[0]
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), "\n")[0]
        ids = self.ranks.encode_to_numpy(lines.as_py() + "\n", disallowed_special=())
        ends = np.flatnonzero(ids == feed)
        return ids[ids != feed].astype(self.kind), np.diff(ends, prepend=-1) - 1

    def _pieces(self, distinct: pa.Array) -> pa.ListArray:
        """The ids of each distinct piece."""
        distinct = distinct.cast(pa.string())
        clean = np.zeros(len(distinct), dtype=bool)
        if self.ranks is not None:
            clean = np.asarray(pc.match_substring_regex(distinct, r"^ ?[!-~\p{L}\p{N}]+$"))
        odd = distinct.filter(pa.array(~clean)).to_pylist()
        if self.ranks is not None:
            found = [self.ranks.encode_ordinary(p) for p in odd]
        else:
            found = [e.ids for e in self.whole.encode_batch(odd, add_special_tokens=False)]
        ids, sizes = np.array([i for ids in found for i in ids], dtype=self.kind), np.array([len(f) for f in found], dtype=np.int64)
        if clean.any():
            more, lengths = self._together(distinct.filter(pa.array(clean)))
            ids, sizes = np.concatenate([more, ids]), np.concatenate([lengths, sizes])
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
        return lists.take(pa.array(np.argsort(np.concatenate([np.flatnonzero(clean), np.flatnonzero(~clean)]))))

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(first row, last row + 1, ids, ends)`` for runs of rows; ``ends`` are the places where rows begin and end.

        Null and empty texts have no ids.
        """
        data, offsets = string_parts(column)
        for lo, hi in row_groups(offsets, GROUP):
            part, edges = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            if len(part) > 2 * GROUP:
                # One long text; a piece begins in every stretch that has a blank before a word.
                found = [self._run(span, np.array([0, len(span)]))[0] for span in self._spans(part)]
                ids = np.concatenate(found)
                yield lo, hi, ids, np.array([0, len(ids)])
            else:
                yield lo, hi, *self._run(part, edges)

    @staticmethod
    def _spans(data: np.ndarray) -> Iterator[np.ndarray]:
        """Stretches of a long text that begin where pieces do."""
        at = 0
        while at < len(data):
            end = at + GROUP
            while end < len(data):
                first = np.flatnonzero(piece_starts(data[end - 1 : end + GROUP])[1:-1])
                if len(first):
                    end += int(first[0])
                    break
                end += GROUP - 2
            yield data[at : min(end, len(data))]
            at = end

    def _run(self, part: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of texts, and where each text's ids begin and end."""
        if not len(part):
            return np.zeros(0, dtype=self.kind), np.zeros(len(edges), dtype=np.int64)
        first = piece_starts(part)
        first[edges[:-1][edges[:-1] < len(part)]] = True
        starts = np.append(np.flatnonzero(first), len(part)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(part)])
        coded = pieces.dictionary_encode()
        lists = self._pieces(coded.dictionary).take(coded.indices)
        places = np.asarray(lists.offsets).astype(np.int64)
        return np.asarray(lists.flatten()), places[np.searchsorted(starts, edges)] - places[0]


_worker: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file, loaded once."""
    if path not in _worker:
        _worker.clear()
        _worker[path] = Encoder(path)
    return _worker[path]
