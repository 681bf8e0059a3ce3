"""Packing by lexical retrieval: each window is filled with the documents most like the one it begins with.

Documents are tokenised where they lie and stored as tokens; every split of that
table is a shard with an inverted index of its own. It is read block by block,
so the index stays small; its BM25 weights use the document frequencies and mean
length of the whole corpus. The document at the start of a window is its seed, and
the seed's unused neighbours follow by score until the window is full. The tokens
are laid end to end in this order and cut into windows, so only the end of a shard
is padded; a document that is cut opens the next window as its seed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.llm.tokens import encoder
from tidemark.session import written

WINDOW = 1024
END = 0
#: Documents or tokens of one block of a shard, whichever comes first (a longer document is a block of its own).
BLOCK_DOCS, BLOCK_TOKENS = 1024, 1 << 20
#: Terms in more than this share of a block's documents are multiplied as one matrix.
FREQUENT = 1 / 8
K1, B = 1.2, 0.75


def _tokenised(path: str):
    """``key, text`` to ``key, ids``: two bytes per token, the end token last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        if tokens.kind != np.uint16:
            raise ValueError("ids are kept in two bytes; the vocabulary has more than 65,536")
        for batch in batches:
            for lo, hi, ids, ends in tokens.encode(batch.column(1)):
                # The end id goes in at the end of every row; a row's ids so begin one later for each row before it.
                edges = ((ends + np.arange(len(ends))) * 2).astype(np.int32)
                whole = np.insert(ids, ends[1:], np.uint16(END))
                rows = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(edges), pa.py_buffer(whole)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), rows], ["key", "ids"])

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per id, their number and their tokens (under ids -1 and -2) in this task."""
    seen, n, size = np.zeros(1 << 16, dtype=np.int64), 0, 0
    for batch in batches:
        for ids in batch.column(0):
            terms = np.frombuffer(ids.as_buffer(), dtype=np.uint16)[:-1]
            seen[np.unique(terms)] += 1
            n, size = n + 1, size + len(terms)
    used = np.flatnonzero(seen)
    terms = np.concatenate([used, [-1, -2]]).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(np.concatenate([seen[used], [n, size]]))], ["term", "n"])


class Index:
    """BM25 weights of a block's documents by term, and the order that retrieval gives."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, usual: float):
        pairs = [np.unique(d, return_counts=True) for d in docs]
        lengths = np.array([max(len(d), 1) for d in docs])
        kinds = np.array([len(t) for t, _ in pairs])
        terms = np.concatenate([t for t, _ in pairs]).astype(np.int64)
        counts = np.concatenate([c for _, c in pairs]).astype(np.float64)
        owner = np.repeat(np.arange(len(docs)), kinds)
        weight = idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[owner] / usual))
        self.ends = np.concatenate([[0], np.cumsum(kinds)])
        frequent = np.bincount(terms, minlength=len(idf)) > FREQUENT * len(docs)
        often = frequent[terms]
        place = (np.cumsum(frequent) - 1)[terms[often]]
        table = np.zeros((int(frequent.sum()), len(docs)))
        table[place, owner[often]] = weight[often]
        self.base = (table > 0).T.astype(np.float64) @ table
        self.terms, self.often = terms, often
        terms, weight, owner = terms[~often], weight[~often], owner[~often]
        order = np.argsort(terms, kind="stable")
        self.owner, self.by_term = owner[order], weight[order]
        self.first = np.searchsorted(terms[order], np.arange(len(idf) + 1))

    def scores(self, doc: int) -> np.ndarray:
        """Score of every document for all terms of one."""
        lo, hi = self.ends[doc], self.ends[doc + 1]
        spans = [slice(self.first[t], self.first[t + 1]) for t in self.terms[lo:hi][~self.often[lo:hi]]]
        if not spans:
            return self.base[doc].copy()
        owner, weight = np.concatenate([self.owner[s] for s in spans]), np.concatenate([self.by_term[s] for s in spans])
        return self.base[doc] + np.bincount(owner, weights=weight, minlength=len(self.base))


def retrieval_order(docs: list[np.ndarray], idf: np.ndarray, usual: float, window: int = WINDOW, filled: int = 0) -> list[int]:
    """All documents in the order in which they fill windows.

    A window's seed is the document at its start: the one whose end runs over from
    the window before, or else the first unused. Its unused neighbours follow by
    score, equal ones in table order, until the window is full; where they do not
    suffice, the first unused document goes on as another seed. ``filled`` is what
    the first window holds already; documents are counted with their end token.
    """
    index, unused, order, first = Index(docs, idf, usual), np.ones(len(docs), dtype=bool), [], 0

    def place(doc: int) -> bool:
        """Lay a document down; tells whether a window was filled by it."""
        nonlocal filled
        order.append(doc)
        unused[doc] = False
        before, filled = filled // window, filled + len(docs[doc]) + 1
        return filled // window > before

    seed = None
    while len(order) < len(docs):
        if seed is None:
            while not unused[first]:
                first += 1
            seed = first
            if place(seed):
                seed = seed if filled % window else None
                continue
        scores = index.scores(seed) * unused
        ranked = np.flatnonzero(scores > 0)
        ranked = ranked[np.argsort(-scores[ranked], kind="stable")]
        last, seed = seed, None
        for doc in ranked.tolist():
            if place(doc):
                # What runs over opens the next window.
                seed = doc if filled % window else None
                break
        if seed == last:
            seed = None
    return order


PIECES = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _packed(idf: np.ndarray, usual: float, window: int):
    """Tokenised documents of a shard to their pieces, in the order of the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, filled = TaskContext.get().partitionId() << 32, 0

        def block(keys: list[pa.Array], docs: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal filled
            rows, who = [], []
            for d in retrieval_order([x[:-1] for x in docs], idf, usual, window, filled):
                ids, start = docs[d].astype("<u4"), 0
                while start < len(ids):
                    room = window - filled % window
                    n = min(room, len(ids) - start)
                    rows.append((start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), base + filled // window, filled % window))
                    who.append(d)
                    filled += n
                    start += n
            columns = [pa.array(np.array(c, dtype=np.int64)) for c in zip(*rows, strict=True)]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(keys).take(pa.array(who)), *columns], ["key", *PIECES])

        keys, docs, size = [], [], 0
        for batch in batches:
            lo = 0
            for i, ids in enumerate(batch.column(1)):
                docs.append(np.frombuffer(ids.as_py(), dtype=np.uint16))
                size += len(docs[-1])
                if len(docs) >= BLOCK_DOCS or size >= BLOCK_TOKENS:
                    yield block([*keys, batch.column(0).slice(lo, i + 1 - lo)], docs)
                    keys, docs, size, lo = [], [], 0, i + 1
            if lo < len(batch):
                keys.append(batch.column(0).slice(lo))
        if docs:
            yield block(keys, docs)

    return run


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for every piece of every document.

    A document is its ids (null text: none) and the end id. Its pieces cover it
    once; a sequence is full but for the last one of a shard. Repeated rows are
    packed like others; null keys stay null; an empty table gives no pieces.
    ``tokenizer`` is the path of the vocabulary file.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = StructType([rows.schema["key"]]).add("ids", "binary")
    tokens = written(rows.mapInArrow(_tokenised(tokenizer), schema))
    counts = {r.term: r.n for r in tokens.select("ids").mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    # One number per id of the vocabulary, which is at most 65,536.
    n, size = counts.pop(-1, 0), counts.pop(-2, 0)
    seen = np.zeros(1 << 16)
    seen[list(counts)] = list(counts.values())
    idf = np.log1p((n - seen + 0.5) / (seen + 0.5))
    out = StructType([rows.schema["key"]])
    for name in PIECES:
        out = out.add(name, "long")
    return tokens.mapInArrow(_packed(idf, max(size / max(n, 1), 1.0), window), out).withColumnRenamed("key", key)
