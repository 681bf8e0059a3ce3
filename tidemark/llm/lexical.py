"""Ranked lexical search of many items at once, with the work that items share done once.

An item's score of a document is a sum over its terms, so a set of terms that
several items have is summed once per document and the sum used by all of them.
The shared sets are mined from the items alone: terms that occur in the very same
items are one set; then, round after round, terms or sets that stand side by side
in several items, when each item is ordered by frequency, become a new set. What
comes out is a graph in which sets are made of terms and smaller sets, and items
of what is left to them. For a block of documents the sums of every term and set
that occurs in it are laid out as rows, level by level.

Documents are read twice: the first pass counts terms and keeps the items' terms
of each document, the second ranks. Only the best of each task are compared.
Items go in blocks of bounded size, so the graph that is sent to the tasks is
bounded too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.runs import lower_runs
from tidemark.session import written

#: Bytes of item texts whose terms are searched for in one pass; what is sent to the tasks grows with it alone.
BLOCK = 4 << 20
#: Numbers of the table of sums that a task lays out at a time.
CELLS = 1 << 22

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[0x80:] = True


def _term_bytes(data: np.ndarray) -> np.ndarray:
    return _WORD[data]


@dataclass
class Level:
    """New sets: their numbers and, one set after the other, what they are made of."""

    made: np.ndarray
    parts: np.ndarray
    starts: np.ndarray


@dataclass
class Sharing:
    """Levels of shared sets over the numbers of terms, and what each item is made of."""

    terms: int
    symbols: int
    items: int
    levels: list[Level] = field(default_factory=list)


def _level(made: np.ndarray, owner: np.ndarray, parts: np.ndarray) -> Level:
    """``owner`` ascends and has every number of ``made`` once or more."""
    return Level(made, parts, np.searchsorted(owner, made))


def mine(item: np.ndarray, term: np.ndarray, items: int, terms: int) -> Sharing:
    """The graph of shared sets of the distinct pairs ``(item, term)``, given by numbers from 0.

    The last level makes the items, whose numbers follow those of terms and sets.
    """
    order = np.lexsort((item, term))
    item, term = item[order].astype(np.int64), term[order].astype(np.int64)
    out, symbols = Sharing(terms, terms, items), terms
    # Terms of the same items: the list of a term's items, as bytes, names its set.
    edges = np.flatnonzero(np.diff(term, prepend=-1, append=terms))
    sets: dict[bytes, list[int]] = {}
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi - lo > 1:
            sets.setdefault(item[lo:hi].tobytes(), []).append(int(term[lo]))
    alike = [s for s in sets.values() if len(s) > 1]
    if alike:
        made = np.arange(symbols, symbols + len(alike))
        out.levels.append(_level(made, np.repeat(made, [len(s) for s in alike]), np.concatenate(alike)))
        name = np.arange(terms)
        name[out.levels[-1].parts] = np.repeat(made, [len(s) for s in alike])
        symbols += len(alike)
        item, term = np.divmod(np.unique(item * symbols + name[term]), symbols)
    while len(item):
        often = np.bincount(term, minlength=symbols)
        order = np.lexsort((term, -often[term], item))
        item, term = item[order], term[order]
        beside = item[1:] == item[:-1]
        pairs, which, n = np.unique(term[:-1] * symbols + term[1:], return_inverse=True, return_counts=True)
        n = np.bincount(which[beside], minlength=len(pairs))
        here = np.where(beside, n[which], 0)
        before, after = np.concatenate([[0], here[:-1]]), np.concatenate([here[1:], [0]])
        # Pairs overlap; one is taken where neither neighbour is more frequent, of equal ones the first.
        taken = (here > 1) & (here > before) & (here >= after)
        n = np.bincount(which[taken], minlength=len(pairs))
        taken &= n[which] > 1
        if not taken.any():
            break
        chosen = np.unique(which[taken])
        number = np.zeros(len(pairs), dtype=np.int64)
        number[chosen] = made = np.arange(symbols, symbols + len(chosen))
        out.levels.append(_level(made, np.repeat(made, 2), np.stack(np.divmod(pairs[chosen], symbols), 1).ravel()))
        symbols += len(chosen)
        at = np.flatnonzero(taken)
        term[at] = number[which[at]]
        item, term = np.delete(item, at + 1), np.delete(term, at + 1)
    order = np.argsort(item, kind="stable")
    item, term = item[order], term[order]
    made = np.unique(item)
    out.levels.append(Level(symbols + made, term, np.searchsorted(item, made)))
    out.symbols = symbols + items
    return out


def item_sums(sharing: Sharing, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the items with a term in these documents, and their sums; ``sums`` has a row per term, a column per document.

    Sets without a term in the documents are left out at every level.
    """
    table = np.zeros((sharing.symbols - sharing.items, sums.shape[1]), dtype=np.int64)
    table[: sharing.terms] = sums
    live = np.zeros(len(table), dtype=bool)
    live[: sharing.terms] = sums.any(axis=1)
    for level in sharing.levels[:-1]:
        made, found = _combined(level, table, live)
        table[made] = found
        live[made] = True
    made, found = _combined(sharing.levels[-1], table, live)
    return made - len(table), found


def _combined(level: Level, table: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    present = live[level.parts]
    sizes = np.add.reduceat(present.astype(np.int64), level.starts) if len(level.made) else np.zeros(0, dtype=np.int64)
    some = sizes > 0
    if not some.any():
        return level.made[:0], table[:0]
    starts = np.cumsum(sizes[some]) - sizes[some]
    return level.made[some], np.add.reduceat(table[level.parts[present]], starts, axis=0)


def _numbers(values: pa.Array, names: pa.Array) -> np.ndarray:
    """The place of each value among the names, -1 for others."""
    return np.asarray(pc.fill_null(pc.index_in(values.cast(pa.string()), value_set=names), -1))


def _kept_terms(names: pa.Array):
    """``key, text`` to ``key, n, terms, counts``: the number of terms, and those of the items with their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(len(batch), dtype=np.int64)
            held: list[tuple[np.ndarray, np.ndarray]] = []
            first = 0

            def rows(lo: int, hi: int):
                code, n = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, dtype=np.int64),) * 2
                code, place = np.unique(code, return_inverse=True)
                n = np.bincount(place, weights=n, minlength=len(code)).astype(np.int64)
                who, term = np.divmod(code, max(len(names), 1))
                ends = pa.array(np.searchsorted(who, np.arange(lo, hi + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (term.astype(np.int32), n)]
                return pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(total[lo:hi]), *lists], ["key", "n", "terms", "counts"])

            for owner, words, lo, hi in lower_runs(batch.column(1), _term_bytes):
                if lo != first:
                    yield rows(first, lo)
                    held, first = [], lo
                total[lo:hi] += np.bincount(owner - lo, minlength=hi - lo)
                term = _numbers(words, names)
                mine = term >= 0
                held.append(np.unique(owner[mine] * len(names) + term[mine], return_counts=True))
            if len(batch):
                yield rows(first, len(batch))

    return run


def _frequencies(terms: int):
    """Documents of each term in a task; their number and terms under -1 and -2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n, size = np.zeros(terms, dtype=np.int64), 0, 0
        for batch in batches:
            seen += np.bincount(batch.column(1).flatten().to_numpy(), minlength=terms)
            sizes = batch.column(0).to_numpy()
            n, size = n + int((sizes > 0).sum()), size + int(sizes.sum())
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([used, [-1, -2]]).astype(np.int64)), pa.array(np.concatenate([seen[used], [n, size]]))], ["term", "n"]
        )

    return run


def _ranked(sharing: Sharing, weight: np.ndarray, documents: int, size: int, most: int):
    """Kept terms to the best documents of each item in this task: ``item, score, key``."""
    order = [("item", "ascending"), ("score", "descending"), ("key", "ascending")]

    def best(found: pa.Table) -> pa.Table:
        found = found.take(pc.sort_indices(found, sort_keys=order, null_placement="at_start"))
        items = found["item"].to_numpy()
        return found.filter(pa.array(np.arange(len(items)) - np.searchsorted(items, items) < most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, least = None, np.ones(sharing.items, dtype=np.int64)
        step = max(CELLS // max(sharing.symbols, max(len(x.parts) for x in sharing.levels)), 1)
        for batch in batches:
            lists = batch.column(2)
            ends = np.asarray(lists.offsets).astype(np.int64)
            terms, counts = np.asarray(lists.flatten()), np.asarray(batch.column(3).flatten())
            ends -= ends[0]
            n = batch.column(1).to_numpy()
            usual = 10 + 90 * n * documents // max(size, 1)
            for lo in range(0, len(batch), step):
                hi = min(lo + step, len(batch))
                s = slice(ends[lo], ends[hi])
                if s.start == s.stop:
                    continue
                doc = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))
                tf = counts[s]
                sums = np.zeros((sharing.terms, hi - lo), dtype=np.int64)
                sums[terms[s], doc] = weight[terms[s]] * (1_000_000_000 * tf // (1000 * tf + 8 * usual[lo:hi][doc]))
                items, scores = item_sums(sharing, sums)
                floor = least[items]
                if hi - lo > most:
                    floor = np.maximum(floor, np.partition(scores, hi - lo - most, axis=1)[:, hi - lo - most])
                which, where = np.nonzero(scores >= floor[:, None])
                if not len(which):
                    continue
                new = pa.table({"item": items[which], "score": scores[which, where], "key": batch.column(0).take(pa.array(lo + where))})
                kept = best(new if kept is None else pa.concat_tables([kept, new]))
                found = kept["item"].to_numpy()
                edge = np.flatnonzero(np.diff(found, append=-1))
                full = np.bincount(found, minlength=sharing.items)[found[edge]] >= most
                least[found[edge[full]]] = kept["score"].to_numpy()[edge[full]]
        if kept is not None:
            yield from kept.combine_chunks().to_batches()

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for owner, words, _, _ in lower_runs(batch.column(1), _term_bytes):
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), words.cast(pa.string())], ["item", "term"])


def search(
    docs: DataFrame, items: DataFrame, most: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item, rank, key, score``: the ``most`` documents of highest score above 0 for each item.

    Equal scores go by ascending key, null first. Every row of ``docs`` is a
    document of its own, repeated rows too; rows of items with one key are one
    item, null is a key. Null and empty texts have no terms; an item without
    terms, or whose terms no document has, gives no rows, and so do empty tables.

    A term's weight w is floor(1000 ln((2N + 2) / (2 df + 1))), N the documents with
    a term, df those with this one. With m = 10 + 90 n N div L, where n is the
    document's number of terms and L that of all, a term that occurs tf times adds
    w ((10^9 tf) div (1000 tf + 8 m)), in 64-bit integers.
    """
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    items = items.select(F.col(f"`{item_key}`").alias("item"), F.col(f"`{item_text}`").alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(math.ceil(size / BLOCK), 1)
    out = None
    for block in range(blocks):
        found = _search_block(docs, items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block), most)
        out = found if out is None else out.unionByName(found)
    return out


def _weights(documents: int, seen: np.ndarray) -> np.ndarray:
    """Weight of each term, by the documents that have it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in seen.tolist()], dtype=np.int64)


def _search_block(docs: DataFrame, items: DataFrame, most: int) -> DataFrame:
    spark = docs.sparkSession
    kind = docs.schema["key"].dataType.simpleString()
    pairs = items.mapInArrow(_item_terms, f"item {items.schema['item'].dataType.simpleString()}, term string").distinct().toArrow()
    item, term = (pairs[c].combine_chunks() for c in ("item", "term"))
    names, coded = term.unique(), item.dictionary_encode(null_encoding="encode")
    keys, term = coded.dictionary, _numbers(term, names)
    sharing = mine(np.asarray(coded.indices), term, len(keys), len(names))

    kept = written(docs.mapInArrow(_kept_terms(names), f"key {kind}, n long, terms array<int>, counts array<long>"))
    counted = kept.select("n", "terms").mapInArrow(_frequencies(len(names)), "term long, n long")
    # One row for each term of the block.
    seen = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    documents, size = seen.pop(-1, 0), seen.pop(-2, 0)
    df = np.zeros(len(names), dtype=np.int64)
    df[list(seen)] = list(seen.values())
    ranked = kept.mapInArrow(_ranked(sharing, _weights(documents, df), documents, size, most), f"item long, score long, key {kind}")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("key"))).alias("rank")
    ranked = ranked.select("item", "score", "key", place).filter(F.col("rank") <= most)
    named = spark.createDataFrame(pa.table({"item": np.arange(len(keys)), "name": keys}), f"item long, name {items.schema['item'].dataType.simpleString()}")
    return ranked.join(F.broadcast(named), "item").select(F.col("name").alias("item"), "rank", "key", "score")
