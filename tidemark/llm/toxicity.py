"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the document has a label. A sentence's
score is a logistic function of its words; a document is toxic if any sentence
is, so its score is the noisy-or of theirs: ``1 - prod(1 - p)``. Weights are fit
to document labels through that product, after which the sentence scores say
where the offence is.

Weights are fit on the driver to a sample of labelled documents whose number is
a parameter; everything is scored by all tasks with the weights, which are one
array of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark.llm.wordhash import PIECE, row_groups, string_parts, word_parts
from tidemark.session import written

#: Word weights: a word's slot is the first bits of its hash.
BITS = 18
#: Most labelled documents of either label to learn from.
SAMPLE = 4000
#: A word has a weight of its own if so many of the sampled documents have it.
LEAST_DOCUMENTS = 8
#: Gradient steps, their size, and the price of a weight in documents, which keeps words of a few documents at 0.
ROUNDS, RATE, SPARSE = 120, 0.6, 1.0
#: Words whose part of a gradient step is worked out together.
STEP_ITEMS = 1 << 20
#: Lengths in bytes of the beginnings of words that are terms too.
BEGINNINGS = (4, 5, 6, 7, 8)
_END = np.zeros(256, dtype=bool)
_END[[10, 33, 46, 63]] = True  # line feed ! . ?
_DROP = np.zeros(256, dtype=bool)
_DROP[list(b".,;:!?\"'()[]{}|")] = True


def _clean(data: np.ndarray) -> np.ndarray:
    """Punctuation at words counts as blank."""
    out = data.copy()
    out[_DROP[data]] = 32
    return out


def parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """Runs of rows ``lo, hi, bytes, offsets, first byte``; a very long row comes in several parts that end with a sentence."""
    for lo, hi in row_groups(offsets):
        start, end = offsets[lo], offsets[hi]
        while hi == lo + 1 and end - start > 2 * PIECE:
            ends = np.flatnonzero(_END[data[start + PIECE : start + 2 * PIECE]])
            cut = start + PIECE + (int(ends[0]) + 1 if len(ends) else PIECE)
            yield lo, hi, data[start:cut], np.array([0, cut - start]), int(start - offsets[lo])
            start = cut
        yield lo, hi, data[start:end], np.maximum(offsets[lo : hi + 1] - start, 0), int(start - offsets[lo])


def sentence_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs ``sentence << BITS | slot``; the row and the start byte of each sentence.

    Terms are words and their beginnings, so that inflected and compound forms
    count with their stem. Sentences end at a line feed, full stop, exclamation
    or question mark; those with a word are numbered from 0 on in order.
    """
    clean = data.copy()
    clean[_DROP[data]] = 32
    starts, hashes = word_parts(clean, offsets, BEGINNINGS)
    row = np.searchsorted(offsets, starts, side="right") - 1
    mark = np.cumsum(_END[data])[starts] if len(starts) else np.zeros(0, dtype=np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])
    sentence = np.cumsum(new) - 1
    slots = (hashes >> np.uint64(64 - BITS)).astype(np.int64) | (sentence << BITS)[:, None]
    return np.unique(slots[hashes != 0]), row[new], starts[new]


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text, label`` to ``label``, the words of each sentence once, and the words in each sentence."""
    for batch in batches:
        data, offsets = string_parts(batch.column(0))
        for lo, hi, part, ends, _ in parts(data, offsets):
            pairs, row, _ = sentence_terms(part, ends)
            counts = np.bincount(pairs >> BITS, minlength=len(row))
            cut = np.searchsorted(row, np.arange(hi - lo + 1))
            last = np.concatenate([[0], np.cumsum(counts)])
            items = pa.ListArray.from_arrays(pa.array(last[cut].astype(np.int32)), pa.array((pairs & (2**BITS - 1)).astype(np.int32)))
            sizes = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(counts.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(lo, hi - lo) for k in (1, 2)), items, sizes], ["key", "label", "items", "sizes"])


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``items`` to the number of bags of this task that have each slot."""
    seen = np.zeros(2**BITS, dtype=np.int64)
    for batch in batches:
        for items in batch.column(0):
            seen[np.unique(items.values.to_numpy())] += 1
    used = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(seen[used])], ["slot", "n"])


def _without_rare(kept: np.ndarray):
    """``key, label, items, sizes`` with the slots in ``kept`` only; every sentence stays, with fewer words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, sizes = batch.column(2), batch.column(3)
            slots, counts = items.flatten().to_numpy(), sizes.flatten().to_numpy()
            last = np.concatenate([[0], np.cumsum(kept[slots])])
            ends = np.concatenate([[0], np.cumsum(counts)])
            bags = np.concatenate([[0], np.cumsum(sizes.value_lengths().to_numpy())])
            left = pa.ListArray.from_arrays(pa.array(last[ends[bags]].astype(np.int32)), pa.array(slots[kept[slots]]))
            fewer = pa.ListArray.from_arrays(pa.array(bags.astype(np.int32)), pa.array(np.diff(last[ends]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), left, fewer], ["key", "label", "items", "sizes"])

    return run


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit(labels: np.ndarray, items: np.ndarray, sizes: np.ndarray, sentences: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Word weights and bias by gradient steps on the noisy-or likelihood.

    ``items``: words of all sentences in a row; ``sizes``: words per sentence;
    ``sentences``: sentences per document; ``weight``: of each document.
    """
    bags = np.concatenate([[0], np.cumsum(sentences)])
    last = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    seen, ends = np.zeros(2**BITS, dtype=np.int64), last[bags]
    for lo, hi in zip(ends[:-1], ends[1:], strict=True):
        seen[np.unique(items[lo:hi])] += 1
    kept = seen >= LEAST_DOCUMENTS
    names = np.flatnonzero(kept)
    use = kept[items]
    item = (np.cumsum(kept, dtype=np.int32) - 1)[items[use]]
    fewer = np.add.reduceat(np.append(use, False), last[:-1], dtype=np.int32) * (np.asarray(sizes) > 0) if len(sizes) else np.zeros(0, dtype=np.int32)
    last = np.concatenate([[0], np.cumsum(fewer, dtype=np.int64)])
    del use, items
    ends, runs = last[bags], [0]
    while runs[-1] < len(labels):
        runs.append(max(runs[-1] + 1, int(np.searchsorted(ends, ends[runs[-1]] + STEP_ITEMS, side="right")) - 1))
    w, b = np.zeros(len(names)), -np.log(max(1.0, len(sizes) / max(1, len(labels)))) - 2.0
    sum_w, sum_b = np.full(len(names), 1e-8), 1e-8
    total = weight.sum()
    for _ in range(ROUNDS):
        grad, grad_b = np.zeros(len(names)), 0.0
        for lo, hi in zip(runs[:-1], runs[1:], strict=True):
            mine = item[ends[lo] : ends[hi]]
            document = np.repeat(np.arange(hi - lo), sentences[lo:hi])
            sentence = np.repeat(np.arange(len(document)), fewer[bags[lo] : bags[hi]])
            z = np.bincount(sentence, weights=w[mine], minlength=len(document)) + b
            p = 1 / (1 + np.exp(-z))
            s = np.bincount(document, weights=_softplus(z), minlength=hi - lo)
            # d loss / d s: 1 for label 0, -(1 - P) / P for label 1, where 1 - P = exp(-s).
            slope = np.where(labels[lo:hi] > 0, -1 / np.expm1(np.maximum(s, 1e-9)), 1.0) * weight[lo:hi] / total
            back = slope[document] * p
            grad += np.bincount(mine, weights=back[sentence], minlength=len(names))
            grad_b += back.sum()
        sum_w += grad**2
        step = RATE / np.sqrt(sum_w)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * SPARSE / len(labels), 0)
        sum_b += grad_b**2
        b -= RATE * grad_b / np.sqrt(sum_b)
    out = np.zeros(2**BITS, dtype=np.float32)
    out[names] = w
    return out, float(b)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> dict:
    """Weights from up to ``sample`` documents of either label, drawn by a hash of the key.

    Labels other than 0 and 1, null keys and documents without a text are left
    out. Drawn documents stand for all of their label, so scores keep the true
    share. With one label only, or none, the model gives 0 for all, or 1 if
    every label is 1.
    """
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")).filter("key is not null and label in (0, 1)")
    known = known.groupBy("key").agg(F.max("label").alias("label"))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return {"weights": np.zeros(2**BITS, dtype=np.float32), "bias": 40.0 if 1 in counts else -40.0}
    drawn = [known.filter(F.col("label") == x).orderBy(F.xxhash64("key"), "key").limit(sample) for x in (0, 1)]
    # At most 2 x sample rows of two numbers.
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).filter("text is not null")
    rows = rows.join(F.broadcast(drawn[0].union(drawn[1])), "key").select("text", "key", "label")
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, label int, items array<int>, sizes array<int>"
    bags = written(rows.mapInArrow(_bags, schema))
    # Rare words get no weight, so they stay with the tasks.
    seen = bags.select("items").mapInArrow(_seen, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    kept = np.zeros(2**BITS, dtype=bool)
    kept[[r.slot for r in seen.filter(F.col("n") >= LEAST_DOCUMENTS).collect()]] = True
    bags = bags.mapInArrow(_without_rare(kept), schema).orderBy("key").toArrow()
    y = bags.column("label").to_numpy()
    items, sizes = (np.concatenate([np.zeros(0, dtype=np.int32), *(x.flatten().to_numpy() for x in bags.column(c).chunks)]) for c in ("items", "sizes"))
    sentences = np.concatenate([np.zeros(0, dtype=np.int32), *(x.value_lengths().to_numpy() for x in bags.column("sizes").chunks)])
    del bags
    size = np.bincount(y, minlength=2)
    if not size.all():
        return {"weights": np.zeros(2**BITS, dtype=np.float32), "bias": 40.0 if size[1] else -40.0}
    weight = np.array([counts[0] / size[0], counts[1] / size[1]])[y]
    weights, bias = fit(y, items, sizes, sentences, weight)
    return {"weights": weights, "bias": bias}


#: Rows of a batch that are looked at together.
SLICE = 1024


def _offending(row: np.ndarray, z: np.ndarray, start: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Places of the offending sentences, by row and likeliest first: those above one half, and in a row that is over
    one half without any, those that add most until they carry it there."""
    order = np.lexsort((start, -z, row))
    row, z = row[order], z[order]
    above = np.bincount(row, weights=z > 0, minlength=len(total)) > 0
    carried = (-np.expm1(-total) >= 0.5) & ~above
    added = np.concatenate([[0.0], np.cumsum(np.where(carried[row], _softplus(z), 0.0))])
    before = added[:-1] - added[np.searchsorted(row, row)]
    return order[(z > 0) | carried[row] & (-np.expm1(-before) < 0.5)]


def _scores(model: dict, place: int):
    """``row`` with a text as field ``place`` to the row with its score and the spans of its offending sentences."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("sentence", pa.string()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, SLICE) for whole in batches for start in range(0, len(whole), SLICE)):
            data, offsets = string_parts(batch.column(0).field(place))
            total, spans = np.zeros(len(batch)), [[] for _ in range(len(batch))]
            found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))]
            for lo, _, part, ends, base in parts(data, offsets):
                pairs, row, start = sentence_terms(part, ends)
                z = np.bincount(pairs >> BITS, weights=model["weights"][pairs & (2**BITS - 1)], minlength=len(row)) + model["bias"]
                if len(row):
                    total += np.bincount(row + lo, weights=_softplus(z), minlength=len(batch))
                    last = np.append(row[1:] != row[:-1], True)
                    end = np.where(last, ends[row + 1], np.append(start[1:], 0))
                    found.append((row + lo, start + base + offsets[lo], end + base + offsets[lo], z))
            row, start, end, z = (np.concatenate(x) for x in zip(*found, strict=True))
            for i in _offending(row, z, start, total).tolist():
                text = data[start[i] : end[i]].tobytes().decode("utf-8", "ignore").strip()
                spans[row[i]].append({"start": int(start[i] - offsets[row[i]]), "sentence": text, "p": float(1 / (1 + np.exp(-z[i])))})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(-np.expm1(-total)), pa.array(spans, kind)], ["row", "score", "spans"])

    return run


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``row`` (the row as a struct), ``score`` (0 to 1) and ``spans`` for every row.

    ``spans`` holds every offending sentence, likeliest first: first byte, text
    and probability. Those are the sentences of a score above one half; in a row
    of score one half or more without any, the likeliest ones whose own noisy-or
    comes to one half. A text that is null or has no word has score 0 and no
    span. Equal texts score alike.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = StructType([rows.schema["row"]]).add("score", "double")
    schema = schema.add("spans", ArrayType(StructType().add("start", "long").add("sentence", "string").add("p", "double")))
    return rows.mapInArrow(_scores(model, docs.columns.index(text)), schema)
