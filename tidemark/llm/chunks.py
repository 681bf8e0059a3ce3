"""Document fingerprints from content-defined chunks.

A gear hash over the last 16 bytes proposes cuts; one that is rarer below the
normal chunk size than above it keeps chunk sizes near normal. As cuts depend on
nearby bytes only, an edit changes the chunks around it and no others. A
fingerprint is the set of chunk digests, each with its chunk's length in the
lowest byte; likeness is the shared length over that of the shorter document.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.sharding import numbers, range_of
from tidemark.llm.wordhash import _power, mix

#: Chunk sizes in bytes; a length has to fit one byte.
LEAST, NORMAL, MOST = 16, 32, 128
#: Chance of a cut per byte, as bits, below and above the normal size.
HARD, EASY = 6, 4
_GEAR = np.random.default_rng(5).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TAG = np.random.default_rng(6).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPAN = 1 << 20


def _gear(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 16 bytes that end at each place, in four doublings."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8):
        more = h.copy()
        more[k:] += h[:-k] << np.uint64(k)
        h = more
    return h


def _cuts(n: int, hard: list[int], easy: list[int]) -> list[int]:
    """Ends of the chunks of ``n`` bytes, from the places where either hash test holds."""
    ends, start, at_hard, at_easy = [], 0, 0, 0
    while n - start > LEAST:
        at_hard = bisect_left(hard, start + LEAST - 1, at_hard)
        if at_hard < len(hard) and hard[at_hard] < start + NORMAL - 1:
            end = hard[at_hard] + 1
        else:
            at_easy = bisect_left(easy, start + NORMAL - 1, at_easy)
            end = easy[at_easy] + 1 if at_easy < len(easy) else n
            end = min(end, start + MOST, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def _of_bytes(data: np.ndarray) -> np.ndarray:
    """The fingerprint of one text's bytes, sorted; long texts are hashed span by span."""
    n = len(data)
    hard, easy = [], []
    for lo in range(0, n, SPAN):
        h = _gear(data[max(0, lo - 15) : lo + SPAN])[min(lo, 15) :]
        test = (h >> np.uint64(40)) & np.uint64(2**HARD - 1)
        easy += (np.flatnonzero((test & np.uint64(2**EASY - 1)) == 0) + lo).tolist()
        hard += (np.flatnonzero(test == 0) + lo).tolist()
    ends = np.array(_cuts(n, hard, easy), dtype=np.int64)
    starts = np.concatenate([np.zeros(1, dtype=np.int64), ends[:-1]])
    digests, first = [], 0
    while first < len(ends):
        last = int(np.searchsorted(ends, starts[first] + SPAN - MOST, side="right"))
        last = max(last, first + 1)
        base = starts[first]
        up, down = _power(SPAN + 1)
        total = np.zeros(int(ends[last - 1] - base) + 1, dtype=np.uint64)
        np.cumsum(_TAG[data[base : ends[last - 1]]] * up[: len(total) - 1], out=total[1:])
        digests.append(mix((total[ends[first:last] - base] - total[starts[first:last] - base]) * down[starts[first:last] - base]))
        first = last
    lengths = (ends - starts).astype(np.uint64)
    return np.unique((np.concatenate(digests) & ~np.uint64(0xFF)) | lengths)


def fingerprint(text: str) -> np.ndarray:
    """Sorted distinct chunk digests with lengths; no bytes give none."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return _of_bytes(data) if len(data) else np.zeros(0, dtype=np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared chunk length over that of the shorter document; 1 for two empty ones."""
    size_a, size_b = (int((x & np.uint64(0xFF)).sum()) for x in (a, b))
    if not size_a or not size_b:
        return float(size_a == size_b)
    shared = np.intersect1d(a, b, assume_unique=True)
    return int((shared & np.uint64(0xFF)).sum()) / min(size_a, size_b)


def edited(text: str, other: str) -> str:
    """The text with its last half replaced by the start of another."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


OUT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [c.split()[0] for c in OUT.split(", ")]


def _show(prints: np.ndarray) -> str:
    return prints.astype(">u8").tobytes().hex()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], NAMES)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``id, text, part, tail`` to one row per document, each compared with the next one of its part."""
    held, rows, size, last = None, [], 0, ("", fingerprint(""))
    for batch in batches:
        ids, texts, parts, tails = batch.columns
        for i in range(len(batch)):
            part, text = parts[i].as_py(), texts[i].as_py() or ""
            if held is not None and held[0] == part:
                own = held[2]
                mine = last[1] if last[0] is own else fingerprint(own)
                last = (text, fingerprint(text))
                new = edited(own, text)
                new_prints = mine if new == own else fingerprint(new)
                rows.append((held[1], len(own), hashlib.sha256(new.encode()).hexdigest(), _show(mine), _show(new_prints), likeness(mine, new_prints), likeness(mine, last[1])))
                size += len(own)
                held = None
            if not tails[i].as_py():
                held = (part, ids[i].as_py(), text)
            if size > SPAN:
                yield _batch(rows)
                rows, size = [], 0
    if rows:
        yield _batch(rows)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each text, of its edited text, and likenesses to that and to the next document.

    The next document is the one that follows by descending key (nulls last,
    equal keys by text, null text as empty); the first follows the last. Texts
    are dealt into ranges of the key and sorted there; the head of each range is
    also sent to the range before it, so no row needs a global order in one
    task. Null texts are empty, have the empty fingerprint and are like an empty
    text. One document is its own next one. Repeated rows each give a row; an
    empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = 4 * n
    quantiles = rows.select("id").filter("id is not null").select(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
    splits = sorted(set(quantiles or []))
    part = F.when(F.col("id").isNull(), len(splits) + 1).otherwise(F.lit(len(splits)) - range_of(F.col("id"), splits)).cast("int")
    heads = sorted((r.part, r.head) for r in rows.select("id", part.alias("part")).groupBy("part").agg(F.max("id").alias("head")).collect())
    if not heads:
        return rows.limit(0).mapInArrow(_with_next, OUT).withColumnRenamed("id", key)
    head, before = [0] * (len(splits) + 2), [0] * (len(splits) + 2)
    for i, (p, first) in enumerate(heads):
        head[p], before[p] = first or 0, heads[i - 1][0]
    at = F.col("part") + 1
    is_head = F.col("id").isNull() | (F.col("id") == F.element_at(numbers(head), at))
    own = F.struct(F.col("part"), F.lit(False).alias("tail"))
    copy = F.struct(F.element_at(numbers(before), at).cast("int").alias("part"), F.lit(True).alias("tail"))
    dealt = rows.withColumn("part", part).withColumn("place", F.explode(F.when(is_head, F.array(own, copy)).otherwise(F.array(own))))
    dealt = dealt.select("id", "text", "place.part", "place.tail").repartition(n, "part")
    ordered = dealt.sortWithinPartitions("part", "tail", F.col("id").desc_nulls_last(), "text")
    return ordered.mapInArrow(_with_next, OUT).withColumnRenamed("id", key)
