"""Near-duplicate documents by HyperMinHash.

Each document keeps one 16-bit register per bucket: the leading zeros of the
lowest hash in the bucket and ten bits after its leading one. Registers are
banded; documents that agree on a band are candidates. Candidates are estimated
from their registers, less the agreements that chance explains, and those near
enough are verified on their full shingle sets.

Documents with one set are one class, represented by its smallest id, before
anything is compared. Buckets never yield all their pairs: each member is tried
with the first of its buckets and with the one before it, of these with the two
that it shares most bands with. Where a bucket then still falls into several
components, its members are compared across these inside the task, registers
first and sets next, block by block, and only links come out. So every pair that
shares a band is in one component, or estimated below ``ESTIMATE``, or verified
not to be linked. With 42 bands of 6 registers a pair of Jaccard similarity 0.8
shares none with a chance of 3e-6; the estimate's standard error there is 0.025,
and the cut at 0.7 is four of them below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.components import connected_components, joined_components
from tidemark.llm.wordhash import mix, shingle_sets
from tidemark.session import written

REGISTERS, MANTISSA = 256, 10
BANDS, ROWS = 42, 6
ESTIMATE = 0.7
#: Sets of up to this many shingles fill each bucket by a hash of its own, larger ones split one hash among the buckets.
SMALL = 512
#: A bucket of more members is compared in pairs of blocks of about this many.
BLOCK = 512
_RANDOM = np.random.default_rng(99)
_SCALE = _RANDOM.integers(1, 2**63, REGISTERS, dtype=np.uint64) | np.uint64(1)
_SHIFT = _RANDOM.integers(1, 2**63, REGISTERS, dtype=np.uint64)
_BAND = _RANDOM.integers(1, 2**63, (2, BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_STARTS = (np.arange(REGISTERS, dtype=np.uint64) << np.uint64(56)).astype(np.uint64)


def compress(lowest: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa bits of each number, plus one; 0 is left for empty buckets."""
    exact = (lowest >> np.uint64(11)).astype(np.float64)
    zeros = np.where(exact > 0, 53 - np.frexp(exact)[1], 53).astype(np.uint64)
    bits = (lowest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) + bits + np.uint64(1)).astype(np.uint16)


def small_registers(items: np.ndarray) -> np.ndarray:
    """Registers with a hash function for each bucket."""
    return compress((items[:, None] * _SCALE + _SHIFT).min(axis=0))


def large_registers(items: np.ndarray) -> np.ndarray:
    """Registers with the hash's first byte as bucket; items ascend, so a bucket's first is its lowest."""
    first = np.searchsorted(items, _STARTS)
    full = first < np.append(first[1:], len(items))
    out = np.zeros(REGISTERS, dtype=np.uint16)
    out[full] = compress(items[first[full]] << np.uint64(8))
    return out


def band_keys(registers: np.ndarray, scheme: int) -> np.ndarray:
    """A key per band, its number in the first byte; bands of empty buckets alone have none."""
    rows = registers[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    number = np.arange(BANDS, dtype=np.uint64) + np.uint64(BANDS * scheme)
    keys = (number << np.uint64(56)) | (mix((rows * _BAND[scheme]).sum(axis=1)) >> np.uint64(8))
    return keys[rows.any(axis=1)]


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of register rows, less chance agreements.

    Two different lowest hashes of sets of n and m agree in a register with a
    chance near ``2^-bits / (2 ln 2) * n m / (n + m)^2``, the mean width of a
    register's interval under both densities.
    """
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    n_a, n_b = n_a.astype(np.float64), n_b.astype(np.float64)
    chance = used * 2.0**-MANTISSA / (2 * np.log(2)) * n_a * n_b / np.maximum(n_a + n_b, 1) ** 2
    return np.maximum(same - chance, 0) / np.maximum(used - chance, 1)


FEATURES = "id long, n_shingles long, d1 long, d2 long, small binary, large binary, bands array<long>"


def signatures(width: int):
    """Arrow batches of ``id, text`` to rows of ``FEATURES``; digests identify the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d1, d2, small, large, bands = [], [], [], [], [], []
            for items in shingle_sets(batch.column(1), width):
                n.append(len(items))
                d1.append(_digest(items))
                d2.append(_digest(items ^ np.uint64(0x5BD1E995)))
                s = small_registers(items) if 0 < len(items) <= SMALL * 5 // 4 else None
                b = large_registers(items) if len(items) >= SMALL * 4 // 5 else None
                small.append(None if s is None else s.tobytes())
                large.append(None if b is None else b.tobytes())
                keys = [band_keys(r, k) for k, r in enumerate((s, b)) if r is not None]
                bands.append(np.concatenate(keys).view(np.int64) if keys else np.zeros(0, dtype=np.int64))
            ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            flat = np.concatenate(bands) if bands else np.zeros(0, dtype=np.int64)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(small, pa.binary()), pa.array(large, pa.binary())]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*columns, lists], ["id", "n_shingles", "d1", "d2", "small", "large", "bands"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    """Registers of a binary column as rows; null rows are empty."""
    empty = bytes(2 * REGISTERS)
    return np.frombuffer(b"".join(x if x is not None else empty for x in column.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose estimate reaches the cut."""
    for batch in batches:
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        best = np.zeros(len(batch))
        for kind in ("small", "large"):
            both = np.flatnonzero(~np.asarray(col[f"a_{kind}"].is_null()) & ~np.asarray(col[f"b_{kind}"].is_null()))
            pick = pa.array(both)
            if len(both):
                a, b = (_matrix(col[f"{s}_{kind}"].take(pick)) for s in "ab")
                n_a, n_b = (np.asarray(col[f"{s}_n"].take(pick)) for s in "ab")
                best[both] = np.maximum(best[both], estimate(a, b, n_a, n_b))
        pick = pa.array(np.flatnonzero(best >= ESTIMATE))
        yield pa.RecordBatch.from_arrays([col["a"].take(pick), col["b"].take(pick)], ["a", "b"])


def _digest(items: np.ndarray) -> int:
    return int(mix(items).sum(dtype=np.uint64).astype(np.int64)) if len(items) else 0


def _sets(width: int):
    """Arrow batches of ``id, text`` to ``id, d1, items``: the sorted shingle set as bytes, a few at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, items, held, lo = batch.column(0), [], [], 0, 0
            made = lambda: pa.RecordBatch.from_arrays(
                [ids.slice(lo, len(items)), pa.array(digests, pa.int64()), pa.array(items, pa.binary())], ["id", "d1", "items"]
            )
            for s in shingle_sets(batch.column(1), width):
                items.append(s.tobytes())
                digests.append(_digest(s))
                held += len(items[-1])
                if held > 8 << 20:
                    yield made()
                    lo, items, digests, held = lo + len(items), [], [], 0
            yield made()

    return run


def _linked(x: pa.Scalar, y: pa.Scalar, percent: int) -> bool:
    """Whether two sorted sets have enough in common."""
    x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verified(percent: int):
    """Pairs with both sets to those that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([_linked(x, y, percent) for x, y in zip(batch.column(2), batch.column(3), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["a", "b"])

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the pairs that are linked on their full shingle sets (``id, items``); a set moves once per pair it is in."""
    side = lambda s: sets.select(F.col("id").alias(s), F.col("items").alias(f"{s}_items")).hint("merge")
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_items", "b_items")
    return both.mapInArrow(_verified(percent), "a long, b long").distinct()


def estimated(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs whose registers look similar enough to be verified."""
    side = lambda s: known.select(
        F.col("id").alias(s), F.col("n_shingles").alias(f"{s}_n"), F.col("small").alias(f"{s}_small"), F.col("large").alias(f"{s}_large")
    )
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_near, "a long, b long").distinct()


def _first_shared(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Number of the first band that each row of registers shares with ``x``, or ``2 * BANDS``."""
    mine = x[: BANDS * ROWS].reshape(BANDS, ROWS)
    same = (rows[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS) == mine).all(axis=2) & mine.any(axis=1)
    return np.where(same.any(axis=1), same.argmax(axis=1), 2 * BANDS)


def _across(percent: int):
    """Rows of each pair of blocks of a bucket, in order, to links between components, as many as join them.

    Members of different components are estimated, in the first bucket that they
    share, and verified on their sets; components that a link has joined are one
    from then on.
    """

    def links(rows: list[pa.RecordBatch]) -> list[tuple[int, int]]:
        t = pa.Table.from_batches(rows).combine_chunks()
        ids, comp, block, n = (t.column(k).to_numpy() for k in ("id", "component", "block", "n_shingles"))
        one, bucket = t.column("i")[0].as_py() == t.column("j")[0].as_py(), t.column("band")[0].as_py() >> 56
        names, comp, counts = np.unique(comp, return_inverse=True, return_counts=True)
        joined = list(range(len(names)))

        def root(c: int) -> int:
            while joined[c] != c:
                joined[c] = joined[joined[c]]
                c = joined[c]
            return c

        kinds = [(np.asarray(t.column(k).is_valid()), _matrix(t.column(k)), k == "large") for k in ("small", "large")]
        items, out = t.column("items").combine_chunks(), []
        largest = counts.argmax()
        # A pair across components has a side outside the largest of them.
        for x in np.flatnonzero(comp != largest).tolist():
            other = (comp != comp[x]) & ((comp == largest) | (np.arange(len(ids)) > x))
            if not one:
                other &= block != block[x]
            at = np.flatnonzero(other)
            likely, first = np.zeros(len(at)), np.full(len(at), 2 * BANDS)
            for valid, matrix, large in kinds:
                if valid[x]:
                    use = np.flatnonzero(valid[at])
                    likely[use] = np.maximum(likely[use], estimate(matrix[at[use]], matrix[x : x + 1], n[at[use]], n[x : x + 1]))
                    use = use[likely[use] >= ESTIMATE]
                    shared = _first_shared(matrix[x], matrix[at[use]])
                    first[use] = np.minimum(first[use], np.where(shared < BANDS, shared + BANDS * large, 2 * BANDS))
            keep = (likely >= ESTIMATE) & (first == bucket)
            for y in at[keep][np.argsort(-likely[keep], kind="stable")].tolist():
                if root(comp[x]) != root(comp[y]) and _linked(items[x], items[y], percent):
                    joined[root(comp[x])] = root(comp[y])
                    out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        return out

    def made(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        pairs = np.array(links(rows), dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in ("band", "i", "j")), strict=True))
            lo = 0
            for hi in range(1, len(keys) + 1):
                if hi == len(keys) or keys[hi] != keys[lo]:
                    if keys[lo] != key:
                        if held:
                            yield made(held)
                        held, key = [], keys[lo]
                    held.append(batch.slice(lo, hi - lo))
                    lo = hi
        if held:
            yield made(held)

    return run


def links_across(members: DataFrame, components: DataFrame, known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components, from every bucket that still holds more than one.

    Of buckets with the same members only the first is looked at. A bucket of
    more than ``BLOCK`` members is compared in pairs of blocks.
    """
    placed = members.join(components, F.col("id") == F.col("node"), "left").select("band", "id", F.coalesce("component", "id").alias("component"))
    same = [F.count("*").alias("n"), F.sum(F.xxhash64("id") % 2**40).alias("h1"), F.sum(F.xxhash64("id", F.lit(1)) % 2**40).alias("h2")]
    buckets = placed.groupBy("band").agg(*same, F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    buckets = buckets.groupBy("n", "h1", "h2").agg(F.min("band").alias("band")).select("band", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    rows = placed.join(buckets, "band").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "component", "block")
    full = known.join(sets, "id").select("id", "n_shingles", "small", "large", "items").hint("merge")
    full = rows.join(full, "id").select("band", "i", "j", "id", "component", "block", "n_shingles", "small", "large", "items")
    parts = int(full.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    full = full.repartition(parts, "band", "i", "j").sortWithinPartitions("band", "i", "j", "id")
    return full.mapInArrow(_across(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row.

    Documents whose sets of ``width``-word shingles have at least ``percent``
    percent in common are linked; a component is named by its smallest key and
    keeps that document. Texts that are null or have no word have empty sets and
    link with nothing; texts of fewer words than ``width`` are one shingle. Rows
    with equal texts fall together. Rows of one key are one document, compared by
    one of its texts if they differ, and are kept or not together. A null key gets a null component unless its text has another
    key, and is never kept. An empty table gives an empty result. Only the two
    columns named are read, so others may have any name.
    """
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    features = written(texts.mapInArrow(signatures(width), FEATURES))
    classes = written(features.filter("n_shingles > 0").groupBy("d1", "d2").agg(F.min("id").alias("first")))
    chosen = classes.filter("first is not null").groupBy(F.col("first").alias("id")).agg(F.min(F.struct("d1", "d2")).alias("d")).select("id", "d.*")
    bands = features.join(chosen.hint("merge"), ["id", "d1", "d2"], "left_semi").select("id", F.explode("bands").alias("band"))
    bucket = Window.partitionBy("band").orderBy("id")
    members = bands.select("band", "id", F.first("id").over(bucket).alias("head"), F.lag("id").over(bucket).alias("prev"), F.lead("id").over(bucket).alias("next"))
    members = written(members.filter("prev < id or next > id").select("band", "id", "head", "prev"))
    picks = written(chosen.join(members.select("id").distinct(), "id", "left_semi"))
    known = features.join(picks.hint("merge"), ["id", "d1", "d2"], "left_semi").select("id", "n_shingles", "small", "large")
    sets = texts.join(picks.hint("merge"), "id", "left_semi").select("id", "text").mapInArrow(_sets(width), "id long, d1 long, items binary")
    if not features.groupBy("id").count().filter("count > 1").isEmpty():
        known, sets = known.dropDuplicates(["id"]), sets.join(picks, ["id", "d1"], "left_semi").dropDuplicates(["id"])
    known, sets = written(known), written(sets.select("id", "items"))
    partners = members.select("id", F.explode(F.array_distinct(F.array("head", "prev"))).alias("a")).filter("a < id")
    shared = partners.groupBy("a", F.col("id").alias("b")).count()
    best = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("count"), "a"))
    pairs = shared.withColumn("rank", best).filter("rank <= 2").select("a", "b")
    components = connected_components(verify(written(estimated(pairs, known)), sets, percent))
    members = members.select("band", "id").distinct()
    components = joined_components(components, written(links_across(members, components, known, sets, percent)))
    placed = features.select("id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"], "left")
    placed = placed.join(components, F.col("first") == F.col("node"), "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "first")).otherwise(F.col("id"))
    return placed.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept")
    )
