"""Factors of implicit counts by alternating least squares, with one copy of the factors per half step."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import cut_lineage, remove, storage, stored

# Numbers that one task holds: sums of the rows it solves, and factors of the other side.
SUMS, HELD = 1 << 25, 1 << 25
# Ratings of one block at most (rows of any size go in pieces), of one stored piece, and those worth a task.
BLOCK, PIECE, SMALL = 1 << 24, 1 << 17, 1 << 18
# Ratings that are multiplied at a time, few enough for a core's cache, and those of a row that is not padded.
STACK, LONG = 1 << 13, 1 << 9
PART = 1 << 16  # rows of factors in one stored row


class ImplicitFactors(NamedTuple):
    """``(id, features)`` of users and of items."""

    userFactors: DataFrame
    itemFactors: DataFrame


class Side(NamedTuple):
    """Rows of one side: hashed to blocks, some blocks in a row are a band; ``path`` has the sorted ids by block."""

    blocks: int
    per_band: int
    path: str


def block_of(key: Column, blocks: int) -> Column:
    """The partition of ``repartition(blocks, key)``."""
    return F.pmod(F.hash(key), F.lit(blocks))


def band_of(key: Column, blocks: int, per_band: int) -> Column:
    return F.floor(block_of(key, blocks) / F.lit(per_band)).cast("int")


def runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal keys."""
    changed = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    ends = [0, *(np.flatnonzero(changed) + 1), len(keys[0])]
    return list(zip(ends[:-1], ends[1:], strict=True))


def parts_of(path: str, columns: list[str], where=None) -> pa.Table:
    """Stored parts in the order of their blocks."""
    fs, name = storage(path)
    files = pads.dataset(name, format="parquet", filesystem=fs, partitioning=pads.partitioning(pa.schema([("band", pa.int32())]), flavor="hive"))
    return files.to_table(columns=["block", "part", *columns], filter=where).sort_by([("block", "ascending"), ("part", "ascending")])


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    pieces = [np.frombuffer(value.as_buffer(), dtype=kind) for value in column]
    return np.concatenate(pieces) if pieces else np.empty(0, dtype=kind)


def ids_of(path: str, band: int, block: int | None = None) -> np.ndarray:
    where = pads.field("band") == band
    return joined(parts_of(path, ["ids"], where if block is None else where & (pads.field("block") == block)).column("ids"), np.int32)


def checked(ratings: DataFrame) -> DataFrame:
    """``(user, item, value)``; ids that are no integers and missing ratings are errors, as in the library."""

    def whole(name):
        key = F.col(name)
        good = key.isNotNull() & (key == F.floor(key)) & key.between(-(1 << 31), (1 << 31) - 1)
        return F.when(good, key).otherwise(F.raise_error(F.lit(f"{name} has to be an integer"))).cast("int").alias(name)

    rating = F.col("rating").cast("float")
    given = F.when(rating.isNull() | F.isnan(rating), F.raise_error(F.lit("a rating is missing"))).otherwise(rating)
    return ratings.select(whole("user"), whole("item"), given.cast("float").alias("value"))


def layout(spark: SparkSession, ratings: int, rows: int, rank: int) -> tuple[int, int]:
    """Number of blocks of a side and of blocks in a band; bounded in ratings, sums and factors."""
    cores = spark.sparkContext.defaultParallelism
    needed = max(1, math.ceil(ratings / BLOCK), math.ceil(rows * rank * (rank + 1) / SUMS), min(cores, math.ceil(ratings / SMALL)))
    blocks = math.ceil(needed / cores) * cores if needed > cores else needed
    return blocks, max(1, min(blocks, int(blocks * HELD / (rows * rank))))


def side(rows: DataFrame, rank: int, blocks: int, per_band: int) -> Side:
    """Store ``(id[, features])`` by block, ids ascending, with the products of the factors of each part."""
    given = "features" in rows.columns
    key = F.col("id")
    placed = rows.repartition(blocks, "id").withColumn("block", block_of(key, blocks)).sortWithinPartitions("block", "id")

    def pack(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        numbers, ids = table.column("block").to_numpy(), table.column("id").to_numpy().astype(np.int32)
        factors = np.zeros((len(ids), 0), dtype=np.float32)
        if given:
            factors = table.column("features").combine_chunks().flatten().to_numpy().astype(np.float32).reshape(-1, rank)
        for lo, hi in runs(numbers):
            block = int(numbers[lo])
            for batch in stored_parts(block, block // per_band, factors[lo:hi]):
                at = lo + batch.column("part")[0].as_py() * PART
                yield batch.append_column("ids", pa.array([ids[at : min(at + PART, hi)].tobytes()], pa.binary()))

    return Side(blocks, per_band, stored(placed.mapInArrow(pack, PARTS + ", ids binary"), "band"))


PARTS = "block int, band int, part int, data binary, gram binary"


def stored_parts(block: int, band: int, factors: np.ndarray):
    """Rows of ``PARTS`` for the factors of one block."""
    for part, at in enumerate(range(0, len(factors), PART)):
        some = factors[at : at + PART]
        gram = some.T.astype(np.float64) @ some.astype(np.float64)
        place = [pa.array([v], pa.int32()) for v in (block, band, part)]
        yield pa.record_batch([*place, pa.array([some.tobytes()]), pa.array([gram.tobytes()])], names=["block", "band", "part", "data", "gram"])


def rating_blocks(ratings: DataFrame, own: str, other: str, mine: Side, theirs: Side) -> DataFrame:
    """Ratings by block of ``own``, one partition each, in pieces of one band of ``other``: rows of the block with their counts,
    positions in the band and values."""
    placed = ratings.select(F.col(own).alias("own"), F.col(other).alias("other"), "value").repartition(mine.blocks, "own")
    placed = placed.select(
        block_of(F.col("own"), mine.blocks).alias("block"), band_of(F.col("other"), theirs.blocks, theirs.per_band).alias("band"), "own", "other", "value"
    )
    # One number as the only key, which is sorted by its digits.
    place = F.col("block").cast("long") * theirs.blocks + F.col("band")
    placed = placed.sortWithinPartitions(place * (1 << 32) + F.col("own").cast("long") + (1 << 31))

    def cut(batches):
        held, size, block, band = [], 0, None, None

        def piece():
            keys, others, values = (np.concatenate(parts) for parts in zip(*held, strict=True))
            starts, ends = np.array(runs(keys)).T
            counts, places = (ends - starts).astype(np.int32), np.searchsorted(rows, keys[starts]).astype(np.int32)
            positions = order[np.searchsorted(ascending, others)]
            for i in np.flatnonzero(counts >= LONG):
                # Factors of a long row are read from front to back.
                some = slice(starts[i], ends[i])
                forward = starts[i] + np.argsort(positions[some])
                positions[some], values[some] = positions[forward], values[forward]
            numbers = [pa.array([v], pa.int32()) for v in (block, block // mine.per_band, band, len(rows))]
            arrays = [pa.array([a.tobytes()]) for a in (places, counts, positions, values)]
            return pa.record_batch([*numbers, *arrays], names=["block", "own_band", "band", "size", "own", "count", "pos", "value"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            blocks, bands, *columns = (batch.column(c).to_numpy() for c in ("block", "band", "own", "other", "value"))
            for lo, hi in runs(blocks, bands):
                if held and (size >= PIECE or (blocks[lo], bands[lo]) != (block, band)):
                    yield piece()
                    held, size = [], 0
                if blocks[lo] != block:
                    block = int(blocks[lo])
                    rows = ids_of(mine.path, block // mine.per_band, block)
                if bands[lo] != band:
                    band = int(bands[lo])
                    there = ids_of(theirs.path, band)
                    order = np.argsort(there).astype(np.int32)
                    ascending = there[order]
                held.append([c[lo:hi] for c in columns])
                size += hi - lo
        if held:
            yield piece()

    return cut_lineage(placed.mapInArrow(cut, "block int, own_band int, band int, size int, own binary, count binary, pos binary, value binary"))


def padded(counts: np.ndarray) -> np.ndarray:
    """The next of 1, 2, 3, 4, 6, 8, 12, 16, ..."""
    power = 2 ** np.ceil(np.log2(counts)).astype(np.int64)
    return np.where((power >= 4) & (counts <= power * 3 // 4), power * 3 // 4, power)


def add_piece(left, right, explicit, factors, own, counts, positions, values, alpha):
    """Add the ratings of a piece to the sums of its rows: long rows one by one, others in stacks of like counts."""
    rank = factors.shape[1]
    weights = alpha * np.abs(values.astype(np.float64))
    aims = np.where(values > 0, 1.0 + weights, 0.0)
    starts = np.cumsum(counts) - counts
    explicit[own] += np.add.reduceat((values > 0).astype(np.float64), starts)

    def products(at, outside=None):
        y = factors.take(positions.take(at), axis=0).astype(np.float64)
        scale, aim = weights.take(at), aims.take(at)
        if outside is not None:
            scale[outside] = aim[outside] = 0.0
        both = np.empty((*at.shape, rank + 1))
        np.multiply(y, scale[..., None], out=both[..., :rank])
        both[..., rank] = aim
        return np.matmul(both.swapaxes(-1, -2), y)

    for i in np.flatnonzero(counts >= LONG):
        end = starts[i] + counts[i]
        for lo in range(starts[i], end, STACK):
            sums = products(np.arange(lo, min(lo + STACK, end)))
            left[own[i]] += sums[:rank]
            right[own[i]] += sums[rank]
    widths = np.where(counts < LONG, padded(counts), 0)
    for width in np.unique(widths[widths > 0]):
        alike, steps = np.flatnonzero(widths == width), np.arange(width)
        many = max(1, STACK // int(width))
        for some in (alike[i : i + many] for i in range(0, len(alike), many)):
            at, outside = starts[some, None] + steps, steps >= counts[some, None]
            at[outside] = 0
            sums = products(at, outside)
            left[own[some]] += sums[:, :rank]
            right[own[some]] += sums[:, rank]


def half_step(blocks: DataFrame, path: str, rank: int, reg: float, alpha: float) -> DataFrame:
    """Solve every row of a side from the other side's factors stored at ``path``: the new factors, without a shuffle.

    A task streams the ratings of a block and holds the factors of one band and one system per row of its block.
    """

    def solved(block, own_band, left, right, explicit):
        whole = joined(parts_of(path, ["gram"]).column("gram"), np.float64).reshape(-1, rank, rank).sum(axis=0)
        new = np.zeros(right.shape, dtype=np.float32)
        for lo in range(0, len(new), 1 << 14):
            # Rows without a positive count have a right side of zeros.
            rated = lo + np.flatnonzero(explicit[lo : lo + (1 << 14)] > 0)
            systems = left[rated] + whole + (reg * explicit[rated])[:, None, None] * np.eye(rank)
            new[rated] = np.linalg.solve(systems, right[rated][:, :, None])[:, :, 0]
        yield from stored_parts(block, own_band, new)

    def solve(batches):
        block = band = sums = None
        for row in (dict(zip(b.schema.names, values, strict=True)) for b in batches for values in zip(*b.columns, strict=True)):
            if row["block"].as_py() != block:
                if sums:
                    yield from solved(block, own_band, *sums)
                block, own_band, size = (row[c].as_py() for c in ("block", "own_band", "size"))
                sums = np.zeros((size, rank, rank)), np.zeros((size, rank)), np.zeros(size)
            if row["band"].as_py() != band:
                band = row["band"].as_py()
                factors = joined(parts_of(path, ["data"], pads.field("band") == band).column("data"), np.float32).reshape(-1, rank)
            kinds = {"own": np.int32, "count": np.int32, "pos": np.int32, "value": np.float32}
            add_piece(*sums, factors, *(np.frombuffer(row[c].as_buffer(), dtype=kind) for c, kind in kinds.items()), alpha)
        if sums:
            yield from solved(block, own_band, *sums)

    return blocks.mapInArrow(solve, PARTS)


def as_rows(spark: SparkSession, path: str, ids: Side, rank: int) -> DataFrame:
    """``(id, features)`` of stored factors."""

    def unpack(batches):
        for batch in batches:
            for block, band, part, data in zip(*(batch.column(c) for c in ("block", "band", "part", "data")), strict=True):
                values = pa.array(np.frombuffer(data.as_buffer(), dtype=np.float32))
                at = part.as_py() * PART
                keys = ids_of(ids.path, band.as_py(), block.as_py())[at : at + len(values) // rank]
                offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * rank)
                yield pa.record_batch([pa.array(keys), pa.ListArray.from_arrays(offsets, values)], names=["id", "features"])

    parts = spark.read.schema(PARTS).parquet(path).select("block", "band", "part", "data")
    return parts.mapInArrow(unpack, "id int, features array<float>")


def first_factors(users: DataFrame, rank: int, seed: int) -> DataFrame:
    """The library's starting factors: a fit of no iteration, which depends on the set of users only."""
    from pyspark.ml.recommendation import ALS  # not needed in tasks, where it would be loaded with this module

    start = ALS(rank=rank, maxIter=0, implicitPrefs=True, userCol="user", itemCol="item", ratingCol="rating", seed=seed)
    return start.fit(users.select("user", F.col("user").alias("item"), F.lit(1.0).alias("rating"))).userFactors


def fit(ratings: DataFrame, rank: int, iterations: int, reg: float, alpha: float, seed: int) -> ImplicitFactors:
    """The library's implicit factorisation (same start, same equations) of ``(user, item, rating)``.

    The library sends a row's factors to every block that rates it, up to ten copies a half step.  Here a half step writes
    the new factors once, to the folder of checkpoints, and the next one's tasks read them from there band by band.
    """
    if iterations < 1:
        raise ValueError("at least one iteration")
    spark = ratings.sparkSession
    raw_path = stored(checked(ratings))
    raw = spark.read.schema("user int, item int, value float").parquet(raw_path)
    counts = raw.agg(F.count("*"), F.approx_count_distinct("user"), F.approx_count_distinct("item")).first()
    if counts[0] == 0:
        raise ValueError("no ratings")
    users = side(first_factors(raw.select("user").distinct(), rank, seed), rank, *layout(spark, counts[0], counts[1], rank))
    items = side(raw.select(F.col("item").alias("id")).distinct(), rank, *layout(spark, counts[0], counts[2], rank))
    by_user = rating_blocks(raw, "user", "item", users, items)
    by_item = rating_blocks(raw, "item", "user", items, users)
    remove(spark, raw_path)
    user_path, item_path = users.path, None
    for _ in range(iterations):
        before = [item_path] if item_path else []
        item_path = stored(half_step(by_item, user_path, rank, reg, alpha), "band")
        before += [user_path] if user_path != users.path else []
        user_path = stored(half_step(by_user, item_path, rank, reg, alpha), "band")
        remove(spark, *before)
    return ImplicitFactors(as_rows(spark, user_path, users, rank), as_rows(spark, item_path, items, rank))
