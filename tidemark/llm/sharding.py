"""Sharding by sampled splitters, in built-in functions only.

A record's place is one number: the high half is a hash of its group, the low
half one of its own id. Groups so stay together: a range begins where a group
does, and only a group of more than an eighth of a shard may be cut. Records are drawn with a chance in proportion
to their size; quantiles of the drawn places bound many small ranges. The true
size of each range is then summed, ranges that came out overfull are subdivided
by another draw inside them, and neighbouring ranges are joined into shards of
nearly equal size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import written

#: Draws for each range; the drawn places that reach the driver are about ranges x DRAWS (each a number and a weight).
DRAWS = 16
#: Rows that a range should hold at most, until there are MOST_RANGES for each shard.
RANGE_ROWS, LEAST_RANGES, MOST_RANGES = 100_000, 64, 1024
#: A group of up to this part of a shard (one eighth) is not cut.
WHOLE = 8


def place(group: Column, key: Column) -> Column:
    """The number that orders all records: 31 bits of the group, 32 of the key."""
    high = F.shiftleft(F.shiftrightunsigned(F.xxhash64(group), 33), 32)
    return high.bitwiseOR(F.shiftrightunsigned(F.xxhash64(key), 32))


def numbers(values: list[int]) -> Column:
    """A constant array of longs, parsed in one go."""
    return F.expr(f"array({', '.join(f'{x}L' for x in values)})")


def range_of(where: Column, splits: list[int]) -> Column:
    """How many of the sorted splits are not above ``where``, by a search in two steps."""
    if not splits:
        return F.lit(0)
    step = math.isqrt(len(splits)) + 1
    parts = [splits[i : i + step] for i in range(0, len(splits), step)]
    tops, inner = numbers([p[-1] for p in parts]), F.array(*map(numbers, [*parts, parts[-1]]))
    first = F.size(F.filter(tops, lambda x: x <= where))
    rest = F.size(F.filter(F.element_at(inner, first + 1), lambda x: x <= where))
    return F.when(first == len(parts), F.lit(len(splits))).otherwise(first * step + rest)


def drawn_splits(rows: DataFrame, total: float, pieces: int, seed: int, whole: float) -> list[int]:
    """Splitters that cut ``rows`` of ``total`` size into about ``pieces`` equal parts, and no group up to the size ``whole``."""
    chance = F.col("size") * F.lit(DRAWS * pieces / total)
    unit = F.xxhash64("place", "size", F.lit(seed)).bitwiseAND(F.lit(2**53 - 1)) / F.lit(float(2**53))
    drawn = rows.filter(unit < chance).select("place", F.greatest(chance, F.lit(1.0)).alias("weight")).orderBy("place").collect()
    weight, step = sum(r.weight for r in drawn), 1
    groups: dict[int, float] = {}
    for r in drawn:
        groups[r.place >> 32] = groups.get(r.place >> 32, 0.0) + r.weight
    splits, seen = [], 0.0
    for r in drawn:
        # Where the group is not to be cut, the range begins where the group does.
        group = r.place >> 32
        at = r.place if groups[group] > whole * weight / total else group << 32
        if (not splits or at > splits[-1]) and seen >= step * weight / pieces:
            splits.append(at)
            step = int(seen * pieces / weight) + 1
        seen += r.weight
    return splits


def range_sizes(rows: DataFrame, splits: list[int]) -> list[tuple[int, int]]:
    """Size and rows of every range between splits; one pair per range reaches the driver."""
    out = [(0, 0)] * (len(splits) + 1)
    for r in rows.groupBy(range_of(F.col("place"), splits).alias("r")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
        out[r.r] = (r.size, r.n)
    return out


def shard_by_splitters(docs: DataFrame, group: Column, key: Column, size: Column, shards: int = 24, rounds: int = 3, seed: int = 7) -> DataFrame:
    """``row`` (a struct), ``size``, ``shard`` and ``slot`` per record.

    Shards are runs of ranges and near equal in summed ``size``; slots number
    the records of a shard from 0 without gaps. Null groups and keys count as
    values of their own; records equal in place and size are numbered in any
    order; sizes must be above 0. An empty table gives an empty result.
    """
    rows = written(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), size.cast("long").alias("size"), place(group, key).alias("place"))
    )
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    if not count:
        return rows.select("row", "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranges = shards * min(MOST_RANGES, max(LEAST_RANGES, math.ceil(count / shards / RANGE_ROWS)))
    whole = total / shards / WHOLE
    splits = drawn_splits(rows, total, ranges, seed, whole)
    sizes = range_sizes(rows, splits)
    for again in range(1, rounds + 1):
        over = [i for i, (s, n) in enumerate(sizes) if s > 2 * total / ranges and n > 1]
        if not over:
            break
        inside = sum(sizes[i][0] for i in over)
        full = rows.filter(F.array_contains(numbers(over), range_of(F.col("place"), splits).cast("long")))
        more = drawn_splits(full, inside, math.ceil(2 * inside * ranges / total), seed + again, whole)
        merged = sorted({*splits, *more})
        if merged == splits:
            break
        splits = merged
        sizes = range_sizes(rows, splits)
    shard_of, first_slot, before, taken = [], [], 0, [0] * shards
    for s, n in sizes:
        shard = min(shards - 1, int((before + s / 2) * shards / total))
        shard_of.append(shard)
        first_slot.append(taken[shard])
        taken[shard] += n
        before += s
    at = F.col("range") + 1
    within = F.row_number().over(Window.partitionBy("range").orderBy("place", "size"))
    return rows.withColumn("range", range_of(F.col("place"), splits)).select(
        "row",
        "size",
        F.element_at(numbers(shard_of), at).cast("int").alias("shard"),
        (F.element_at(numbers(first_slot), at) + within - 1).alias("slot"),
    )
