"""Mixing sources to target weights, in built-in functions only.

Words are totalled per source; the totals give every source a target, and the
ratio of target to total is its repetition rate. A document is emitted
``floor(rate)`` times, and once more when its hash falls below a cut. The hash is
seeded and depends on the document's key alone. Independent draws with the
fraction of the rate as their chance would leave a source of few documents far
from its target, so the cut of a source is the one at which the words below it
come nearest to the words that the fraction asks for: over all keys the chance is
the fraction. Documents of more than an eighth of their source (at most seven)
would upset that; of them those get the copy, smallest first, that fit what
is asked for, and the others fill the rest. Words are summed by 2^16 ranges of the
hash, so nothing is sorted and no row is moved but by the join with the sources.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import written

WORD = r"[^\x20\x09-\x0D]+"
#: Up to so many sources the source table is broadcast (under 1 MB); beyond, it is joined by a shuffle.
BROADCAST_SOURCES = 10_000
#: Ranges of the hash by which words are summed, and the share of a source (one of so many parts) above which a document is large.
RANGES, LARGE = 1 << 16, 8


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of a digest; null keys share one."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def source_targets(docs: DataFrame, size: Column, source: str = "source", weights: Sequence[int] = (1, 2, 3), limit: int = 3) -> DataFrame:
    """Per source: ``source, source_size, target, rate``; one row per source.

    Sources ordered by code point, null last, take the weights in turn and share
    the total of all sizes. No target exceeds ``limit`` times its source's size;
    what is cut there is shared again by weight. With the sources in the order
    of size / weight, the level ``(total - caps before) / (weights from here)``
    is highest exactly where the capped sources end, so one pass finds it.
    A source of size 0 has target and rate 0.
    """
    per_source = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum(size).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    cap = F.col("source_size") * F.lit(float(limit))
    ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    before = F.coalesce(F.sum("source_size").over(ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before * F.lit(float(limit))) / after
    return (
        per_source.withColumn("weight", weight)
        .withColumn("ratio", cap / F.col("weight"))
        .withColumn("level", level)
        .withColumn("target", F.least(cap, F.max("level").over(everything) * F.col("weight")))
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .select("source", "source_size", "target", "rate")
    )


def source_cuts(sizes: DataFrame, rates: DataFrame) -> DataFrame:
    """Per source: ``cut``, the first range of hashes without an extra copy, and ``largest``, the last large document with one.

    ``sizes`` has ``source, size, unit``, the hash. Rows equal in size and hash are treated alike.
    """
    asked = (F.col("rate") - F.floor("rate")) * F.col("source_size")
    rows = sizes.join(_small(rates).withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("asked", asked).filter("asked > 0")
    by_size = Window.partitionBy("source").orderBy("size", "unit")
    large = rows.filter(is_large()).withColumn("sum", F.sum("size").over(by_size)).filter("sum <= asked")
    large = large.groupBy("source").agg(F.sum("size").alias("used"), F.max(F.struct("size", "unit")).alias("largest"))
    known = large.withColumnRenamed("source", "_source")
    ranges = written(rows.filter(~is_large()).groupBy("source", hash_range().alias("range")).agg(F.sum("size").alias("size"), F.first("asked").alias("asked")))
    ranges = ranges.join(known.drop("largest"), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    ranges = ranges.withColumn("left", F.col("asked") - F.coalesce("used", F.lit(0))).drop("asked", "used")
    # First the group of ranges in which the words run out, then the range in it; a window sees only the square root of all ranges.
    step = 1 << (RANGES.bit_length() // 2)
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("group"))
    groups = ranges.groupBy("source", F.floor(F.col("range") / step).alias("group")).agg(F.sum("size").alias("size"), F.first("left").alias("left"))
    groups = groups.withColumn("before", upto - F.col("size")).filter(F.col("before") <= F.col("left"))
    last = groups.groupBy(F.col("source").alias("_source")).agg(F.max(F.struct("group", "before")).alias("last"))
    inside = ranges.join(last, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").filter(F.floor(F.col("range") / step) == F.col("last.group"))
    upto = F.col("last.before") + F.sum("size").over(Window.partitionBy("source").orderBy("range"))
    reached = (F.col("range") + 1) * (2 * upto - F.col("size") <= 2 * F.col("left")).cast("int")
    cut = inside.select(F.col("source").alias("_source"), F.greatest(reached, (F.col("last.group") * step).cast("int")).alias("cut"))
    cut = cut.groupBy("_source").agg(F.max("cut").alias("cut"))
    out = rates.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    return out.join(known.drop("used"), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def is_large() -> Column:
    return F.col("size") * LARGE > F.col("source_size")


def hash_range() -> Column:
    return F.floor(F.col("unit") * RANGES).cast("int")


def _small(rates: DataFrame) -> DataFrame:
    return F.broadcast(rates) if rates.count() <= BROADCAST_SOURCES else rates


def mix_plan(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[int] = (1, 2, 3),
    limit: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``doc`` (the row as a struct), ``size``, ``source_size``, ``target``, ``copies`` per document.

    Null texts have size 0; null sources are one source of their own; repeated
    rows with one key get the same draw; an empty table gives an empty result.
    The row stays a struct, so columns of any name are kept.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.select("doc", word_count(F.col("doc")[text]).alias("size"), unit_hash(F.col("doc")[key], seed).alias("unit"))
    # Words are counted once for the sums; the numbers are a small part of the texts.
    sizes = written(rows.select(F.col("doc")[source].alias("source"), "size", "unit"))
    rates = written(source_targets(sizes, F.col("size"), "source", weights, limit))
    cuts = written(source_cuts(sizes, rates))
    joined = rows.join(_small(cuts), F.col("doc")[source].eqNullSafe(F.col("source")))
    mine = F.struct("size", "unit")
    extra = F.when(is_large(), mine <= F.col("largest")).otherwise(hash_range() < F.col("cut"))
    copies = F.floor("rate") + F.coalesce(extra, F.lit(False)).cast("long")
    return joined.select("doc", "size", "source_size", "target", copies.alias("copies"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns as before."""
    plan = mix_plan(docs, **options).filter("copies > 0")
    return plan.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("doc.*")
