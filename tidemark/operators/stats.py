"""Counts, summaries, unions and orderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.text import split_fields
from tidemark.session import cut_lineage


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def last_field_counts(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Count lines by their last field."""
    return count_by(lines.select(F.element_at(split_fields(F.col("value"), sep), -1).alias("label")), "label")


def crosstab_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Count pairs, ordered by pair."""
    return count_by(df, first, second).orderBy(first, second)


def numeric_stats(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, population deviation, maximum and minimum in one pass."""
    c = F.col(column)
    return df.agg(
        F.count(c).alias("n"),
        F.avg(c).alias("mean"),
        F.stddev_pop(c).alias("stdev"),
        F.max(c).alias("max"),
        F.min(c).alias("min"),
    )


def class_priors(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of each class, ordered by class."""
    # The window sees one row per class, so the table is read once.
    total = F.sum("n").over(Window.partitionBy())
    return count_by(df, label).select(label, (F.col("n") / total).alias("prior")).orderBy(label)


def prior_baseline(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy of guessing at random by the class shares; a missing class adds 0."""
    a = class_priors(train, label).withColumnRenamed("prior", "p")
    b = class_priors(test, label).withColumnRenamed("prior", "q")
    return a.join(b, label).agg(F.sum(F.col("p") * F.col("q")).alias("baseline"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def top_k(df: DataFrame, k: int, score: str, tie: str, descending: bool = True) -> DataFrame:
    """The k best rows.  Ties go by ``tie`` in the same direction."""
    order = [F.col(score), F.col(tie)]
    return df.orderBy(*[c.desc() if descending else c.asc() for c in order]).limit(k)


def dense_index(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """Contiguous ids from 0 in the given order, without one task seeing all rows.

    The rows are range-partitioned and sorted, written to the checkpoint folder
    so that partitions and positions stay as they are, and each partition's
    offset (one row per partition) is added to the position in it.
    """
    placed = (
        df.orderBy(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed = cut_lineage(placed)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n")).collect()  # one row per partition
    offsets, total = [], 0
    for row in sorted(sizes):
        offsets.append((row["_part"], total))
        total += row["n"]
    if not offsets:
        return placed.select(*df.columns, F.lit(0).cast("bigint").alias(name))
    starts = df.sparkSession.createDataFrame(offsets, "_part int, _start bigint")
    joined = placed.join(F.broadcast(starts), "_part")
    return joined.select(*df.columns, (F.col("_start") + F.col("_pos")).alias(name))
