"""Exact order statistics without sorting the data.

A sketch brackets the wanted rank, one aggregate counts what lies below, inside
and on the brackets, and the search goes on inside.  Equal values are counted
and never listed, so one value may hold any share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

ACCURACY = 10_000
# Rows that a single window may rank once the bracket is this narrow.
FEW_ROWS = 100_000


@dataclass(frozen=True)
class Tail:
    """The ``rank``-th smallest of ``rows`` values and what lies strictly below."""

    rows: int
    rank: int
    value: float
    below_rows: int
    below_sum: float

    @property
    def mean(self) -> float:
        """Mean of the ``rank`` smallest values."""
        return (self.below_sum + (self.rank - self.below_rows) * self.value) / self.rank


def tail_rank(rows: int, divisor: int = 20) -> int:
    """How many rows make up the tail: one in ``divisor``, at least one."""
    return max(rows // divisor, 1)


def lower_tail(df: DataFrame, column: str, divisor: int = 20, few_rows: int = FEW_ROWS) -> Tail | None:
    """The tail of 1/divisor of the rows; None when there are no rows."""
    x = df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    share = 1.0 / divisor
    probe = x.agg(F.count("*").alias("n"), _bracket(share).alias("b")).first()
    if not probe["n"]:
        return None
    rank = tail_rank(probe["n"], divisor)
    return _select(x, probe["n"], rank, probe["b"], few_rows)


def _bracket(share: float) -> Column:
    slack = 2.0 / ACCURACY
    ends = F.array(F.lit(max(share - slack, 0.0)), F.lit(min(share + slack, 1.0)))
    return F.percentile_approx("x", ends, ACCURACY)


def _select(x: DataFrame, rows: int, rank: int, bracket, few_rows: int) -> Tail:
    inside, inside_rows, below_rows, below_sum = x, rows, 0, 0.0
    while inside_rows > few_rows:
        if bracket is None:
            share = (rank - below_rows) / inside_rows
            bracket = inside.agg(_bracket(share)).first()[0]
        a, b = bracket
        place = (
            F.when(F.col("x") < F.lit(a), 0)
            .when(F.col("x") == F.lit(a), 1)
            .when(F.col("x") < F.lit(b), 2)
            .when(F.col("x") == F.lit(b), 3)
            .otherwise(4)
        )
        found = {
            r["place"]: r
            for r in inside.groupBy(place.alias("place"))
            .agg(F.count("*").alias("n"), F.sum("x").alias("s"))
            .collect()  # at most five rows
        }
        for p in range(5):
            r = found.get(p)
            if r is None:
                continue
            if below_rows + r["n"] >= rank:
                break
            below_rows += r["n"]
            below_sum += r["s"]
        if p in (1, 3):
            return Tail(rows, rank, a if p == 1 else b, below_rows, below_sum)
        keep = {
            0: F.col("x") < F.lit(a),
            2: (F.col("x") > F.lit(a)) & (F.col("x") < F.lit(b)),
            4: F.col("x") > F.lit(b),
        }
        inside, inside_rows, bracket = inside.filter(keep[p]), found[p]["n"], None
    w = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = (
        inside.groupBy("x")
        .agg(F.count("*").alias("n"))
        .select(
            "x",
            "n",
            F.sum("n").over(w).alias("upto"),
            F.sum(F.col("x") * F.col("n")).over(w).alias("sum_upto"),
        )
        .filter(F.col("upto") >= rank - below_rows)
        .orderBy("x")
        .first()
    )
    return Tail(
        rows,
        rank,
        row["x"],
        below_rows + row["upto"] - row["n"],
        below_sum + row["sum_upto"] - row["x"] * row["n"],
    )


def kth_smallest(df: DataFrame, column: str, k: int, few_rows: int = FEW_ROWS) -> Tail | None:
    """The k-th smallest value (the largest one when there are fewer rows)."""
    x = df.select(F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    rows = x.count()
    if not rows:
        return None
    return _select(x, rows, min(k, rows), None, few_rows)


def k_smallest(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k smallest values, as many copies of a value as belong to them."""
    spark = df.sparkSession
    tail = kth_smallest(df, column, k)
    values = df.select(F.col(column).cast("double").alias(column))
    if tail is None:
        return values.limit(0)
    below = values.filter(F.col(column) < F.lit(tail.value))
    copies = spark.range(tail.rank - tail.below_rows).select(F.lit(tail.value).alias(column))
    return below.unionByName(copies)
