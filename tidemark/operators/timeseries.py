"""Histories: trimming, calendar filling, two-week changes.

A history has columns ``series``, ``date`` and ``value``.  Windows are per
series over at most one row per day, so their size is bounded by the calendar
and not by the data.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.operators.joins import lookup_join

# The histories must span five years of 260 trading days.
MIN_HISTORY_ROWS = 260 * 5 + 10
WINDOW_DAYS = 10


def _day(d: str | date):
    return F.lit(str(d)).cast("date")


def min_history(history: DataFrame, min_rows: int = MIN_HISTORY_ROWS) -> DataFrame:
    """Series with at least ``min_rows`` rows, counted before any trimming."""
    long_enough = (
        history.groupBy("series").agg(F.count("*").alias("n")).filter(F.col("n") >= min_rows).select("series")
    )
    return lookup_join(history, long_enough, ["series"], "left_semi")


def one_per_day(history: DataFrame) -> DataFrame:
    """Merge rows of one day; the largest value counts, whatever the row order."""
    return history.groupBy("series", "date").agg(F.max("value").alias("value"))


def trim_to_region(history: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Rows from ``start`` to ``end``, both included, with both ends present.

    A missing start takes the first value inside, a missing end the last one.  A
    series without a row inside is left out.
    """
    inside = one_per_day(history.filter(F.col("date").between(_day(start), _day(end))))
    w = Window.partitionBy("series").orderBy("date")
    first, last = F.lag("date").over(w).isNull(), F.lead("date").over(w).isNull()
    days = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(F.col("first"), _day(start)),
                F.col("date"),
                F.when(F.col("last"), _day(end)),
            )
        )
    )
    marked = inside.withColumns({"first": first, "last": last})
    return marked.select("series", F.explode(days).alias("date"), "value")


def fill_weekdays(history: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """One row per weekday in [start, end) with the last known value.

    Each known day is stretched up to the next one, so the calendar needs no
    join.  Days ahead of the first known value take that value.
    """
    w = Window.partitionBy("series").orderBy("date")
    since = F.when(F.lag("date").over(w).isNull(), _day(start)).otherwise(F.greatest("date", _day(start)))
    until = F.least(F.coalesce(F.lead("date").over(w), _day(end)), _day(end))
    spans = one_per_day(history).select("series", "value", since.alias("since"), until.alias("until"))
    days = F.filter(F.sequence("since", F.date_sub("until", 1)), lambda d: F.weekday(d) < 5)
    return spans.filter(F.col("since") < F.col("until")).select(
        "series", F.explode(days).alias("date"), "value"
    )


def two_week_returns(filled: DataFrame, rows: int = WINDOW_DAYS) -> DataFrame:
    """Last minus first value of every run of ten consecutive rows.

    The change is absolute, and dated by the first row.  A series with fewer
    rows gives nothing.
    """
    w = Window.partitionBy("series").orderBy("date")
    change = F.lead("value", rows - 1).over(w) - F.col("value")
    return filled.select("series", "date", change.alias("ret")).filter(F.col("ret").isNotNull())


def series_returns(history: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Trim, fill and difference, in that order."""
    return two_week_returns(fill_weekdays(trim_to_region(history, start, end), start, end))


def aligned_returns(
    stocks: DataFrame,
    factors: DataFrame,
    start: str | date,
    end: str | date,
    min_rows: int = MIN_HISTORY_ROWS,
) -> DataFrame:
    """Returns of stocks and factors on one calendar, told apart by ``kind``."""
    s = series_returns(min_history(stocks, min_rows), start, end)
    f = series_returns(factors, start, end)
    return s.withColumn("kind", F.lit("stock")).unionByName(f.withColumn("kind", F.lit("factor")))


def factor_matrix(returns: DataFrame, factors: list[str]) -> DataFrame:
    """One row per date, one column per factor, in the given order."""
    return returns.groupBy("date").pivot("series", factors).agg(F.max("ret"))
