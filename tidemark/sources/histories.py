"""Price histories: ``(series, date, value)`` rows from dated files or lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.text import split_fields

COMMA_DATE = "yyyy-MM-dd"
TAB_DATE = "MMM d, yyyy"


def _date(c: Column, pattern: str) -> Column:
    return F.try_to_timestamp(c, F.lit(pattern)).cast("date")


def _parse(lines: DataFrame, sep: str, pattern: str, series: str) -> DataFrame:
    f = split_fields(F.col("value"), sep)
    return lines.select(
        series,
        _date(F.try_element_at(f, F.lit(1)), pattern).alias("date"),
        F.try_element_at(f, F.lit(2)).try_cast("double").alias("value"),
    )


def _strict(parsed: DataFrame) -> DataFrame:
    """A bad row stops the job."""
    bad = F.col("date").isNull() | F.col("value").isNull()
    return parsed.filter(F.when(bad, F.raise_error(F.lit("bad history row")).cast("string")).isNull())


def parse_history_csv(
    lines: DataFrame, series: str = "series", header: str | None = None, strict: bool = True
) -> DataFrame:
    """Comma lines ``yyyy-MM-dd,value,...``; lines equal to ``header`` are skipped."""
    rows = lines if header is None else lines.filter(F.col("value") != header)
    parsed = _parse(rows, ",", COMMA_DATE, series)
    return _strict(parsed) if strict else parsed


def parse_history_tsv(lines: DataFrame, series: str = "series", strict: bool = True) -> DataFrame:
    """Tab lines ``MMM d, yyyy<TAB>value`` without a header."""
    parsed = _parse(lines, "\t", TAB_DATE, series)
    return _strict(parsed) if strict else parsed


def drop_bad_series(parsed: DataFrame, series: str = "series") -> DataFrame:
    """Leave out every series that has a row without a date or a value.

    The rows are read once and dealt by series, as the steps on histories need
    them anyway. Rows without a series are kept.
    """
    bad = F.col("date").isNull() | F.col("value").isNull()
    broken = F.bool_or(bad).over(Window.partitionBy(series))
    return parsed.withColumn("_broken", broken).filter(F.col(series).isNull() | ~F.col("_broken")).drop("_broken")


def _file_series() -> Column:
    return F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")


def read_history_csv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Comma histories with a header line per file; the file name is the series."""
    raw = spark.read.option("header", True).csv(path)
    date, value = raw.columns[:2]
    parsed = raw.select(
        _file_series().alias("series"),
        _date(F.col(date), COMMA_DATE).alias("date"),
        F.col(value).try_cast("double").alias("value"),
    )
    return _strict(parsed) if strict else parsed


def read_history_tsv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Tab histories without a header; the file name is the series."""
    lines = spark.read.text(path).select("value", _file_series().alias("series"))
    return parse_history_tsv(lines, strict=strict)


def read_histories(spark: SparkSession, folder: str) -> DataFrame:
    """All comma histories of a folder in one scan, without the broken files."""
    return drop_bad_series(read_history_csv(spark, folder, strict=False))
