"""Saving term counts so that later steps need not tokenise again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.delimited import format_term_freq_maps, parse_term_freq_maps


def save_term_counts(df: DataFrame, path: str) -> None:
    """Long-form counts as Parquet, the form to prefer."""
    df.write.mode("overwrite").parquet(path)


def save_term_maps(df: DataFrame, path: str, column: str = "term_freqs") -> None:
    """One printed map per line."""
    format_term_freq_maps(df, column).write.mode("overwrite").text(path)


def read_term_maps(spark: SparkSession, path: str) -> DataFrame:
    return parse_term_freq_maps(spark.read.text(path))
