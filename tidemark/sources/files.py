"""Scans and writes of text, gzip and XML files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

PAGE_SCHEMA = (
    "title string, ns int, redirect struct<_title: string>, "
    "revision struct<text: struct<_VALUE: string, _bytes: string>>"
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, in column ``value``."""
    return spark.read.text(path)


def read_gzip_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Lines of gzip files.

    A gzip file cannot be split, so each is one task; the rows are spread over
    the cluster right after the scan, before any costly parsing.
    """
    target = partitions or max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    return spark.read.text(path).repartition(target)


def spread_scan(scan: DataFrame) -> DataFrame:
    """Spread the rows of a scan that has fewer splits than the cluster has cores.

    For input to costly work per row.  A scan of many files or row groups is
    left as it is, so large inputs are not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_page_dump(spark: SparkSession, path: str) -> DataFrame:
    """Records between ``<page>`` and ``</page>``: title, ns, redirect flag, text."""
    pages = spark.read.option("rowTag", "page").schema(PAGE_SCHEMA).xml(path)
    return pages.select(
        "title",
        "ns",
        F.col("redirect").isNotNull().alias("is_redirect"),
        F.col("revision.text._VALUE").alias("text"),
    )


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, duplicates removed."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()
