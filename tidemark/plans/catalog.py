"""Registry of queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.files import spread_scan

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = ("parsing", "basics", "series", "simulation", "grouping", "suggestions", "trees", "terms", "concepts")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows where there is one."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    for module in MODULES:
        import_module(f"tidemark.plans.{module}")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table as input to costly work per row."""
    return spread_scan(table(spark, folder, name).select(*columns))


def rounded(c: Column | str, digits: int) -> Column:
    """Rounded for comparison; adding 0 turns -0.0 into 0.0."""
    return F.round(c, digits) + F.lit(0.0)
