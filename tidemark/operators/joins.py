"""Lookups in keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

SALTS = 16


def lookup_join(big: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a large frame to a lookup table on equal column names.

    Nothing is counted, so the join stays lazy: a table that is known to be small
    is broadcast, one that turns out to be is broadcast after its own shuffle, and
    hot keys of the others are split by the adaptive skew join.
    """
    return big.join(lookup, on, how)


def salted_join(
    big: DataFrame, lookup: DataFrame, on: list[str], spread_by: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """The same for keys known to be hot, in plans where the adaptive join cannot split them.

    The lookup side is copied per salt, and the rows of a key are dealt by a hash
    of ``spread_by``.  These have to be columns of integers or strings: a sum of
    doubles may differ in its last bit when a task runs again, and rows that
    change their salt then are lost or doubled.
    """
    for name in spread_by:
        if not isinstance(big.schema[name].dataType, (T.IntegralType, T.StringType)):
            raise TypeError(f"{name} is no integer or string")
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def semi_filter(df: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``ids``."""
    return lookup_join(df, ids.select(*on).distinct(), on, "left_semi")


def lookup_by_key(df: DataFrame, key: str, value, must_exist: bool = False) -> DataFrame:
    """One row with the given key; with ``must_exist`` a missing key is an error."""
    found = df.filter(F.col(key) == F.lit(value)).limit(1)
    if must_exist and found.isEmpty():
        raise KeyError(value)
    return found


def resolve_alias(ratings: DataFrame, alias: DataFrame, item: str = "item", merge: bool = False) -> DataFrame:
    """Replace an item by its alias, one step only.

    ``alias`` has ``bad`` and ``good``.  Rows that meet on one item stay apart;
    with ``merge`` their ratings are summed per (user, item).
    """
    keyed = alias.select(F.col("bad").alias(item), F.col("good").alias("_good"))
    joined = lookup_join(ratings, keyed, [item], "left")
    columns = [
        F.coalesce(F.col("_good"), F.col(item)).alias(item) if c == item else F.col(c)
        for c in ratings.columns
    ]
    out = joined.select(*columns)
    if merge:
        out = out.groupBy("user", item).agg(F.sum("rating").alias("rating"))
    return out
