"""Samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import rng


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Each row is kept with the given probability, without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def poisson_sample(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    """Sample with replacement at fraction 1: each row appears Poisson(1) times."""
    copies = rng.poisson1(rng.lanes(rng.digest(seed, F.col(row_id), 0))[0])
    return df.withColumn("_n", copies).filter("_n > 0").withColumn(
        "_i", F.explode(F.sequence(F.lit(1), F.col("_n")))
    ).drop("_n", "_i")


def hash_sample(df: DataFrame, row_id: Column, fraction: float, seed: int) -> DataFrame:
    """A Bernoulli sample that depends only on the row's id and the seed."""
    return df.filter(rng.uniform(seed, row_id) < F.lit(fraction))


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def hash_split(
    df: DataFrame, row_id: Column, seed: int, weights=(0.8, 0.1, 0.1), names=("train", "cv", "test")
) -> DataFrame:
    """Add a column ``part`` that assigns each row to one split by its id."""
    total, edge, edges = sum(weights), 0.0, []
    for w in weights[:-1]:
        edge += w / total
        edges.append(edge)
    u = rng.uniform(seed, row_id)
    part = F.lit(names[-1])
    for name, e in list(zip(names, edges))[::-1]:
        part = F.when(u < F.lit(e), F.lit(name)).otherwise(part)
    return df.withColumn("part", part)
