"""Factor features, moments and least squares per instrument."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import arrays
from tidemark.operators.joins import lookup_join
from tidemark.operators.triangular import grouped_triangle
from tidemark.session import cut_lineage


def factor_means(matrix: DataFrame, factors: list[str]) -> DataFrame:
    """Long form ``(factor, mean)``."""
    pairs = F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f"`{f}`").alias("x")) for f in factors])
    return (
        matrix.select(F.explode(pairs).alias("p"))
        .groupBy(F.col("p.factor").alias("factor"))
        .agg(F.avg("p.x").alias("mean"))
    )


def factor_covariance(matrix: DataFrame, factors: list[str]) -> DataFrame:
    """Sample covariance of every pair, long form, in one aggregate."""
    pairs = [(a, b) for a in factors for b in factors]
    sums = matrix.agg(*[F.covar_samp(f"`{a}`", f"`{b}`").alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("factor_a"), F.lit(b).alias("factor_b"), F.col(f"c{i}").alias("cov"))
        for i, (a, b) in enumerate(pairs)
    ]
    return sums.select(F.inline(F.array(*cells)))


@dataclass(frozen=True)
class FactorModel:
    """Means and covariance of the factors: m and m * m numbers."""

    factors: list[str]
    means: np.ndarray
    covariance: np.ndarray

    def root(self) -> np.ndarray:
        """A matrix R with R R' = covariance; lower triangular when possible."""
        try:
            return np.linalg.cholesky(self.covariance)
        except np.linalg.LinAlgError:
            values, vectors = np.linalg.eigh(self.covariance)
            return vectors * np.sqrt(np.clip(values, 0.0, None))


def fit_factor_model(matrix: DataFrame, factors: list[str]) -> FactorModel:
    m = len(factors)
    aggregates = [F.avg(f"`{f}`") for f in factors]
    aggregates += [F.covar_samp(f"`{a}`", f"`{b}`") for a in factors for b in factors]
    row = matrix.agg(*aggregates).first()
    return FactorModel(list(factors), np.array(row[:m]), np.array(row[m:]).reshape(m, m))


def factor_features(matrix: DataFrame, factors: list[str]) -> DataFrame:
    """``(date, x)`` with the 3m features of each period."""
    return matrix.select("date", F.array(*arrays.featurize([F.col(f"`{f}`") for f in factors])).alias("x"))


#: Smallest share of the largest singular value of a system that can be solved.
SINGULAR = 1e-12


def _finite(c: Column) -> Column:
    return F.abs(c) < F.lit(math.inf)


def ols(
    returns: DataFrame, features: DataFrame, width: int, instrument: str = "series", y: str = "ret"
) -> DataFrame:
    """Least squares with intercept of ``y`` on ``x`` for every instrument.

    Gives ``(instrument, weights)`` with the intercept first; the weights are
    NULL where the system is singular (a condition above 1 / ``SINGULAR`` after scaling) or
    has too few periods; periods without all features are left out, and so are returns that are
    NULL or not finite.  The triangular factor of an instrument's rows is built in the tasks and
    merged in one shuffle, so the error grows with the condition of the features and not with its square.
    The features are centred and scaled by their overall moments first, which keeps squares,
    roots and values of one factor apart numerically.
    """
    # One row per period, so the table is bounded by the calendar; it is used twice.
    complete = features.select("date", "x").filter(F.forall("x", lambda v: v.isNotNull() & _finite(v)))
    features = cut_lineage(complete)
    returns = returns.filter(F.col(y).isNotNull() & _finite(F.col(y)))
    moments = features.agg(
        *[F.avg(F.col("x")[j]) for j in range(width)],
        *[F.stddev_pop(F.col("x")[j]) for j in range(width)],
    ).first()
    if moments[0] is None:
        return returns.select(instrument).distinct().withColumn("weights", F.lit(None).cast("array<double>"))
    mean = np.array(moments[:width])
    sd = np.array([s if s else 1.0 for s in moments[width:]])

    joined = lookup_join(returns.select(instrument, "date", y), features, ["date"], "inner")
    scaled = [
        (F.col("x")[j] - F.lit(float(mean[j]))) / F.lit(float(sd[j])) for j in range(width)
    ]
    size = width + 1
    # Intercept, features and response in one array; the last column of the factor belongs to y.
    factors = grouped_triangle(joined, F.array(F.lit(1.0), *scaled, F.col(y)), size + 1, instrument)

    def solve(factor: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for values, rows in zip(factor, n, strict=True):
            r = np.asarray(values, dtype=float).reshape(-1, size + 1)
            if rows < size:
                out.append(None)
                continue
            upper, moment = r[:size, :size], r[:size, size]
            spectrum = np.linalg.svd(upper, compute_uv=False)
            if not spectrum[-1] > SINGULAR * spectrum[0]:
                out.append(None)
                continue
            beta = np.linalg.solve(upper, moment)
            slopes = beta[1:] / sd
            out.append(np.concatenate([[beta[0] - slopes @ mean], slopes]))
        return pd.Series(out, dtype=object)

    return factors.select(instrument, F.pandas_udf(solve, "array<double>")("factor", "n").alias("weights"))


def fitted(returns: DataFrame, features: DataFrame, weights: DataFrame, instrument: str = "series") -> DataFrame:
    """Intercept plus weighted features, per instrument and period."""
    joined = lookup_join(returns, features.select("date", "x"), ["date"], "inner")
    joined = lookup_join(joined, weights.select(instrument, "weights"), [instrument], "inner")
    value = instrument_return(F.col("weights"), F.col("x"))
    return joined.withColumn("fitted", value).drop("x", "weights")


def instrument_return(weights, x):
    return F.get(weights, F.lit(0)) + arrays.dot(F.slice(weights, F.lit(2), F.size(x)), x)


def portfolio_weights(weights: DataFrame) -> list[float]:
    """Sum of the weight vectors, 1 + 3m numbers.

    The return of a portfolio is linear in the weights, so a trial needs only
    this sum and not every instrument.  An instrument whose weights are NULL
    would be missing from the sum, so it is an error, as is a portfolio of none.
    """
    instruments, solved = weights.agg(F.count("*"), F.count("weights")).first()
    if not solved or solved < instruments:
        raise ValueError(f"{instruments - solved} of {instruments} instruments have no weights")
    rows = (
        weights.select(F.posexplode("weights").alias("j", "w"))
        .groupBy("j")
        .agg(F.sum("w").alias("w"))
        .orderBy("j")
        .collect()  # one row per feature
    )
    return [r["w"] for r in rows]
