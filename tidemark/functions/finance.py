"""Scalar formulas used by the risk and density jobs."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def normal_pdf(x: Column, mean: Column, sd: Column) -> Column:
    """Gaussian density, evaluated through its logarithm."""
    z = (x - mean) / sd
    return F.exp(F.lit(-0.5) * z * z - F.log(sd) - F.lit(0.5) * F.log(F.lit(2.0) * F.pi()))


def kupiec_statistic(total: Column, failures: Column, level: float) -> Column:
    """Likelihood ratio of the proportion-of-failures test, with 0 * ln 0 = 0."""
    good = (total - failures).cast("double")
    bad = failures.cast("double")
    ratio = bad / total
    expected = good * F.log1p(F.lit(-level)) + bad * F.log(F.lit(level))
    seen_good = F.when(good == 0, F.lit(0.0)).otherwise(good * F.log1p(-ratio))
    seen_bad = F.when(bad == 0, F.lit(0.0)).otherwise(bad * F.log(ratio))
    return F.lit(-2.0) * (expected - (seen_good + seen_bad))


@F.pandas_udf(T.DoubleType())
def chi_square1_tail(statistic: pd.Series) -> pd.Series:
    """P(X > statistic) for a chi-square variable with one degree of freedom."""
    return statistic.map(lambda v: math.erfc(math.sqrt(max(v, 0.0) / 2.0)))
