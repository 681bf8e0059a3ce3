"""Gaussian kernel density."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


# Fixed value: the factor of the bandwidth rule.
RULE = 1.06


def _bandwidth(c: Column) -> Column:
    return F.lit(RULE) * F.stddev_pop(c) * F.pow(F.count(c).cast("double"), F.lit(-0.2))


def bandwidth(samples: DataFrame, column: str) -> DataFrame:
    """1.06 times the population deviation times n to the power -1/5."""
    return samples.agg(_bandwidth(F.col(column)).alias("bandwidth"))


#: Terms of the series of a box. Within half a bandwidth of its centre the terms left out sum
#: to less than 1e-15 of the kernel's height.
TERMS = 20
#: Boxes on either side of a point that it meets; the kernel is below 1e-19 beyond them.
REACH = 10


def _clean(samples: DataFrame, column: str) -> DataFrame:
    """The sample as doubles; NULL and NaN take no part, as in the tail measures."""
    x = F.col(column).cast("double")
    return samples.select(x.alias(column)).filter(F.col(column).isNotNull() & ~F.isnan(column))


def boxes(samples: DataFrame, column: str, h: float) -> DataFrame:
    """``(box, n, moments)``: the sample by boxes of one bandwidth.

    ``moments`` holds the sums of v^k / k! for k below ``TERMS``, with v the distance from the
    centre of the box in units of h times the root of two. One aggregate of
    sums; however large the sample, few boxes are in use.
    """
    x, v = F.col(column), F.col("_v")
    box = F.floor(x / F.lit(h)).cast("bigint")
    placed = samples.select(x, box.alias("box"))
    placed = placed.select("box", ((x - _centre(F.col("box"), h)) / F.lit(h * math.sqrt(2))).alias("_v"))
    # Powers of v are multiplied up column by column, each from the one before.
    powers = [f"_v{k}" for k in range(1, TERMS)]
    placed = placed.withColumn("_v1", v)
    for k in range(2, TERMS):
        placed = placed.withColumn(f"_v{k}", F.col(f"_v{k - 1}") * v / F.lit(float(k)))
    sums = placed.groupBy("box").agg(F.count("*").alias("n"), *[F.sum(p).alias(p) for p in powers])
    return sums.select("box", "n", F.array(F.col("n").cast("double"), *powers).alias("moments"))


def _centre(box: Column, h: float) -> Column:
    return (box.cast("double") + 0.5) * F.lit(h)


def _series(u: Column, moments: Column) -> Column:
    """Sum of ``moments[k]`` times the Hermite function of degree k at u."""
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("below"), F.exp(-u * u).alias("at"), F.lit(0.0).alias("k"))

    def step(acc: Column, moment: Column) -> Column:
        above = 2.0 * u * acc["at"] - 2.0 * acc["k"] * acc["below"]
        return F.struct(
            (acc["total"] + moment * acc["at"]).alias("total"), acc["at"].alias("below"), above.alias("at"), (acc["k"] + 1.0).alias("k")
        )

    return F.aggregate(moments, start, step, lambda acc: acc["total"])


def density_at(samples: DataFrame, column: str, points: DataFrame) -> DataFrame:
    """Density of the sample at the rows of ``points(point, x)``: ``(point, x, density)``.

    Samples are reduced to moments in boxes of one bandwidth, and a point
    meets the boxes within ``REACH`` of its own, so the cost is one pass over the sample
    and boxes near the points, not samples times points. The error is below 1e-15 of
    the kernel's height at its centre. Both sides are tables of any size. NULL and NaN
    samples take no part; a sample without spread gives NULL densities, an empty one
    no rows, a point that is NULL or NaN a NULL density; with infinite samples all densities are NaN.
    Equal rows of points give one row.
    """
    samples, c = _clean(samples, column), F.col(column)
    return _densities(samples, column, points, *samples.agg(_bandwidth(c), F.count(c)).first())


def _densities(samples: DataFrame, column: str, points: DataFrame, h: float | None, n: int) -> DataFrame:
    x = F.col("x")
    points = points.select("point", x.cast("double").alias("x"))
    if not h or not math.isfinite(h):
        return points.distinct().withColumn("density", F.lit(math.nan if h else None).cast("double")).filter(F.lit(n > 0))
    # Far beyond all samples a point meets no box.
    own = F.when(F.abs(x / F.lit(h)) < F.lit(2.0**62), F.floor(x / F.lit(h)).cast("bigint"))
    placed = points.withColumn("_own", own)
    near = placed.select("point", "x", "_own", F.explode_outer(F.sequence(F.col("_own") - REACH, F.col("_own") + REACH)).alias("box"))
    u = (x - _centre(F.col("box"), h)) / F.lit(h * math.sqrt(2))
    met = near.join(boxes(samples, column, h), "box", "left").withColumn("_height", _series(u, F.col("moments")))
    # A row of points that stands there twice meets every box twice.
    copies = F.greatest(F.count_if(F.col("box") == F.col("_own")), F.lit(1))
    sums = met.groupBy("point", "x").agg((F.coalesce(F.sum("_height"), F.lit(0.0)) / copies).alias("_height"))
    density = F.greatest("_height", F.lit(0.0)) / F.lit(n * h * math.sqrt(2 * math.pi))
    return sums.select("point", "x", F.when(x.isNotNull() & ~F.isnan(x), density).alias("density"))


def estimate(samples: DataFrame, column: str, points: list[float]) -> DataFrame:
    """Density of the sample at the given points: ``(point, x, density)``."""
    spark = samples.sparkSession
    return density_at(samples, column, spark.createDataFrame([(i, float(x)) for i, x in enumerate(points)], "point int, x double"))


# Fixed value: steps of a curve.
STEPS = 100


def density_curve(samples: DataFrame, column: str, steps: int = STEPS) -> DataFrame:
    """Density from the minimum up to, not including, the maximum, in equal steps."""
    samples, c = _clean(samples, column), F.col(column)
    h, n, low, high = samples.agg(_bandwidth(c), F.count(c), F.min(c), F.max(c)).first()
    if low is None:
        low = high = 0.0
    point = F.col("id").cast("int")
    points = samples.sparkSession.range(steps).select(point.alias("point"), (F.lit(low) + F.col("id") * F.lit(high - low) / F.lit(steps)).alias("x"))
    return _densities(samples, column, points, h, n)
