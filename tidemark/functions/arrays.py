"""Expressions over ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def doubles(c: Column) -> Column:
    return c.cast("array<double>")


def all_but_last(a: Column) -> Column:
    return F.slice(a, F.lit(1), F.size(a) - 1)


def last(a: Column) -> Column:
    return F.element_at(a, -1)


def dot(a: Column, b: Column) -> Column:
    """Inner product; the arrays must have the same length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, v: s + v))


def scale(a: Column, factors: Column) -> Column:
    """Element-wise product: one row of a matrix times a diagonal matrix."""
    return F.zip_with(a, factors, lambda x, s: x * s)


def normalized(a: Column) -> Column:
    """The array divided by its length; a zero array becomes NaN throughout."""
    # One-element arrays bind the array and its length, so each is computed once.
    def divide(x: Column) -> Column:
        by_length = F.transform(
            F.array(norm(x)),
            lambda n: F.transform(x, lambda v: F.when(n == 0.0, F.lit(float("nan"))).otherwise(v / n)),
        )
        return F.get(by_length, F.lit(0))

    return F.get(F.transform(F.array(a), divide), F.lit(0))


def signed_square(x: Column) -> Column:
    return F.signum(x) * x * x


def signed_sqrt(x: Column) -> Column:
    return F.signum(x) * F.sqrt(F.abs(x))


def featurize(values: list[Column]) -> list[Column]:
    """Signed squares, then signed roots, then the values themselves."""
    return [signed_square(v) for v in values] + [signed_sqrt(v) for v in values] + list(values)
