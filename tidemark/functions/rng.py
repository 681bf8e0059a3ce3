"""Counter-based random numbers.

A draw depends only on (seed, row id, counter).  It is the same however the
rows are partitioned and when a lost task is run again, and any SQL engine with
md5 can repeat it.  One digest yields two 52-bit uniforms or four 32-bit ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

TWO_52 = 4503599627370496.0
TWO_32 = 4294967296.0


def digest(seed: int, row_id: Column, counter: Column | int) -> Column:
    counter = F.lit(counter) if isinstance(counter, int) else counter
    return F.md5(F.concat_ws(":", F.lit(str(seed)), row_id.cast("string"), counter.cast("string")))


def _fraction(hexdigits: Column, scale: float) -> Column:
    number = F.conv(hexdigits, 16, 10).cast("bigint").cast("double")
    return (number + 0.5) / F.lit(scale)


def uniform(seed: int, row_id: Column, counter: Column | int = 0) -> Column:
    """Uniform in (0, 1) with 52 bits."""
    return _fraction(F.substring(digest(seed, row_id, counter), 1, 13), TWO_52)


def normal_pair(seed: int, row_id: Column, counter: int) -> tuple[Column, Column]:
    """Two independent standard normals from one digest (Box-Muller)."""
    d = digest(seed, row_id, counter)
    u1 = _fraction(F.substring(d, 1, 13), TWO_52)
    u2 = _fraction(F.substring(d, 14, 13), TWO_52)
    radius = F.sqrt(F.lit(-2.0) * F.log(u1))
    angle = F.lit(2.0) * F.pi() * u2
    return radius * F.cos(angle), radius * F.sin(angle)


def normals(seed: int, row_id: Column, count: int) -> list[Column]:
    out: list[Column] = []
    for counter in range((count + 1) // 2):
        out.extend(normal_pair(seed, row_id, counter))
    return out[:count]


def lanes(d: Column) -> list[Column]:
    """The four 32-bit parts of a digest, as fixed-width hexadecimal text."""
    return [F.substring(d, 1 + 8 * i, 8) for i in range(4)]


def poisson1_cuts() -> list[str]:
    """Cumulative probabilities of Poisson(1) as 32-bit hexadecimal bounds."""
    cuts, term, total, k = [], math.exp(-1.0), 0.0, 0
    while True:
        total += term
        bound = math.ceil(total * TWO_32 - 0.5)
        if bound >= TWO_32:
            return cuts
        cuts.append(f"{bound:08x}")
        k += 1
        term /= k


def poisson1(lane: Column) -> Column:
    """Poisson(1) count by inverse distribution function.

    Text of equal width compares as its number does, so no conversion is needed.
    """
    cuts = poisson1_cuts()
    out = F.when(lane < F.lit(cuts[0]), F.lit(0))
    for k, cut in enumerate(cuts[1:], start=1):
        out = out.when(lane < F.lit(cut), F.lit(k))
    return out.otherwise(F.lit(len(cuts)))
