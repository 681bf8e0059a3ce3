"""Monte Carlo value at risk, its uncertainty and its backtest."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions import rng
from tidemark.functions.arrays import signed_sqrt, signed_square
from tidemark.functions.finance import chi_square1_tail, kupiec_statistic
from tidemark.operators.orderstat import FEW_ROWS, Tail, lower_tail
from tidemark.operators.regression import FactorModel
from tidemark.session import cut_lineage

# Fixed value: the tail is a twentieth of the trials.
TAIL_DIVISOR = 20


def trial_ids(spark: SparkSession, trials: int, partitions: int) -> DataFrame:
    """Ids of all the trials; the number does not depend on the partitions."""
    return spark.range(0, trials, 1, partitions).withColumnRenamed("id", "trial_id")


def factor_draws(ids: DataFrame, id_column: str, model: FactorModel, seed: int) -> DataFrame:
    """Correlated normal factor returns of each trial, columns ``f0`` .. ``f{m-1}``."""
    m = len(model.factors)
    z = {f"_z{j}": c for j, c in enumerate(rng.normals(seed, F.col(id_column), m))}
    root = model.root()
    draws = {}
    for i in range(m):
        value = F.lit(float(model.means[i]))
        for j in range(m):
            if root[i, j] != 0.0:
                value = value + F.lit(float(root[i, j])) * F.col(f"_z{j}")
        draws[f"f{i}"] = value
    return ids.withColumns(z).withColumns(draws).drop(*z)


def trial_returns(draws: DataFrame, weights: list[float]) -> DataFrame:
    """Add ``ret``: the summed weights applied to the features of each draw."""
    m = (len(weights) - 1) // 3
    value = F.lit(float(weights[0]))
    for block, transform in enumerate((signed_square, signed_sqrt, lambda c: c)):
        for i in range(m):
            value = value + F.lit(float(weights[1 + block * m + i])) * transform(F.col(f"f{i}"))
    return draws.withColumn("ret", value)


def var_cvar(trials: DataFrame, column: str = "ret", divisor: int = TAIL_DIVISOR) -> DataFrame:
    """One row: number of trials, tail size, value at risk and its tail mean."""
    tail = lower_tail(trials, column, divisor)
    return tail_frame(trials.sparkSession, tail)


def tail_frame(spark: SparkSession, tail: Tail | None) -> DataFrame:
    one = spark.range(1 if tail else 0)
    values = (tail.rows, tail.rank, tail.value, tail.mean) if tail else (0, 0, 0.0, 0.0)
    return one.select(
        F.lit(values[0]).cast("bigint").alias("trials"),
        F.lit(values[1]).cast("bigint").alias("tail_size"),
        F.lit(float(values[2])).alias("var"),
        F.lit(float(values[3])).alias("cvar"),
    )


def _with_bucket(samples: DataFrame, edges: list[float]) -> DataFrame:
    """Add ``b``, the place of ``x`` among the edges.

    Odd numbers are the edges themselves, even ones the open spans between, so
    that a value held by many rows has a bucket of its own once it is an edge.
    """
    if not edges:
        return samples.withColumn("b", F.lit(0))
    splits = [-math.inf, *edges, math.inf]
    found = Bucketizer(splits=splits, inputCol="x", outputCol="_i").transform(samples)
    upto = F.col("_i").cast("int")  # edges at or below x
    highest = F.get(F.array(*map(F.lit, edges)), upto - 1)
    place = 2 * upto - F.when(F.col("x") == highest, 1).otherwise(0)
    return found.withColumn("b", place).drop("_i")


def _quantiles(samples: DataFrame, shares: list[float]) -> list[float]:
    found = samples.agg(F.percentile_approx("x", F.array(*map(F.lit, shares)), 10_000)).first()[0]
    return sorted(set(found or []))


#: Weights that a task holds at a time.
CELLS = 1 << 20


def _sums(samples: DataFrame, group: str, resamples: int, seed: int, gate: str | None = None, ends: list[int] | None = None) -> DataFrame:
    """``(r, group, n, s)``: summed weights and weighted values per resample and group.

    The digests of a row's id hold its weights in all resamples, so a slice of rows
    is one matrix of weights in its task, and only sums per group leave the task.
    With a gate, a row counts in resample r where its gate equals ``ends[r]``.
    """
    blocks = (resamples + 3) // 4
    digests = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda block: rng.digest(seed, F.col("id"), block))
    rows = samples.select("x", group, *([gate] if gate else []), F.unhex(F.array_join(digests, "")).alias("_d"))
    # The group may be the value itself.
    rows = rows.toDF("x", "g", *(["gate"] if gate else []), "d")
    cuts = np.array([int(c, 16) for c in rng.poisson1_cuts()], dtype=np.uint32)
    wanted = np.array(ends, dtype=np.int64) if gate else None
    step = max(CELLS // resamples, 1)

    def merged(keys, n, s):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(n[order], first), np.add.reduceat(s[order], first)

    def reduce(batches):
        held = None

        def rows_of(keys, n, s):
            g, r = np.nonzero(n)
            return pa.record_batch([pa.array(r.astype(np.int32)), pa.array(keys[g]), pa.array(n[g, r]), pa.array(s[g, r])], names=["r", group, "n", "s"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            digest = batch.column("d").cast(pa.binary(16 * blocks))
            lanes = np.frombuffer(digest.buffers()[1], dtype=">u4").reshape(-1, 4 * blocks)[digest.offset :]
            x = batch.column("x").to_numpy(zero_copy_only=False)
            g = batch.column("g").to_numpy(zero_copy_only=False)
            for lo in range(0, batch.num_rows, step):
                part = slice(lo, min(lo + step, batch.num_rows))
                w = np.searchsorted(cuts, lanes[part, :resamples].astype(np.uint32), side="right").astype(np.int64)
                if gate:
                    w *= batch.column("gate").to_numpy(zero_copy_only=False)[part, None] == wanted
                with np.errstate(invalid="ignore"):
                    s = np.where(w > 0, w * x[part, None], 0.0)
                found = merged(g[part], w, s)
                held = merged(*map(np.concatenate, zip(held, found, strict=True))) if held else found
                if held[1].size > 4 * CELLS:
                    yield rows_of(*held)
                    held = None
        if held:
            yield rows_of(*held)

    kind = samples.schema[group].dataType.simpleString()
    sums = rows.mapInArrow(reduce, f"r int, {group} {kind}, n bigint, s double")
    return sums.groupBy("r", group).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


CARRIED = ["r", "trials", "k", "base_n", "base_s"]


def _crossing(sums: DataFrame, place: str) -> DataFrame:
    """Of rows ``(carried, place, n, s)``, the one per resample where the tail ends.

    ``base_n`` and ``base_s`` of the result count everything below that row.
    """
    upto = Window.partitionBy("r").orderBy(place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sums.withColumns({"_n": F.sum("n").over(upto), "_s": F.sum("s").over(upto)})
    below_n, below_s = F.col("base_n") + F.col("_n") - F.col("n"), F.col("base_s") + F.col("_s") - F.col("s")
    reached = running.filter((below_n < F.col("k")) & (below_n + F.col("n") >= F.col("k")))
    return reached.select("r", "trials", "k", below_n.alias("base_n"), below_s.alias("base_s"), place, "n")


def bootstrap_tails(
    trials: DataFrame,
    row_id: str,
    column: str = "ret",
    resamples: int = 100,
    seed: int = 1,
    divisor: int = TAIL_DIVISOR,
    buckets: int = 128,
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """Value at risk and tail mean of every resample: ``(r, trials, tail_size, var, cvar)``.

    All resamples run together.  An aggregate sums the weights per resample and
    value bucket and shows in which bucket the tail of each resample ends; only
    rows of these buckets are looked at again.  Buckets are split further until
    what a resample has left to rank is small, with equal values merged.
    """
    samples = trials.select(F.col(row_id).alias("id"), F.col(column).cast("double").alias("x"))
    samples = samples.filter(F.col("x").isNotNull() & ~F.isnan("x"))

    # The edges follow the sample, up to somewhat beyond the end of the tail.
    edges = _quantiles(samples, [1.5 / divisor * (i + 1) / buckets for i in range(buckets)])
    placed = _with_bucket(samples, edges)
    sums = _sums(placed, "b", resamples, seed)
    whole = F.sum("n").over(Window.partitionBy("r"))
    first = sums.withColumns({"trials": whole, "base_n": F.lit(0).cast("bigint"), "base_s": F.lit(0.0)})
    first = first.withColumn("k", F.greatest(F.floor(F.col("trials") / divisor), F.lit(1)))
    # One row per resample at most, here and below: the number is a parameter.
    ended = cut_lineage(_crossing(first, "b"))

    while True:
        found = ended.select("r", "b", "n").collect()
        ends = [-1] * resamples
        for row in found:
            ends[row["r"]] = row["b"]
        inside = placed.filter(F.col("b").isin(sorted(set(ends))))
        if max((row["n"] for row in found if row["b"] % 2 == 0), default=0) <= few_rows:
            break
        finer = _quantiles(inside, [(i + 1) / (buckets + 1) for i in range(buckets)])
        finer = sorted(set(edges) | set(finer))
        if len(finer) == len(edges):
            break
        edges = finer
        split = _with_bucket(inside.withColumnRenamed("b", "p"), edges)
        sums = _sums(split, "b", resamples, seed, "p", ends)
        ended = cut_lineage(_crossing(sums.join(F.broadcast(ended.select(*CARRIED)), "r"), "b"))
        placed = split.drop("p")

    left = _sums(inside, "x", resamples, seed, "b", ends).join(F.broadcast(ended.select(*CARRIED)), "r")
    final = _crossing(left.withColumn("s", F.col("n") * F.col("x")), "x")
    rest = F.col("k") - F.col("base_n")
    return final.select(
        "r",
        "trials",
        F.col("k").alias("tail_size"),
        F.col("x").alias("var"),
        ((F.col("base_s") + rest * F.col("x")) / F.col("k")).alias("cvar"),
    )


def interval_positions(resamples: int, p_value: float) -> tuple[int, int]:
    """Positions of the bounds among the sorted statistics, kept inside them."""
    lower = int(resamples * p_value / 2 - 1)
    upper = math.ceil(resamples * (1 - p_value / 2))
    return max(lower, 0), min(upper, resamples - 1)


def confidence_interval(stats: DataFrame, column: str, resamples: int, p_value: float = 0.05) -> DataFrame:
    """Bounds of the statistic over the resamples (a bounded number of rows)."""
    lower, upper = interval_positions(resamples, p_value)
    ordered = F.sort_array(F.collect_list(column))
    return stats.agg(ordered.alias("v")).select(
        F.lit(column).alias("statistic"),
        F.get("v", F.lit(lower)).alias("lower"),
        F.get("v", F.lit(upper)).alias("upper"),
    )


def failures(returns: DataFrame, value_at_risk: Column) -> DataFrame:
    """Periods, and those whose summed return is strictly below the value at risk."""
    summed = returns.groupBy("date").agg(F.sum("ret").alias("total"))
    return summed.agg(
        F.count("*").alias("periods"),
        F.count_if(F.col("total") < value_at_risk).alias("failures"),
    )


def kupiec(counts: DataFrame, level: float = 0.05) -> DataFrame:
    """Add the test statistic and its p-value to ``(periods, failures)``."""
    out = counts.withColumn("statistic", kupiec_statistic(F.col("periods"), F.col("failures"), level))
    return out.withColumn("p_value", chi_square1_tail(F.col("statistic")))
