import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import rng
from tidemark.operators import density, orderstat, risk


def frame(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id long, x double")


@pytest.mark.parametrize("n, k", [(1, 1), (19, 1), (20, 1), (30, 1), (39, 1), (40, 2), (400, 20)])
def test_tail_size_and_value(spark, n, k):
    values = np.random.default_rng(n).permutation(n).astype(float)
    tail = orderstat.lower_tail(frame(spark, values), "x")
    assert (tail.rank, tail.value) == (k, k - 1.0)
    assert tail.mean == pytest.approx(np.sort(values)[:k].mean())


@pytest.mark.parametrize("shape", ["spread", "one hot value", "all equal", "hot at the cut"])
def test_narrowing_is_exact(spark, shape):
    gen = np.random.default_rng(3)
    values = gen.normal(size=30_000)
    if shape == "one hot value":
        values[:10_000] = -9.0
    elif shape == "all equal":
        values[:] = 2.5
    elif shape == "hot at the cut":
        values = np.sort(values)
        values[1000:12_000] = values[1000]
    tail = orderstat.lower_tail(frame(spark, values), "x", few_rows=20)
    ordered = np.sort(values)
    assert tail.rank == 1500
    assert tail.value == ordered[1499]
    assert tail.below_rows == (values < ordered[1499]).sum()
    assert tail.mean == pytest.approx(ordered[:1500].mean())


def test_k_smallest_keeps_copies(spark):
    got = orderstat.k_smallest(frame(spark, [3, 1, 1, 1, 2]), "x", 2)
    assert [r.x for r in got.collect()] == [1.0, 1.0]
    assert orderstat.k_smallest(frame(spark, [3, 1]), "x", 9).count() == 2
    assert orderstat.k_smallest(frame(spark, [1]).limit(0), "x", 9).count() == 0


def test_var_of_nothing(spark):
    assert risk.var_cvar(frame(spark, [1]).limit(0), "x").count() == 0


def brute_bootstrap(values, resamples, seed, divisor=20):
    import hashlib

    cuts = rng.poisson1_cuts()
    out = []
    for r in range(resamples):
        weights = []
        for i in range(len(values)):
            lane = hashlib.md5(f"{seed}:{i}:{r // 4}".encode()).hexdigest()[8 * (r % 4) : 8 * (r % 4) + 8]
            weights.append(sum(lane >= c for c in cuts))
        sample = np.sort(np.repeat(values, weights))
        k = max(len(sample) // divisor, 1)
        out.append((r, len(sample), k, sample[k - 1], sample[:k].mean()))
    return out


@pytest.mark.parametrize("few_rows", [100_000, 3])
@pytest.mark.parametrize("kind", ["normal", "hot"])
def test_bootstrap_equals_explicit_resampling(spark, kind, few_rows):
    values = np.round(np.random.default_rng(5).normal(size=500), 3)
    if kind == "hot":
        values[:200] = -1.0
    got = risk.bootstrap_tails(frame(spark, values), "id", "x", 10, seed=4, buckets=7, few_rows=few_rows).orderBy("r").collect()
    for g, w in zip(got, brute_bootstrap(values, 10, 4), strict=True):
        assert tuple(g)[:4] == w[:4]
        assert g.cvar == pytest.approx(w[4])


def test_bootstrap_when_most_rows_are_equal(spark):
    got = risk.bootstrap_tails(frame(spark, [7.0] * 300), "id", "x", 5).collect()
    assert {(r["var"], r["cvar"]) for r in got} == {(7.0, 7.0)}


def test_weights_follow_poisson(spark):
    w = rng.poisson1(rng.lanes(rng.digest(1, F.col("id"), 0))[2])
    got = spark.range(50_000).select(w.alias("w")).agg(F.avg("w"), F.var_samp("w"), F.max("w")).first()
    assert got[0] == pytest.approx(1.0, abs=0.02)
    assert got[1] == pytest.approx(1.0, abs=0.03)
    assert got[2] >= 5


def test_draws_do_not_depend_on_partitions(spark):
    def draw(parts):
        z = rng.normals(9, F.col("id"), 3)
        return spark.range(0, 500, 1, parts).select("id", *z).orderBy("id").collect()

    assert draw(1) == draw(7)


def test_interval_positions():
    assert risk.interval_positions(100, 0.05) == (1, 98)
    assert risk.interval_positions(40, 0.05) == (0, 39)
    assert risk.interval_positions(39, 0.05) == (0, 38)
    assert risk.interval_positions(1, 0.05) == (0, 0)


@pytest.mark.parametrize("trials, partitions", [(1003, 10), (10, 16), (0, 4)])
def test_all_trials_whatever_the_partitions(spark, trials, partitions):
    assert risk.trial_ids(spark, trials, partitions).count() == trials



def counts(spark, total, failed):
    return spark.createDataFrame([(total, failed)], "periods long, failures long")


def test_kupiec(spark):
    row = risk.kupiec(counts(spark, 1000, 50)).first()
    assert row.statistic == pytest.approx(0.0, abs=1e-9)
    assert row.p_value == pytest.approx(1.0, abs=1e-4)
    none = risk.kupiec(counts(spark, 100, 0)).first()
    assert none.statistic == pytest.approx(-2 * 100 * math.log(0.95))
    every = risk.kupiec(counts(spark, 100, 100)).first()
    assert every.statistic == pytest.approx(-2 * 100 * math.log(0.05))
    at = spark.createDataFrame([(3.841458820694124,)], "s double")
    from tidemark.functions.finance import chi_square1_tail

    assert at.select(chi_square1_tail("s")).first()[0] == pytest.approx(0.05)


def test_failures_are_strictly_below(spark):
    rows = [("a", "d1", -5.0), ("b", "d1", 1.0), ("a", "d2", -2.0), ("b", "d2", -2.0), ("a", "d3", 9.0)]
    returns = spark.createDataFrame(rows, "series string, date string, ret double")
    assert tuple(risk.failures(returns, F.lit(-4.0)).first()) == (3, 0)
    assert tuple(risk.failures(returns, F.lit(-3.9)).first()) == (3, 2)


def test_density(spark):
    values = np.random.default_rng(2).normal(10, 3, 400)
    h = 1.06 * values.std() * 400**-0.2
    df = frame(spark, values)
    assert density.bandwidth(df, "x").first()[0] == pytest.approx(h)
    points = [4.0, 10.0, 15.5]
    want = [np.exp(-0.5 * ((p - values) / h) ** 2).mean() / (h * math.sqrt(2 * math.pi)) for p in points]
    got = [r.density for r in density.estimate(df, "x", points).orderBy("point").collect()]
    np.testing.assert_allclose(got, want)
    curve = density.density_curve(df, "x").orderBy("point").collect()
    assert len(curve) == 100
    assert curve[0].x == values.min()
    assert sum(r.density for r in curve) * (values.max() - values.min()) / 100 == pytest.approx(1.0, abs=0.05)


@pytest.mark.parametrize("shape", ["normal", "far apart", "hot"])
def test_density_equals_the_exact_sum(spark, shape):
    gen = np.random.default_rng(6)
    values = gen.normal(1e6, 2.0, 3000)
    if shape == "far apart":
        values[:3] = [-1e9, 0.0, 1e9]
    elif shape == "hot":
        values[:1500] = 1e6
    h = 1.06 * values.std() * len(values) ** -0.2
    at = np.concatenate([gen.uniform(values.min(), values.max(), 500), gen.choice(values, 1500), [values.max() + 50 * h]])
    points = spark.createDataFrame([(i, float(x)) for i, x in enumerate(at)], "point int, x double")
    got = [r.density for r in density.density_at(frame(spark, values), "x", points).orderBy("point").collect()]
    want = np.array([np.exp(-0.5 * ((p - values) / h) ** 2).mean() for p in at]) / (h * math.sqrt(2 * math.pi))
    assert np.abs(np.array(got) - want).max() < 1e-8 * want.max()
    assert density.boxes(frame(spark, values), "x", float(h)).count() < 60


def test_density_of_odd_points(spark):
    df = frame(spark, [1.0, 2.0, 4.0])
    points = spark.createDataFrame([(0, None), (1, math.nan), (2, math.inf), (3, 2.0), (3, 2.0), (None, 2.0)], "point int, x double")
    got = density.density_at(df, "x", points).collect()
    assert len(got) == 5
    assert [r.density for r in got if r.x is None or math.isnan(r.x)] == [None, None]
    assert [r.density for r in got if r.x == math.inf] == [0.0]
    assert len({r.density for r in got if r.x == 2.0}) == 1
    assert density.density_at(df, "x", points.limit(0)).count() == 0
    odd = [r.density for r in density.density_at(frame(spark, [1.0, math.inf]), "x", points).collect()]
    assert all(math.isnan(d) for d in odd)


def test_density_without_spread(spark):
    got = density.density_curve(frame(spark, [3.0] * 5), "x", 4).collect()
    assert [(r.x, r.density) for r in got] == [(3.0, None)] * 4
    assert density.density_curve(frame(spark, [1]).limit(0), "x").count() == 0
