import numpy as np
import pytest
from pyspark.ml.recommendation import ALS

from tidemark.operators import implicit, recommend


def counts(spark):
    """Ids with gaps and signs, repeated pairs, zero and negative counts, a user with one row, an item of half of all rows."""
    rng = np.random.default_rng(3)
    rows = [(int(u) * 7 - 300, int(i) ** 3, float(r)) for u, i, r in zip(rng.integers(0, 90, 3000), rng.integers(0, 60, 3000), rng.integers(-1, 9, 3000), strict=True)]
    rows += [(u * 7 - 300, -5, 2.0) for u in range(90)] * 30 + [(2**31 - 1, 8, 3.0), (-(2**31), 27, 0.0)]
    return spark.createDataFrame(rows, "user long, item long, rating double").repartition(3)


def table(factors):
    rows = sorted(factors.collect(), key=lambda r: r.id)
    return [r.id for r in rows], np.array([r.features for r in rows])


@pytest.mark.parametrize("limits", [{}, {"SMALL": 500, "HELD": 200, "PIECE": 64}])
def test_equals_the_library(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(implicit, name, value)
    df = counts(spark)
    got = recommend.fit_implicit(df, rank=4, iterations=3, seed=5)
    columns = {"userCol": "user", "itemCol": "item", "ratingCol": "rating"}
    want = ALS(rank=4, maxIter=3, regParam=0.01, alpha=50.0, implicitPrefs=True, seed=5, **columns).fit(df)
    for mine, theirs in ((got.userFactors, want.userFactors), (got.itemFactors, want.itemFactors)):
        (ids, rows), (want_ids, want_rows) = table(mine), table(theirs)
        assert ids == want_ids
        np.testing.assert_allclose(rows, want_rows, rtol=1e-3, atol=1e-5)


def test_a_half_step_sends_no_copies(spark, monkeypatch):
    monkeypatch.setattr(implicit, "SMALL", 500)
    monkeypatch.setattr(implicit, "HELD", 200)
    steps, solve = [], implicit.half_step
    monkeypatch.setattr(implicit, "half_step", lambda *args: steps.append(solve(*args)) or steps[-1])
    model = recommend.fit_implicit(counts(spark), rank=4, iterations=1)
    assert len(steps) == 2 and all("Exchange" not in s._jdf.queryExecution().toString() for s in steps)
    for side in model:
        (path,) = {file.rpartition("/band=")[0] for file in side.inputFiles()}
        data = implicit.parts_of(path, ["band", "data"])
        assert sum(len(v.as_py()) for v in data.column("data")) == side.count() * 4 * 4
        assert len(set(data.column("band").to_pylist())) > 1


@pytest.mark.parametrize("row", [(None, 1, 1.0), (1, 2**31, 1.0), (1, 1, None), (1, 1, float("nan"))])
def test_bad_rows_are_errors(spark, row):
    df = spark.createDataFrame([row, (1, 1, 1.0)], "user long, item long, rating double")
    with pytest.raises(Exception):
        recommend.fit_implicit(df, iterations=1)
