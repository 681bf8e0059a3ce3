from datetime import date, timedelta
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import regression, timeseries, triangular


def history(spark, rows, series="s"):
    return spark.createDataFrame([(series, date.fromisoformat(d), float(v)) for d, v in rows], "series string, date date, value double")


def rows(df):
    return [(str(r.date), r.value) for r in df.orderBy("date").collect()]


def test_trim_adds_both_ends(spark):
    h = history(spark, [("2014-01-01", 1), ("2014-01-07", 2), ("2014-01-08", 3), ("2014-01-20", 4)])
    assert rows(timeseries.trim_to_region(h, "2014-01-06", "2014-01-10")) == [
        ("2014-01-06", 2.0),
        ("2014-01-07", 2.0),
        ("2014-01-08", 3.0),
        ("2014-01-10", 3.0),
    ]
    assert rows(timeseries.trim_to_region(h, "2014-01-07", "2014-01-07")) == [("2014-01-07", 2.0)]
    assert rows(timeseries.trim_to_region(h, "2015-01-01", "2015-02-01")) == []


def test_fill_uses_last_known_value_on_weekdays_only(spark):
    # The 4th and 5th of January 2014 are a weekend; a date is given twice.
    h = history(spark, [("2014-01-02", 1), ("2014-01-04", 5), ("2014-01-07", 7), ("2014-01-07", 6)])
    assert rows(timeseries.fill_weekdays(h, "2014-01-01", "2014-01-09")) == [
        ("2014-01-01", 1.0),
        ("2014-01-02", 1.0),
        ("2014-01-03", 1.0),
        ("2014-01-06", 5.0),
        ("2014-01-07", 7.0),
        ("2014-01-08", 7.0),
    ]


def test_fill_from_a_saturday_and_with_values_before_the_start(spark):
    h = history(spark, [("2013-12-30", 1), ("2014-01-02", 2), ("2014-03-01", 9)])
    assert rows(timeseries.fill_weekdays(h, "2014-01-04", "2014-01-08")) == [("2014-01-06", 2.0), ("2014-01-07", 2.0)]


def test_two_week_returns_need_ten_rows(spark):
    days = [(date(2014, 1, 1) + timedelta(i), i * i) for i in range(10)]
    nine, ten = [(str(d), v) for d, v in days[:9]], [(str(d), v) for d, v in days]
    assert timeseries.two_week_returns(history(spark, nine)).count() == 0
    got = timeseries.two_week_returns(history(spark, ten)).collect()
    assert [(str(r.date), r.ret) for r in got] == [("2014-01-01", 81.0)]


def test_min_history_counts_raw_rows(spark):
    h = history(spark, [("2014-01-01", 1), ("2014-01-01", 2), ("2014-01-02", 3)]).unionByName(history(spark, [("2014-01-01", 1)], "t"))
    assert {r.series for r in timeseries.min_history(h, 3).collect()} == {"s"}


def test_many_copies_of_one_day_do_not_reach_a_window(spark):
    hot = spark.range(50_000).selectExpr("'s' AS series", "DATE '2014-01-06' AS date", "cast(id % 7 AS double) AS value")
    got = timeseries.fill_weekdays(hot, "2014-01-06", "2014-01-08")
    assert rows(got) == [("2014-01-06", 6.0), ("2014-01-07", 6.0)]


def panel(spark, y, x):
    days = [date(2014, 1, 1) + timedelta(i) for i in range(len(x))]
    returns = spark.createDataFrame(
        [(s, d, float(v)) for s, col in y.items() for d, v in zip(days, col)], "series string, date date, ret double"
    )
    features = spark.createDataFrame([(d, [float(v) for v in row]) for d, row in zip(days, x)], "date date, x array<double>")
    return returns, features


def test_ols_equals_least_squares(spark):
    gen = np.random.default_rng(1)
    f = gen.normal(0, 50, (200, 2))
    x = np.hstack([np.sign(f) * f * f, np.sign(f) * np.sqrt(np.abs(f)), f])
    y = {"a": gen.normal(size=200) + x @ gen.normal(size=6) + 3, "b": gen.normal(size=200)}
    got = {r.series: r.weights for r in regression.ols(*panel(spark, y, x), 6).collect()}
    for name, column in y.items():
        want = np.linalg.lstsq(np.hstack([np.ones((200, 1)), x]), column, rcond=None)[0]
        np.testing.assert_allclose(got[name], want, rtol=1e-7, atol=1e-9)


def test_ols_leaves_out_periods_without_all_features(spark):
    gen = np.random.default_rng(2)
    x, y = gen.normal(size=(40, 2)), gen.normal(size=40)
    returns, features = panel(spark, {"a": y}, x)
    holed = features.selectExpr("date", "CASE WHEN date = DATE '2014-01-03' THEN array(x[0], NULL) ELSE x END AS x")
    keep = np.arange(40) != 2
    want = np.linalg.lstsq(np.hstack([np.ones((39, 1)), x[keep]]), y[keep], rcond=None)[0]
    np.testing.assert_allclose(regression.ols(returns, holed, 2).first().weights, want, rtol=1e-8)


def test_ols_gives_null_when_not_solvable(spark):
    x = np.array([[1.0, 2.0], [2.0, 4.0], [3.0, 6.0], [4.0, 8.0]])
    assert [r.weights for r in regression.ols(*panel(spark, {"a": np.arange(4.0)}, x), 2).collect()] == [None]
    short = np.array([[1.0, 2.0], [2.0, 5.0]])
    assert [r.weights for r in regression.ols(*panel(spark, {"a": np.arange(2.0)}, short), 2).collect()] == [None]


def exact_weights(x, y):
    """Least squares with intercept in fractions."""
    rows = [[Fraction(1), *map(Fraction, map(float, row))] for row in x]
    size = len(rows[0])
    system = [[sum(r[i] * r[j] for r in rows) for j in range(size)] + [sum(r[i] * Fraction(float(v)) for r, v in zip(rows, y))] for i in range(size)]
    for k in range(size):
        system[k] = [v / system[k][k] for v in system[k]]
        for i in range(size):
            if i != k:
                system[i] = [a - system[i][k] * b for a, b in zip(system[i], system[k])]
    return [float(row[-1]) for row in system]


@pytest.mark.parametrize("apart, noise", [(1e-7, 1e-6), (1e-5, 1.0)])
def test_ols_of_nearly_equal_factors(spark, apart, noise):
    # The products of such columns are singular in doubles, the columns are not.
    gen = np.random.default_rng(4)
    a = gen.normal(size=120)
    x = np.column_stack([a, a + apart * gen.normal(size=120)])
    y = 2 * x[:, 0] - x[:, 1] + noise * gen.normal(size=120)
    got, want = regression.ols(*panel(spark, {"a": y}, x), 2).first().weights, exact_weights(x, y)
    assert np.linalg.norm(np.subtract(got, want)) < 1e-8 * np.linalg.norm(want)


def test_triangles_do_not_depend_on_partitions(spark):
    table = np.random.default_rng(5).normal(size=(300, 3))
    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i % 9}", [float(v) for v in row]) for i, row in enumerate(table)] + [(None, [0.0] * 3), ("hot", None)], "key string, v array<double>")
    for parts in (1, 7):
        got = {r.key: (np.array(r.factor).reshape(-1, 3), r.n) for r in triangular.grouped_triangle(rows.repartition(parts), F.col("v"), 3, "key").collect()}
        assert set(got) == {"hot", "k0", "k3", "k6"}
        for key, (factor, n) in got.items():
            part = np.array([row for i, row in enumerate(table) if ("hot" if i % 3 else f"k{i % 9}") == key])
            assert n == len(part)
            np.testing.assert_allclose(factor.T @ factor, part.T @ part, rtol=1e-10, atol=1e-10)
    assert triangular.grouped_triangle(rows.limit(0), F.col("v"), 3, "key").count() == 0


def test_least_squares_shuffle_the_factors_once(spark):
    rows = spark.range(10).selectExpr("id AS key", "array(1.0D, id * 1.0D) AS v")
    plan = triangular.grouped_triangle(rows, F.col("v"), 2, "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_root_of_a_semidefinite_covariance():
    model = regression.FactorModel(["a", "b"], np.zeros(2), np.array([[1.0, 1.0], [1.0, 1.0]]))
    root = model.root()
    np.testing.assert_allclose(root @ root.T, model.covariance, atol=1e-12)
