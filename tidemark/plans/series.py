"""Price histories, their returns, and the regression on factors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import regression, timeseries
from tidemark.plans.catalog import query, rounded
from tidemark.plans.inputs import (
    BRAND_DAILY,
    END,
    FACTORS,
    FACTOR_MATRIX,
    FACTOR_RETURNS,
    LONG_RETURNS,
    START,
    STOCK_RETURNS,
    brand_daily,
    factor_daily,
    filled_sql,
    trimmed_sql,
)
from tidemark.session import written


def factor_returns(spark, folder):
    return timeseries.series_returns(factor_daily(spark, folder), START, END)


def matrix(spark, folder):
    return timeseries.factor_matrix(factor_returns(spark, folder), FACTORS)


def stock_returns(spark, folder):
    return timeseries.series_returns(brand_daily(spark, folder), START, END)


def long_returns(spark, folder):
    """Of the series that the risk job keeps."""
    return timeseries.series_returns(timeseries.min_history(brand_daily(spark, folder)), START, END)


def dated(df, *columns, digits=6):
    shown = [F.col("date").cast("string").alias("date")]
    return df.select(*[c for c in df.columns if c not in ("date", *columns)], *shown, *[rounded(c, digits).alias(c) for c in columns])


@query(
    "min_history",
    f"""
    WITH {BRAND_DAILY}
    SELECT series, CAST(date AS VARCHAR) AS date, round(value, 6) AS value
    FROM brand_daily QUALIFY count(*) OVER (PARTITION BY series) >= 1310
    """,
)
def min_history(spark, folder):
    return dated(timeseries.min_history(brand_daily(spark, folder)), "value")


@query(
    "trim_to_region",
    f"""
    WITH {BRAND_DAILY}, {trimmed_sql('brand_daily', 'trimmed')}
    SELECT series, CAST(date AS VARCHAR) AS date, round(value, 6) AS value FROM trimmed
    """,
)
def trim_to_region(spark, folder):
    return dated(timeseries.trim_to_region(brand_daily(spark, folder), START, END), "value")


@query(
    "locf_weekdays",
    f"""
    WITH {BRAND_DAILY}, {trimmed_sql('brand_daily', 'trimmed')}, {filled_sql('trimmed', 'filled')}
    SELECT series, CAST(date AS VARCHAR) AS date, round(value, 6) AS value FROM filled
    """,
)
def locf_weekdays(spark, folder):
    trimmed = timeseries.trim_to_region(brand_daily(spark, folder), START, END)
    return dated(timeseries.fill_weekdays(trimmed, START, END), "value")


@query(
    "two_week_returns",
    f"WITH {STOCK_RETURNS} SELECT series, CAST(date AS VARCHAR) AS date, round(ret, 6) AS ret FROM stock_ret",
)
def two_week_returns(spark, folder):
    return dated(stock_returns(spark, folder), "ret")


@query(
    "aligned_returns",
    f"""
    WITH {STOCK_RETURNS}, {FACTOR_RETURNS},
    kept AS (SELECT series FROM brand_daily GROUP BY series HAVING count(*) >= 1310)
    SELECT series, 'stock' AS kind, CAST(date AS VARCHAR) AS date, round(ret, 6) AS ret
    FROM stock_ret WHERE series IN (SELECT series FROM kept)
    UNION ALL SELECT series, 'factor', CAST(date AS VARCHAR), round(ret, 6) FROM factor_ret
    """,
)
def aligned_returns(spark, folder):
    return dated(timeseries.aligned_returns(brand_daily(spark, folder), factor_daily(spark, folder), START, END), "ret")


@query(
    "factor_matrix",
    f"""
    WITH {FACTOR_MATRIX}
    SELECT CAST(date AS VARCHAR) AS date, round(a, 6) AS f_a, round(n, 6) AS f_n, round(r, 6) AS f_r, round(o, 6) AS f_o
    FROM matrix
    """,
)
def factor_matrix(spark, folder):
    out = matrix(spark, folder)
    return out.select(
        F.col("date").cast("string").alias("date"), *[rounded(f, 6).alias(f"f_{f.lower()}") for f in FACTORS]
    )


@query(
    "factor_means",
    f"""
    WITH {FACTOR_MATRIX}
    SELECT factor, round(mean, 4) AS mean FROM (
        SELECT unnest(['A', 'N', 'R', 'O']) AS factor, unnest([avg(a), avg(n), avg(r), avg(o)]) AS mean FROM matrix)
    """,
)
def factor_means(spark, folder):
    return regression.factor_means(matrix(spark, folder), FACTORS).withColumn("mean", rounded("mean", 4))


@query(
    "factor_covariance",
    f"""
    WITH {FACTOR_MATRIX},
    long AS (SELECT date, unnest(['A', 'N', 'R', 'O']) AS f, unnest([a, n, r, o]) AS x FROM matrix)
    SELECT p.f AS factor_a, q.f AS factor_b, round(covar_samp(p.x, q.x), 2) AS cov
    FROM long p JOIN long q ON p.date = q.date GROUP BY 1, 2
    """,
)
def factor_covariance(spark, folder):
    return regression.factor_covariance(matrix(spark, folder), FACTORS).withColumn("cov", rounded("cov", 2))


FEATURES = FACTOR_MATRIX + """,
    feat AS (
        SELECT date, list_concat(list_transform(v, lambda x: sign(x) * x * x),
                                 list_transform(v, lambda x: sign(x) * sqrt(abs(x))), v) AS x
        FROM (SELECT date, [a, n, r, o] AS v FROM matrix))
"""


@query(
    "featurize",
    f"""
    WITH {FEATURES}
    SELECT CAST(date AS VARCHAR) AS date, CAST(i - 1 AS INTEGER) AS j, round(CASE WHEN i <= 4 THEN x[i] / 1e6 ELSE x[i] END, 6) AS x
    FROM feat, range(1, 13) t(i)
    """,
)
def featurize(spark, folder):
    features = regression.factor_features(matrix(spark, folder), FACTORS)
    long = features.select(F.col("date").cast("string").alias("date"), F.posexplode("x").alias("j", "x"))
    # The squares are shown in millions.
    return long.withColumn("x", rounded(F.when(F.col("j") < 4, F.col("x") / 1e6).otherwise(F.col("x")), 6))


@query(
    "ols_simple",
    f"""
    WITH {LONG_RETURNS}, {FACTOR_MATRIX}
    SELECT series, round(regr_intercept(ret, a), 3) AS w0, round(regr_slope(ret, a), 6) AS w1
    FROM stock_ret JOIN matrix USING (date) GROUP BY series
    """,
)
def ols_simple(spark, folder):
    features = matrix(spark, folder).select("date", F.array("A").alias("x"))
    out = regression.ols(long_returns(spark, folder), features, 1)
    return out.select("series", rounded(F.col("weights")[0], 3).alias("w0"), rounded(F.col("weights")[1], 6).alias("w1"))


@query(
    "ols_two_factor",
    f"""
    WITH {LONG_RETURNS}, {FACTOR_MATRIX},
    m AS (
        SELECT series, avg(ret) AS my, avg(a) AS ma, avg(n) AS mn, covar_pop(a, a) AS aa, covar_pop(n, n) AS nn,
               covar_pop(a, n) AS an, covar_pop(a, ret) AS ay, covar_pop(n, ret) AS ny
        FROM stock_ret JOIN matrix USING (date) GROUP BY series),
    b AS (SELECT *, (ay * nn - ny * an) / (aa * nn - an * an) AS b1, (ny * aa - ay * an) / (aa * nn - an * an) AS b2 FROM m)
    SELECT series, round(my - b1 * ma - b2 * mn, 3) AS w0, round(b1, 6) AS w1, round(b2, 6) AS w2 FROM b
    """,
)
def ols_two_factor(spark, folder):
    features = matrix(spark, folder).select("date", F.array("A", "N").alias("x"))
    out = regression.ols(long_returns(spark, folder), features, 2)
    digits = (3, 6, 6)
    return out.select("series", *[rounded(F.col("weights")[i], d).alias(f"w{i}") for i, d in enumerate(digits)])


# Least squares by elimination on the scaled normal equations; the factors and
# hence the matrix of products are the same for all series.
OLS = LONG_RETURNS + "," + FEATURES + """,
    long_x AS (SELECT date, i AS j, x[i] AS x FROM feat, range(1, 13) t(i)),
    mom AS (SELECT j, avg(x) AS m, stddev_pop(x) AS s FROM long_x GROUP BY j),
    z AS (SELECT date, l.j + 1 AS j, (x - m) / s AS z FROM long_x l JOIN mom ON l.j = mom.j
          UNION ALL SELECT date, 1, 1.0 FROM feat),
    gram AS (SELECT p.j AS i, q.j AS j, sum(p.z * q.z) AS g FROM z p JOIN z q ON p.date = q.date GROUP BY 1, 2),
    gram_rows AS (SELECT i, list(g ORDER BY j) AS g FROM gram GROUP BY i),
    rhs AS (SELECT series, j AS i, sum(z * ret) AS b FROM z JOIN stock_ret USING (date) GROUP BY 1, 2),
    start AS (SELECT series, list(list_append(g, b) ORDER BY rhs.i) AS m
              FROM rhs JOIN gram_rows ON rhs.i = gram_rows.i GROUP BY series),
    elim AS (
        SELECT series, 1 AS k, m FROM start
        UNION ALL
        SELECT series, k + 1, list_transform(range(1, 14), lambda i:
            CASE WHEN i = k THEN list_transform(m[k], lambda v: v / m[k][k])
                 ELSE list_transform(range(1, 15), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]) END)
        FROM elim WHERE k <= 13),
    slopes AS (SELECT series, j, elim.m[j + 1][14] / mom.s AS w, mom.m AS mean FROM elim, mom WHERE k = 14),
    weights AS (
        SELECT series, j, w FROM slopes
        UNION ALL
        SELECT e.series, 0, any_value(e.m[1][14]) - sum(s.w * s.mean)
        FROM elim e JOIN slopes s ON e.series = s.series WHERE e.k = 14 GROUP BY e.series)
"""


def weights(spark, folder, returns=None):
    # One row per weekday, read by the fit and by those who use it.
    features = written(regression.factor_features(matrix(spark, folder), FACTORS))
    return regression.ols(returns or long_returns(spark, folder), features, 3 * len(FACTORS)), features


@query(
    "ols_weights",
    f"""
    WITH RECURSIVE {OLS}
    SELECT series, CAST(j AS INTEGER) AS j, CAST(floor(log10(abs(w))) AS INTEGER) AS exponent,
           round(w / pow(10, floor(log10(abs(w)))), 5) AS digits
    FROM weights
    """,
)
def ols_weights(spark, folder):
    out, _ = weights(spark, folder)
    long = out.select("series", F.posexplode("weights").alias("j", "w"))
    exponent = F.floor(F.log10(F.abs("w")))
    return long.select(
        "series",
        "j",
        exponent.cast("int").alias("exponent"),
        rounded(F.col("w") / F.pow(F.lit(10.0), exponent), 5).alias("digits"),
    )


@query(
    "instrument_returns",
    f"""
    WITH RECURSIVE {OLS}
    SELECT stock_ret.series, CAST(stock_ret.date AS VARCHAR) AS date, round(ret, 6) AS ret,
           round(sum(w * coalesce(x, 1.0)), 2) + 0.0 AS fitted
    FROM stock_ret JOIN weights ON stock_ret.series = weights.series
    LEFT JOIN long_x ON long_x.date = stock_ret.date AND long_x.j = weights.j
    GROUP BY stock_ret.series, stock_ret.date, ret
    """,
)
def instrument_returns(spark, folder):
    returns = written(long_returns(spark, folder))  # series times weekdays
    w, features = weights(spark, folder, returns)
    out = dated(regression.fitted(returns, features, w), "ret")
    return out.withColumn("fitted", rounded("fitted", 2))


