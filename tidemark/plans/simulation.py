"""Monte Carlo trials, tail risk, resampling, backtest and density."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import rng
from tidemark.functions.finance import normal_pdf
from tidemark.operators import density, regression, risk
from tidemark.plans.basics import uniform_sql
from tidemark.plans.catalog import query, rounded, spread, table
from tidemark.plans.inputs import FACTORS, FACTOR_MATRIX, LONG_RETURNS
from tidemark.plans.reports import risk_curves, risk_report as build_risk_report
from tidemark.plans.series import OLS, long_returns, matrix
from tidemark.session import cut_lineage

# Base seed and number of resamples.
SEED = 1001
RESAMPLES = 100

# Price less a thousand per piece: a sample of gains and losses.
PNL_SQL = "pnl AS (SELECT l_extendedprice - 1000 * l_quantity AS x FROM lineitem)"


def pnl(spark, folder):
    li = table(spark, folder, "lineitem")
    return li.select((F.col("l_extendedprice") - 1000 * F.col("l_quantity")).alias("x"))


def trial_rows(spark, folder):
    """One trial per order."""
    return spread(spark, folder, "orders", "o_orderkey").withColumnRenamed("o_orderkey", "trial_id")


def _normals_sql() -> str:
    pairs = []
    for c in range(2):
        pairs.append(f"{uniform_sql(SEED, 'o_orderkey', repr(str(c)))} AS u{2 * c}")
        pairs.append(f"{uniform_sql(SEED, 'o_orderkey', repr(str(c)), 14)} AS u{2 * c + 1}")
    return ", ".join(pairs)


# Means, covariance and its Cholesky root, then the draws of every trial.
DRAWS = f"""
    cov AS (
        SELECT avg(a) AS ma, avg(n) AS mn, avg(r) AS mr, avg(o) AS mo,
               covar_samp(a, a) AS aa, covar_samp(a, n) AS an, covar_samp(a, r) AS ar, covar_samp(a, o) AS ao,
               covar_samp(n, n) AS nn, covar_samp(n, r) AS nr, covar_samp(n, o) AS no,
               covar_samp(r, r) AS rr, covar_samp(r, o) AS ro, covar_samp(o, o) AS oo
        FROM matrix),
    c1 AS (SELECT *, sqrt(aa) AS l11, an / sqrt(aa) AS l21, ar / sqrt(aa) AS l31, ao / sqrt(aa) AS l41 FROM cov),
    c2 AS (SELECT *, sqrt(nn - l21 * l21) AS l22 FROM c1),
    c3 AS (SELECT *, (nr - l31 * l21) / l22 AS l32, (no - l41 * l21) / l22 AS l42 FROM c2),
    c4 AS (SELECT *, sqrt(rr - l31 * l31 - l32 * l32) AS l33 FROM c3),
    c5 AS (SELECT *, (ro - l41 * l31 - l42 * l32) / l33 AS l43 FROM c4),
    c6 AS (SELECT *, sqrt(oo - l41 * l41 - l42 * l42 - l43 * l43) AS l44 FROM c5),
    us AS (SELECT o_orderkey AS trial_id, {_normals_sql()} FROM orders),
    zs AS (
        SELECT trial_id, sqrt(-2 * ln(u0)) * cos(2 * pi() * u1) AS z0, sqrt(-2 * ln(u0)) * sin(2 * pi() * u1) AS z1,
               sqrt(-2 * ln(u2)) * cos(2 * pi() * u3) AS z2, sqrt(-2 * ln(u2)) * sin(2 * pi() * u3) AS z3
        FROM us),
    draws AS (
        SELECT trial_id, ma + l11 * z0 AS f0, mn + l21 * z0 + l22 * z1 AS f1,
               mr + l31 * z0 + l32 * z1 + l33 * z2 AS f2, mo + l41 * z0 + l42 * z1 + l43 * z2 + l44 * z3 AS f3
        FROM zs, c6)
"""


@query(
    "mc_factor_draws",
    f"""
    WITH {FACTOR_MATRIX}, {DRAWS}
    SELECT trial_id, round(f0, 3) AS f0, round(f1, 3) AS f1, round(f2, 3) AS f2, round(f3, 3) AS f3 FROM draws
    """,
)
def mc_factor_draws(spark, folder):
    model = regression.fit_factor_model(matrix(spark, folder), FACTORS)
    draws = risk.factor_draws(trial_rows(spark, folder), "trial_id", model, SEED)
    return draws.select("trial_id", *[rounded(f"f{i}", 3).alias(f"f{i}") for i in range(4)])


# The portfolio is the sum of all series, so the weights are summed first.
TRIALS = OLS + "," + DRAWS + """,
    total AS (SELECT list(w ORDER BY j) AS w FROM (SELECT j, sum(w) AS w FROM weights GROUP BY j)),
    trials AS (
        SELECT trial_id, w[1] + w[2] * sign(f0) * f0 * f0 + w[3] * sign(f1) * f1 * f1 + w[4] * sign(f2) * f2 * f2
               + w[5] * sign(f3) * f3 * f3 + w[6] * sign(f0) * sqrt(abs(f0)) + w[7] * sign(f1) * sqrt(abs(f1))
               + w[8] * sign(f2) * sqrt(abs(f2)) + w[9] * sign(f3) * sqrt(abs(f3))
               + w[10] * f0 + w[11] * f1 + w[12] * f2 + w[13] * f3 AS x
        FROM draws, total)
"""


def trials(spark, folder, returns=None):
    factors = cut_lineage(matrix(spark, folder))  # one row per weekday
    model = regression.fit_factor_model(factors, FACTORS)
    draws = risk.factor_draws(trial_rows(spark, folder), "trial_id", model, SEED)
    features = regression.factor_features(factors, FACTORS)
    w = regression.ols(returns or long_returns(spark, folder), features, 3 * len(FACTORS))
    return risk.trial_returns(draws, regression.portfolio_weights(w)).select("trial_id", "ret")


@query("mc_trials", f"WITH RECURSIVE {TRIALS} SELECT trial_id, round(x, 2) AS ret FROM trials")
def mc_trials(spark, folder):
    return trials(spark, folder).withColumn("ret", rounded("ret", 2))


TAIL = """
    ranked AS (SELECT x, row_number() OVER (ORDER BY x) AS rn, greatest(count(*) OVER () // 20, 1) AS k,
                      count(*) OVER () AS n FROM pnl)
"""


@query(
    "var_5pct",
    f"WITH {PNL_SQL}, {TAIL} SELECT n AS trials, k AS tail_size, round(x, 4) AS var FROM ranked WHERE rn = k",
)
def var_5pct(spark, folder):
    return risk.var_cvar(pnl(spark, folder), "x").select("trials", "tail_size", rounded("var", 4).alias("var"))


@query(
    "cvar_5pct",
    f"WITH {PNL_SQL}, {TAIL} SELECT round(avg(x), 4) AS cvar FROM ranked WHERE rn <= k",
)
def cvar_5pct(spark, folder):
    return risk.var_cvar(pnl(spark, folder), "x").select(rounded("cvar", 4).alias("cvar"))


def weight_sql(lane: str) -> str:
    cuts = rng.poisson1_cuts()
    steps = " + ".join(f"CAST({lane} >= '{c}' AS INTEGER)" for c in cuts)
    return f"({steps})"


def bootstrap_sql(source: str, row_id: str) -> str:
    """Statistics of every resample of ``source (row_id, x)``, from all of its rows."""
    return f"""
    boot_w AS (
        SELECT x, r, {weight_sql('lane')} AS w FROM (
            SELECT x, r, substr(md5('1:' || {row_id} || ':' || (r // 4)), 1 + 8 * (r % 4), 8) AS lane
            FROM {source}, range(0, {RESAMPLES}) t(r))),
    boot_total AS (SELECT r, sum(w) AS n, greatest(sum(w) // 20, 1) AS k FROM boot_w GROUP BY r),
    boot_cum AS (SELECT r, x, w, sum(w) OVER (PARTITION BY r ORDER BY x ROWS UNBOUNDED PRECEDING) AS cum
                 FROM boot_w WHERE w > 0),
    boot AS (
        SELECT boot_cum.r, any_value(n) AS trials, any_value(k) AS tail_size, max(x) AS var,
               sum(x * least(w, k - (cum - w))) / any_value(k) AS cvar
        FROM boot_cum JOIN boot_total ON boot_cum.r = boot_total.r WHERE cum - w < k GROUP BY boot_cum.r)
    """


ORDER_SAMPLE = "sample AS (SELECT o_orderkey AS id, o_totalprice - 250000 AS x FROM orders)"


def order_sample(spark, folder):
    orders = spread(spark, folder, "orders", "o_orderkey", "o_totalprice")
    return orders.select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") - 250000).alias("x"))


@query(
    "bootstrap_stats",
    f"""
    WITH {ORDER_SAMPLE}, {bootstrap_sql('sample', 'id')}
    SELECT CAST(r AS INTEGER) AS r, CAST(trials AS BIGINT) AS trials, CAST(tail_size AS BIGINT) AS tail_size,
           round(var, 4) AS var, round(cvar, 4) AS cvar
    FROM boot
    """,
)
def bootstrap_stats(spark, folder):
    out = risk.bootstrap_tails(order_sample(spark, folder), "id", "x", RESAMPLES, seed=1)
    return out.withColumns({"var": rounded("var", 4), "cvar": rounded("cvar", 4)})


@query(
    "bootstrap_ci",
    f"""
    WITH {ORDER_SAMPLE}, {bootstrap_sql('sample', 'id')}
    SELECT 'var' AS statistic, round(list_sort(list(var))[2], 4) AS lower, round(list_sort(list(var))[99], 4) AS upper FROM boot
    UNION ALL
    SELECT 'cvar', round(list_sort(list(cvar))[2], 4), round(list_sort(list(cvar))[99], 4) FROM boot
    """,
)
def bootstrap_ci(spark, folder):
    out = risk.bootstrap_tails(order_sample(spark, folder), "id", "x", RESAMPLES, seed=1)
    out = spark.createDataFrame(out.toArrow())  # one row per resample, used twice
    both = risk.confidence_interval(out, "var", RESAMPLES).unionByName(risk.confidence_interval(out, "cvar", RESAMPLES))
    return both.withColumns({"lower": rounded("lower", 4), "upper": rounded("upper", 4)})


# A bound well inside the sample, so that some periods fail.
FAILURES = LONG_RETURNS + """,
    per_date AS (SELECT date, sum(ret) AS total FROM stock_ret GROUP BY date),
    failed AS (SELECT count(*) AS periods, count(*) FILTER (WHERE total < v) AS failures
               FROM per_date, (SELECT avg(total) - 1.5 * stddev_pop(total) AS v FROM per_date))
"""
# 0 * ln 0 counts as 0, and the tail of chi-square(1) is integrated by Simpson's rule.
KUPIEC = """
    stat AS (
        SELECT periods, failures,
               -2 * ((periods - failures) * ln(1 - 0.05::DOUBLE) + failures * ln(0.05::DOUBLE)
                     - CASE WHEN periods = failures THEN 0 ELSE (periods - failures) * ln(1 - failures / periods) END
                     - CASE WHEN failures = 0 THEN 0 ELSE failures * ln(failures / periods) END) AS statistic
        FROM failed),
    tail_p AS (
        SELECT periods, failures, statistic,
               1 - 2 * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                           * exp(-0.5 * pow(i * sqrt(greatest(statistic, 0)) / 4000, 2)) / sqrt(2 * pi()))
                       * sqrt(greatest(statistic, 0)) / 4000 / 3 AS p_value
        FROM stat, range(0, 4001) t(i) GROUP BY periods, failures, statistic)
"""


def failure_counts(spark, folder):
    returns = long_returns(spark, folder)
    totals = returns.groupBy("date").agg(F.sum("ret").alias("total"))
    bound = totals.agg(F.avg("total") - F.lit(1.5) * F.stddev_pop("total")).scalar()
    return risk.failures(returns, bound)


@query("var_failures", f"WITH {FAILURES} SELECT periods, failures FROM failed")
def var_failures(spark, folder):
    return failure_counts(spark, folder)


@query(
    "kupiec_stat",
    f"WITH {FAILURES}, {KUPIEC} SELECT periods, failures, round(statistic, 8) AS statistic FROM stat",
)
def kupiec_stat(spark, folder):
    out = risk.kupiec(failure_counts(spark, folder), 0.05)
    return out.select("periods", "failures", rounded("statistic", 8).alias("statistic"))


@query("kupiec_pvalue", f"WITH {FAILURES}, {KUPIEC} SELECT round(p_value, 8) AS p_value FROM tail_p")
def kupiec_pvalue(spark, folder):
    return risk.kupiec(failure_counts(spark, folder), 0.05).select(rounded("p_value", 8).alias("p_value"))


POINTS_AT = [-40000.0, -20000.0, 0.0, 20000.0, 40000.0, 60000.0, 80000.0]
BANDWIDTH_SQL = "bw AS (SELECT 1.06 * stddev_pop(x) * pow(count(*), -0.2) AS h, min(x) AS lo, max(x) AS hi FROM pnl)"


@query("kde_bandwidth", f"WITH {PNL_SQL}, {BANDWIDTH_SQL} SELECT round(h, 6) AS bandwidth FROM bw")
def kde_bandwidth(spark, folder):
    return density.bandwidth(pnl(spark, folder), "x").select(rounded("bandwidth", 6).alias("bandwidth"))


@query(
    "kde",
    f"""
    WITH {PNL_SQL}, {BANDWIDTH_SQL}, grid AS (SELECT unnest({POINTS_AT}::DOUBLE[]) AS p)
    SELECT p AS x, round(1e6 * avg(exp(-0.5 * pow((p - x) / h, 2)) / (h * sqrt(2 * pi()))), 8) AS density
    FROM pnl, bw, grid GROUP BY p
    """,
)
def kde(spark, folder):
    out = density.estimate(pnl(spark, folder), "x", POINTS_AT)
    return out.select("x", rounded(1e6 * F.col("density"), 8).alias("density"))


@query(
    "density_curve",
    f"""
    WITH {PNL_SQL}, {BANDWIDTH_SQL}, grid AS (SELECT i, lo + i * (hi - lo) / 100 AS p, h FROM bw, range(0, 100) t(i))
    SELECT CAST(i AS INTEGER) AS point, round(p, 4) AS x,
           round(1e6 * avg(exp(-0.5 * pow((p - x) / h, 2)) / (h * sqrt(2 * pi()))), 8) AS density
    FROM pnl, grid GROUP BY i, p
    """,
)
def density_curve(spark, folder):
    out = density.density_curve(pnl(spark, folder), "x")
    return out.select("point", rounded("x", 4).alias("x"), rounded(1e6 * F.col("density"), 8).alias("density"))


@query(
    "normal_pdf",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           round(exp(-0.5 * pow((l_tax - l_discount) / 0.03, 2)) / (0.03 * sqrt(2 * pi())), 8) AS pdf
    FROM lineitem
    """,
)
def normal_pdf_rows(spark, folder):
    pdf = normal_pdf(F.col("l_tax"), F.col("l_discount"), F.lit(0.03))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", rounded(pdf, 8).alias("pdf"))


REPORT = TRIALS + f""",
    report_ranked AS (SELECT x, row_number() OVER (ORDER BY x) AS rn, greatest(count(*) OVER () // 20, 1) AS k,
                             count(*) OVER () AS n FROM trials),
    report_tail AS (SELECT max(n) AS n, max(x) AS var, avg(x) AS cvar FROM report_ranked WHERE rn <= k),
    {bootstrap_sql('trials', 'trial_id')},
    bounds AS (SELECT list_sort(list(var)) AS v, list_sort(list(cvar)) AS c FROM boot),
    failed AS (SELECT count(*) AS periods, count(*) FILTER (WHERE total < var) AS failures
               FROM (SELECT date, sum(ret) AS total FROM stock_ret GROUP BY date), report_tail),
    {KUPIEC}
"""


@query(
    "risk_report",
    f"""
    WITH RECURSIVE {REPORT}
    SELECT n AS trials, round(var, 2) AS var, round(cvar, 2) AS cvar, round(v[2], 2) AS var_lower, round(v[99], 2) AS var_upper,
           round(c[2], 2) AS cvar_lower, round(c[99], 2) AS cvar_upper, periods, failures,
           round(p_value, 6) AS p_value
    FROM report_tail, bounds, tail_p
    """,
)
def risk_report(spark, folder):
    returns = long_returns(spark, folder).persist()  # series times weekdays
    out = build_risk_report(trials(spark, folder, returns), returns, RESAMPLES)
    returns.unpersist()
    money = ["var", "cvar", "var_lower", "var_upper", "cvar_lower", "cvar_upper"]
    return out.withColumns({c: rounded(c, 2) for c in money} | {"p_value": rounded("p_value", 6)})


def curve_sql(name: str, source: str, column: str) -> str:
    return f"""
    SELECT '{name}' AS curve, CAST(i AS INTEGER) AS point, round(p, 4) AS x,
           round(1e6 * avg(exp(-0.5 * pow((p - {column}) / h, 2)) / (h * sqrt(2 * pi()))), 8) AS density
    FROM {source}, (
        SELECT i, lo + i * (hi - lo) / 100 AS p, h FROM (
            SELECT 1.06 * stddev_pop({column}) * pow(count({column}), -0.2) AS h, min({column}) AS lo, max({column}) AS hi FROM {source}),
        range(0, 100) t(i))
    WHERE {column} IS NOT NULL GROUP BY i, p
    """


@query("risk_factor_curves", f"WITH {FACTOR_MATRIX} {curve_sql('A', 'matrix', 'a')} UNION ALL {curve_sql('N', 'matrix', 'n')}")
def risk_factor_curves(spark, folder):
    """The two factor curves that the risk job shows beside that of its trials."""
    factors = cut_lineage(matrix(spark, folder))  # one row per weekday
    out = risk_curves(factors.select(F.col("A").alias("ret")), factors, ["A", "N"]).filter("curve <> 'trials'")
    return out.select("curve", "point", rounded("x", 4).alias("x"), rounded(1e6 * F.col("density"), 8).alias("density"))
