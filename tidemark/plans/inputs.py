"""Inputs that several queries derive from the tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.joins import lookup_join
from tidemark.plans.catalog import table

START, END = "1996-01-01", "2000-12-29"
FACTORS = ["A", "N", "R", "O"]


def brand_daily(spark, folder) -> DataFrame:
    """Daily mean price per brand, a price history per series."""
    li = table(spark, folder, "lineitem").select("l_partkey", F.col("l_shipdate").cast("date").alias("date"), "l_extendedprice")
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("series"))
    joined = lookup_join(li, part, ["l_partkey"], "inner")
    return joined.groupBy("series", "date").agg(F.avg("l_extendedprice").alias("value"))


BRAND_DAILY = """
    brand_daily AS (
        SELECT p_brand AS series, CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS value
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
"""


def factor_daily(spark, folder) -> DataFrame:
    """Daily mean price per return flag, and of open lines, as four factors."""
    # Summed per flag, status and day first, so that no line is copied.
    daily = (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.sum("l_extendedprice").alias("s"), F.count("l_extendedprice").alias("n"))
    )
    series = F.array_compact(F.array(F.col("l_returnflag"), F.when(F.col("l_linestatus") == "O", F.lit("O"))))
    return (
        daily.select(F.explode(series).alias("series"), "date", "s", "n")
        .groupBy("series", "date")
        .agg((F.sum("s") / F.sum("n")).alias("value"))
    )


FACTOR_DAILY = """
    factor_daily AS (
        SELECT l_returnflag AS series, CAST(l_shipdate AS DATE) AS date, avg(l_extendedprice) AS value
        FROM lineitem GROUP BY 1, 2
        UNION ALL
        SELECT 'O', CAST(l_shipdate AS DATE), avg(l_extendedprice)
        FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
"""


def trimmed_sql(source: str, out: str) -> str:
    return f"""
    {out}_inside AS (SELECT * FROM {source} WHERE date BETWEEN DATE '{START}' AND DATE '{END}'),
    {out}_ends AS (
        SELECT series, min(date) AS lo, max(date) AS hi, arg_min(value, date) AS v_lo, arg_max(value, date) AS v_hi
        FROM {out}_inside GROUP BY 1),
    {out} AS (
        SELECT series, date, value FROM {out}_inside
        UNION ALL SELECT series, DATE '{START}', v_lo FROM {out}_ends WHERE lo <> DATE '{START}'
        UNION ALL SELECT series, DATE '{END}', v_hi FROM {out}_ends WHERE hi <> DATE '{END}')
    """


def filled_sql(source: str, out: str) -> str:
    return f"""
    {out}_days AS (
        SELECT CAST(d AS DATE) AS date FROM range(DATE '{START}', DATE '{END}', INTERVAL 1 DAY) t(d) WHERE isodow(d) < 6),
    {out}_spine AS (SELECT series, date FROM (SELECT DISTINCT series FROM {source}), {out}_days),
    {out} AS (
        SELECT s.series, s.date, t.value
        FROM {out}_spine s ASOF JOIN {source} t ON s.series = t.series AND s.date >= t.date)
    """


def returns_sql(source: str, out: str) -> str:
    return f"""
    {trimmed_sql(source, out + "_t")}, {filled_sql(out + "_t", out + "_f")},
    {out} AS (
        SELECT series, date, ret FROM (
            SELECT series, date, lead(value, 9) OVER (PARTITION BY series ORDER BY date) - value AS ret FROM {out}_f)
        WHERE ret IS NOT NULL)
    """


FACTOR_RETURNS = FACTOR_DAILY + "," + returns_sql("factor_daily", "factor_ret")
FACTOR_MATRIX = FACTOR_RETURNS + """,
    matrix AS (
        SELECT date, max(CASE WHEN series = 'A' THEN ret END) AS a, max(CASE WHEN series = 'N' THEN ret END) AS n,
               max(CASE WHEN series = 'R' THEN ret END) AS r, max(CASE WHEN series = 'O' THEN ret END) AS o
        FROM factor_ret GROUP BY date)
"""
STOCK_RETURNS = BRAND_DAILY + "," + returns_sql("brand_daily", "stock_ret")
# The risk job drops short histories before anything else.
LONG_RETURNS = BRAND_DAILY + """,
    brand_long AS (SELECT * FROM brand_daily QUALIFY count(*) OVER (PARTITION BY series) >= 1310),
""" + returns_sql("brand_long", "stock_ret")


def plays(spark, folder) -> DataFrame:
    """Quantity bought per customer and part, as implicit counts."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (
        li.join(orders, "l_orderkey")
        .groupBy(F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item"))
        .agg(F.sum("l_quantity").alias("rating"))
    )


PLAYS = """
    plays AS (
        SELECT o_custkey AS usr, l_partkey AS item, sum(l_quantity) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
"""


def aliases(spark, folder) -> DataFrame:
    """Parts that share a name count as the one with the smallest key."""
    part = table(spark, folder, "part").select(F.col("p_partkey").cast("int").alias("bad"), "p_name")
    first = part.groupBy("p_name").agg(F.min("bad").alias("good"))
    return lookup_join(part, first, ["p_name"], "inner").filter(F.col("bad") != F.col("good")).select("bad", "good")


ALIASES = """
    aliases AS (
        SELECT bad, good FROM (
            SELECT p_partkey AS bad, min(p_partkey) OVER (PARTITION BY p_name) AS good FROM part)
        WHERE bad <> good)
"""


def points(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("features")
    )


# (vec_id, label, j, x) with j from 0, and the mean point of each label.
POINTS = """
    pts AS (SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS j, CAST(embedding[i] AS DOUBLE) AS x
            FROM embeddings, range(1, 65) t(i)),
    ctr AS (SELECT label AS c, j, avg(x) AS m FROM pts GROUP BY 1, 2)
"""
