"""Counts, summaries, set operations, samples and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import arrays, rng
from tidemark.operators import joins, orderstat, sampling, stats
from tidemark.plans.catalog import query, rounded, table
from tidemark.plans.inputs import ALIASES, PLAYS, POINTS, aliases, plays, points


def uniform_sql(seed: int, row_id: str, counter: str = "0", start: int = 1) -> str:
    digest = f"md5('{seed}:' || {row_id} || ':' || {counter})"
    return f"((('0x' || substr({digest}, {start}, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"


@query("label_counts", "SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY 1")
def label_counts(spark, folder):
    li = table(spark, folder, "lineitem")
    return stats.last_field_counts(li.select(F.concat_ws(",", "l_quantity", "l_linestatus", "l_returnflag").alias("value")))


@query(
    "numeric_stats",
    """
    SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean,
           round(stddev_pop(l_extendedprice), 4) AS stdev, max(l_extendedprice) AS max, min(l_extendedprice) AS min
    FROM lineitem
    """,
)
def numeric_stats(spark, folder):
    out = stats.numeric_stats(table(spark, folder, "lineitem"), "l_extendedprice")
    return out.withColumns({"mean": rounded("mean", 4), "stdev": rounded("stdev", 4)})


@query(
    "class_priors",
    "SELECT label, round(count(*) / sum(count(*)) OVER (), 10) AS prior FROM embeddings GROUP BY label",
)
def class_priors(spark, folder):
    return stats.class_priors(points(spark, folder)).withColumn("prior", rounded("prior", 10))


@query(
    "prior_baseline",
    f"""
    WITH d AS (SELECT vec_id, label, {uniform_sql(7, 'vec_id')} AS u FROM embeddings),
    a AS (SELECT label, count(*) / sum(count(*)) OVER () AS p FROM d WHERE u < 0.8 GROUP BY label),
    b AS (SELECT label, count(*) / sum(count(*)) OVER () AS q FROM d WHERE u >= 0.8 AND u < 0.9 GROUP BY label)
    SELECT round(sum(p * q), 10) AS baseline FROM a JOIN b USING (label)
    """,
)
def prior_baseline(spark, folder):
    split = sampling.hash_split(points(spark, folder), F.col("vec_id"), seed=7)
    out = stats.prior_baseline(split.filter("part = 'train'"), split.filter("part = 'cv'"))
    return out.select(rounded("baseline", 10).alias("baseline"))


@query("distinct_values", "SELECT DISTINCT p_name FROM part")
def distinct_values(spark, folder):
    return stats.distinct_values(table(spark, folder, "part"), "p_name")


@query(
    "union_all",
    """
    SELECT key, balance FROM (SELECT c_custkey AS key, c_acctbal AS balance FROM customer
                              UNION ALL SELECT s_suppkey, s_acctbal FROM supplier)
    """,
)
def union_all(spark, folder):
    a = table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"))
    b = table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"))
    return stats.union_all(b, a)


@query(
    "hash_sample",
    f"SELECT doc_id, n_chars FROM documents WHERE {uniform_sql(11, 'doc_id')} < 0.1",
)
def hash_sample(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return sampling.hash_sample(docs, F.col("doc_id"), 0.1, seed=11)


@query(
    "hash_split",
    f"""
    SELECT o_orderkey, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'cv' ELSE 'test' END AS part
    FROM (SELECT o_orderkey, {uniform_sql(5, 'o_orderkey')} AS u FROM orders)
    """,
)
def hash_split(spark, folder):
    return sampling.hash_split(table(spark, folder, "orders").select("o_orderkey"), F.col("o_orderkey"), seed=5)


@query(
    "counter_normals",
    f"""
    SELECT o_orderkey, round(sqrt(-2 * ln(u1)) * cos(2 * pi() * u2), 8) AS z0,
           round(sqrt(-2 * ln(u1)) * sin(2 * pi() * u2), 8) AS z1
    FROM (SELECT o_orderkey, {uniform_sql(1001, 'o_orderkey')} AS u1,
                 {uniform_sql(1001, 'o_orderkey', '0', 14)} AS u2 FROM orders)
    """,
)
def counter_normals(spark, folder):
    z0, z1 = rng.normal_pair(1001, F.col("o_orderkey"), 0)
    return table(spark, folder, "orders").select("o_orderkey", rounded(z0, 8).alias("z0"), rounded(z1, 8).alias("z1"))


@query(
    "k_smallest",
    """
    SELECT x FROM (SELECT l_extendedprice AS x, row_number() OVER (ORDER BY l_extendedprice) AS rn,
                          count(*) OVER () AS n FROM lineitem)
    WHERE rn <= greatest(n // 20, 1)
    """,
)
def k_smallest(spark, folder):
    prices = table(spark, folder, "lineitem").select(F.col("l_extendedprice").alias("x"))
    return orderstat.k_smallest(prices, "x", orderstat.tail_rank(prices.count()))


@query(
    "filter_semi",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_name LIKE 'red%')
    """,
)
def filter_semi(spark, folder):
    li = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    ids = table(spark, folder, "part").filter(F.col("p_name").startswith("red"))
    return joins.semi_filter(li, ids.select(F.col("p_partkey").alias("l_partkey")), ["l_partkey"])


@query("lookup_by_key", "SELECT p_partkey, p_name FROM part WHERE p_partkey = 42")
def lookup_by_key(spark, folder):
    return joins.lookup_by_key(table(spark, folder, "part").select("p_partkey", "p_name"), "p_partkey", 42)


@query(
    "array_init_last",
    """
    SELECT vec_id, CAST(len(embedding) - 1 AS INTEGER) AS n, CAST(embedding[64] AS DOUBLE) AS last,
           CAST(embedding[63] AS DOUBLE) AS before_last,
           round(list_sum(list_transform(embedding[1:63], lambda v: v::DOUBLE)), 8) AS total
    FROM embeddings
    """,
)
def array_init_last(spark, folder):
    a = F.col("features")
    init = arrays.all_but_last(a)
    return points(spark, folder).select(
        "vec_id",
        F.size(init).alias("n"),
        arrays.last(a).alias("last"),
        F.element_at(init, -1).alias("before_last"),
        rounded(F.aggregate(init, F.lit(0.0), lambda s, v: s + v), 8).alias("total"),
    )


@query(
    "alias_resolve",
    f"""
    WITH {PLAYS}, {ALIASES}
    SELECT CAST(usr AS INTEGER) AS usr, CAST(coalesce(good, item) AS INTEGER) AS item, rating
    FROM plays LEFT JOIN aliases ON item = bad
    """,
)
def alias_resolve(spark, folder):
    return joins.resolve_alias(plays(spark, folder), aliases(spark, folder)).withColumnRenamed("user", "usr")


@query(
    "alias_resolve_sum",
    f"""
    WITH {PLAYS}, {ALIASES}
    SELECT CAST(usr AS INTEGER) AS usr, CAST(coalesce(good, item) AS INTEGER) AS item, sum(rating) AS rating
    FROM plays LEFT JOIN aliases ON item = bad GROUP BY 1, 2
    """,
)
def alias_resolve_sum(spark, folder):
    return joins.resolve_alias(plays(spark, folder), aliases(spark, folder), merge=True).withColumnRenamed("user", "usr")


@query(
    "euclidean_distance",
    f"""
    WITH {POINTS}
    SELECT vec_id, round(sqrt(sum((x - m) * (x - m))), 8) AS distance
    FROM pts JOIN ctr ON label = c AND pts.j = ctr.j GROUP BY vec_id
    """,
)
def euclidean_distance(spark, folder):
    from tidemark.operators.clustering import mean_by

    pts = points(spark, folder)
    means = mean_by(pts, "label", 64).select("label", "center")
    joined = joins.lookup_join(pts, means, ["label"], "inner")
    return joined.select("vec_id", rounded(arrays.euclidean(F.col("features"), F.col("center")), 8).alias("distance"))
