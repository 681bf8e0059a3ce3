"""Recommender queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import innertop, recommend
from tidemark.operators.joins import resolve_alias
from tidemark.plans.catalog import query, rounded, table
from tidemark.plans.inputs import aliases, plays

USER = 7


def given_factors(spark, folder):
    """Embeddings as given factor rows of users and items alike."""
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


SCORES = f"""
    scores AS (
        SELECT CAST(e.vec_id AS BIGINT) AS item,
               list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
        FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = {USER}) q),
    best AS (SELECT item, score, row_number() OVER (ORDER BY score DESC, item) AS rank FROM scores
             QUALIFY rank <= 5)
"""


def best_five(spark, folder):
    factors = given_factors(spark, folder)
    return recommend.recommend(factors, factors, USER, 5)


@query("recommend_topn", f"WITH {SCORES} SELECT item, round(score, 8) AS score, CAST(rank AS INTEGER) AS rank FROM best")
def recommend_topn(spark, folder):
    return best_five(spark, folder).withColumn("score", rounded("score", 8))


@query(
    "recommend_named",
    f"""
    WITH {SCORES}
    SELECT item, round(score, 8) AS score, CAST(rank AS INTEGER) AS rank, p_name AS name
    FROM best LEFT JOIN part ON item = p_partkey
    """,
)
def recommend_named(spark, folder):
    names = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return recommend.with_names(best_five(spark, folder), names).withColumn("score", rounded("score", 8))


@query("als_fit")
def als_fit(spark, folder):
    """Fit on the alias-resolved counts; five suggestions with names for one user."""
    ratings = resolve_alias(plays(spark, folder), aliases(spark, folder))
    model = recommend.fit_implicit(ratings)
    names = table(spark, folder, "part").select(F.col("p_partkey").cast("int").alias("id"), F.col("p_name").alias("name"))
    return recommend.with_names(recommend.recommend_products(model, USER), names)


@query("als_factors")
def als_factors(spark, folder):
    """Item factors as text."""
    return recommend.factors_as_text(recommend.fit_implicit(plays(spark, folder)).itemFactors)


@query(
    "als_rank1_step",
    """
    SELECT count(DISTINCT o_custkey) AS users, CAST(0 AS DOUBLE) AS gap
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def als_rank1_step(spark, folder):
    """After a rank-one fit the user factors satisfy their normal equations."""
    return factor_gap(spark, folder, rank=1, iterations=5)


def factor_gap(spark, folder, **options):
    """Users, and the largest gap in the normal equations that the last half step has solved."""
    ratings = plays(spark, folder).persist()
    try:
        model = recommend.fit_implicit(ratings, **options)
        out = recommend.normal_equation_gap(
            ratings, model.userFactors, model.itemFactors, recommend.REGULARIZATION, recommend.ALPHA
        )
        return spark.createDataFrame(out.select("users", rounded("gap", 2).alias("gap")).toArrow())  # one row
    finally:
        ratings.unpersist()


@query(
    "als_fit_gap",
    """
    SELECT count(DISTINCT o_custkey) AS users, CAST(0 AS DOUBLE) AS gap
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def als_fit_gap(spark, folder):
    """The same after the whole fit of ``als_factors``."""
    return factor_gap(spark, folder)


@query(
    "recommend_users",
    """
    WITH scores AS (
        SELECT CAST(q.vec_id AS BIGINT) AS user, CAST(e.vec_id AS BIGINT) AS item,
               list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score
        FROM embeddings e, embeddings q WHERE q.vec_id % 20 = 0),
    best AS (SELECT *, row_number() OVER (PARTITION BY user ORDER BY score DESC, item) AS rank FROM scores QUALIFY rank <= 5)
    SELECT user, item, round(score, 8) AS score, CAST(rank AS INTEGER) AS rank FROM best
    """,
)
def recommend_users(spark, folder):
    """Five items for each user whose id is divisible by 20, in one go."""
    factors = given_factors(spark, folder)
    stored = innertop.store_by_norm(factors)
    best = innertop.top_inner(stored, factors.filter(F.col("id") % 20 == 0), 5)
    return best.select(F.col("query").cast("long").alias("user"), F.col("id").cast("long").alias("item"), rounded("score", 8).alias("score"), F.col("rank").cast("int").alias("rank"))
