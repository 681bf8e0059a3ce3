"""Recommendations from implicit counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import arrays
from tidemark.operators import implicit
from tidemark.operators.gram import gram_matrix

# Settings of the training run.
RANK, ITERATIONS, REGULARIZATION, ALPHA = 10, 20, 0.01, 50.0


def fit_implicit(
    ratings: DataFrame,
    rank: int = RANK,
    iterations: int = ITERATIONS,
    reg: float = REGULARIZATION,
    alpha: float = ALPHA,
    seed: int = 1,
) -> implicit.ImplicitFactors:
    """Factorise ``(user, item, rating)`` counts; ids must fit an integer."""
    return implicit.fit(ratings, rank, iterations, reg, alpha, seed)


def factors_as_text(factors: DataFrame) -> DataFrame:
    """``(id, factors)`` with the numbers joined by commas."""
    return factors.select("id", F.array_join(F.col("features").cast("array<string>"), ", ").alias("factors"))


def recommend(user_factors: DataFrame, item_factors: DataFrame, user: int, n: int = 5) -> DataFrame:
    """The n items with the largest product with the user's factors.

    Items the user has already are not left out.  Equal scores go by the lower
    item; an unknown user gets nothing.  The user's row is one scalar subquery,
    so the item table is scanned once and only n rows per task survive.
    """
    row = user_factors.filter(F.col("id") == F.lit(user)).select(arrays.doubles(F.col("features"))).limit(1).scalar()
    scored = (
        item_factors.select(F.col("id").alias("item"), arrays.doubles(F.col("features")).alias("v"))
        .withColumn("_user", row)
        .select("item", arrays.dot(F.col("v"), F.col("_user")).alias("score"))
        .filter(F.col("score").isNotNull())
    )
    best = scored.orderBy(F.desc("score"), F.asc("item")).limit(n)
    rank = F.row_number().over(Window.orderBy(F.desc("score"), F.asc("item")))  # n rows
    return best.withColumn("rank", rank)


def recommend_products(model: implicit.ImplicitFactors, user: int, n: int = 5) -> DataFrame:
    return recommend(model.userFactors, model.itemFactors, user, n)


def with_names(recommended: DataFrame, names: DataFrame) -> DataFrame:
    """Add item names, keeping the rank and items that have no name."""
    # The recommendations are a handful of rows, bounded by n, and used twice.
    recommended = recommended.sparkSession.createDataFrame(recommended.toArrow())
    named = names.select(F.col("id").alias("item"), "name")
    matched = named.join(F.broadcast(recommended.select("item")), "item", "left_semi")
    return recommended.join(matched, "item", "left")


def normal_equation_gap(
    ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame, reg: float, alpha: float
) -> DataFrame:
    """``(users, gap)``: how far user factors are from solving their normal equations, relative to the largest right side.

    User factors are solved last, so with item factors y and any number of
    ratings each u must satisfy
    (sum of y y' + sum of alpha r y y' over the rated + reg n) u = sum of (1 + alpha r) y over the rated.
    """
    # Factors are joined as they are stored, and widened after the shuffles.
    y = item_factors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    u = user_factors.select(F.col("id").alias("user"), F.col("features").alias("u"))
    rank = u.select(F.size("u")).first()[0]
    whole = gram_matrix(y, F.col("y"), rank)
    r = F.col("rating").cast("double") * F.lit(alpha)
    rated = ratings.join(y, "item").join(u, "user")
    rated = rated.withColumns({name: F.col(name).cast("array<double>") for name in ("y", "u")})
    rated = rated.withColumn("p", r * arrays.dot(F.col("y"), F.col("u")))
    left = [F.sum(F.col("p") * F.col("y")[j]).alias(f"a{j}") for j in range(rank)]
    right = [F.sum((1.0 + r) * F.col("y")[j]).alias(f"b{j}") for j in range(rank)]
    sums = rated.groupBy("user").agg(F.count("*").alias("n"), F.first("u").alias("u"), *left, *right)
    gaps = []
    for j in range(rank):
        all_items = sum((F.lit(float(whole[j, i])) * F.col("u")[i] for i in range(rank)), F.lit(0.0))
        gaps.append(F.abs(all_items + F.col(f"a{j}") + F.lit(reg) * F.col("n") * F.col("u")[j] - F.col(f"b{j}")))
    size = F.greatest(*[F.abs(F.col(f"b{j}")) for j in range(rank)], F.lit(1e-12))
    worst = F.greatest(*gaps, F.lit(0.0)) / size
    return sums.agg(F.count("*").alias("users"), F.max(worst).alias("gap"))
