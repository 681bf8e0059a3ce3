"""Decision trees and the measures of a classification."""

from __future__ import annotations

from itertools import product

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.sql import DataFrame, functions as F

from tidemark.operators import trees
from tidemark.operators.stats import count_by
from tidemark.sources.delimited import with_vector

# The settings tried by the grid search.
IMPURITIES, DEPTHS, BINS = ("gini", "entropy"), (1, 20), (10, 300)


def fit_tree(
    points: DataFrame, impurity: str = "gini", depth: int = 4, bins: int = 100, seed: int = 1
) -> DecisionTreeClassificationModel:
    """A tree on ``(label, features)`` with numeric features only."""
    tree = DecisionTreeClassifier(impurity=impurity, maxDepth=depth, maxBins=bins, seed=seed, maxMemoryInMB=512)
    return tree.fit(with_vector(points.select(F.col("label").cast("double").alias("label"), "features")))


def predict(model: DecisionTreeClassificationModel, points: DataFrame) -> DataFrame:
    """Add ``prediction``."""
    kept = points.columns
    vectors = with_vector(points.withColumn("_array", F.col("features")))
    out = model.transform(vectors).withColumn("features", F.col("_array"))
    return out.select(*kept, "prediction")


def root_split(model: DecisionTreeClassificationModel) -> tuple[int, float] | None:
    """Feature and threshold of the first split; None for a single leaf."""
    if model.depth == 0:
        return None
    split = model._call_java("rootNode").split()
    return split.featureIndex(), split.threshold()


def confusion(predictions: DataFrame) -> DataFrame:
    return count_by(predictions, "label", "prediction")


def precision_recall(predictions: DataFrame, classes: int) -> DataFrame:
    """Precision, recall and F1 of the classes 0 .. classes-1.

    The precision of a class never predicted is 0; the recall of a class that
    does not occur is NULL.  F1 is NULL where it is undefined.
    """
    counts = confusion(predictions)
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").cast("int").alias("class"),
                    n.alias("actual"),
                    zero.alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), n).otherwise(zero).alias("hits"),
                ),
                F.struct(
                    F.col("prediction").cast("int").alias("class"),
                    zero.alias("actual"),
                    n.alias("predicted"),
                    zero.alias("hits"),
                ),
            )
        )
    )
    every = predictions.sparkSession.range(classes).select(
        F.col("id").cast("int").alias("class"), zero.alias("actual"), zero.alias("predicted"), zero.alias("hits")
    )
    sums = (
        sides.filter(F.col("class").between(0, classes - 1))
        .unionByName(every)
        .groupBy("class")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    )
    rates = sums.select(
        "class",
        F.when(F.col("predicted") == 0, F.lit(0.0)).otherwise(F.try_divide("hits", "predicted")).alias("precision"),
        F.try_divide("hits", "actual").alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", F.try_divide(2 * p * r, p + r))


def accuracy(predictions: DataFrame) -> DataFrame:
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"))


def grid_search(train: DataFrame, held_out: DataFrame, impurities=IMPURITIES, depths=DEPTHS, bins=BINS) -> DataFrame:
    """Accuracy of every combination of settings, best first.

    All trees grow in the same passes over the training points, and one pass over
    the held-out points scores them; settings that differ in depth share a tree.
    """
    forest = trees.grow(train, list(product(impurities, bins)), max(depths))
    settings = [(i, d, b) for i, b in sorted(forest.trees) for d in depths]
    spark = train.sparkSession
    schema = "setting int, impurity string, depth int, bins int"
    named = spark.createDataFrame([(n, *s) for n, s in enumerate(settings)], schema)
    hits = F.transform("predictions", lambda p: (p == F.col("label")).cast("double"))
    each = trees.predict_all(forest, held_out, tuple(depths)).select(F.posexplode(hits).alias("setting", "hit"))
    scored = each.groupBy("setting").agg(F.avg("hit").alias("accuracy"))
    out = named.join(scored, "setting", "left").select("impurity", "depth", "bins", "accuracy")
    return out.orderBy(F.desc("accuracy"), "impurity", "depth", "bins")


def predict_one(train: DataFrame, points: DataFrame, impurity: str = "gini", depth: int = 4, bins: int = 100) -> DataFrame:
    """``points`` with the ``prediction`` of a tree grown on ``train``."""
    forest = trees.grow(train, [(impurity, bins)], depth)
    return trees.predict_all(forest, points, (depth,)).withColumn("prediction", F.col("predictions")[0]).drop("predictions")


def refit(
    train: DataFrame, held_out: DataFrame, test: DataFrame, impurity: str = "entropy", depth: int = 20, bins: int = 300
) -> DataFrame:
    """Fit on both training parts and give the accuracy on the test part."""
    return accuracy(predict_one(train.unionByName(held_out), test, impurity, depth, bins))
