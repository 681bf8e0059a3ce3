"""Classification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import classify, sampling
from tidemark.plans.basics import uniform_sql
from tidemark.plans.catalog import query, rounded
from tidemark.plans.grouping import NEAREST, assigned
from tidemark.plans.inputs import points

CLASSES = 10
# Bins of a feature whose values are tenths between -12 and 12.
TENTHS = 256

# The nearest label centre serves as a prediction that SQL can repeat.
PREDICTED = NEAREST + ", pred AS (SELECT vec_id, label, c AS prediction FROM near)"


def predictions(spark, folder):
    return assigned(spark, folder).select("vec_id", "label", F.col("cluster").alias("prediction"))


@query("confusion_matrix", f"WITH {PREDICTED} SELECT label, CAST(prediction AS INTEGER) AS prediction, count(*) AS n FROM pred GROUP BY 1, 2")
def confusion_matrix(spark, folder):
    return classify.confusion(predictions(spark, folder))


RATES = PREDICTED + """,
    classes AS (SELECT CAST(i AS INTEGER) AS class FROM range(0, 12) t(i)),
    tallies AS (
        SELECT class, count(*) FILTER (WHERE label = class) AS actual,
               count(*) FILTER (WHERE prediction = class) AS predicted,
               count(*) FILTER (WHERE label = class AND prediction = class) AS hits
        FROM classes, pred GROUP BY class),
    rates AS (SELECT class, CASE WHEN predicted = 0 THEN 0.0 ELSE hits / predicted END AS p,
                     CASE WHEN actual > 0 THEN hits / actual END AS r FROM tallies)
"""


@query(
    "precision_recall",
    f"WITH {RATES} SELECT class, round(p, 10) AS precision, coalesce(round(r, 10), -1) AS recall FROM rates",
)
def precision_recall(spark, folder):
    # Two classes beyond the labels: their recall is undefined, shown as -1.
    rates = classify.precision_recall(predictions(spark, folder), CLASSES + 2)
    return rates.select(
        "class", rounded("precision", 10).alias("precision"), F.coalesce(rounded("recall", 10), F.lit(-1.0)).alias("recall")
    )


@query(
    "f1_by_class",
    f"WITH {RATES} SELECT class, coalesce(round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END, 10), -1) AS f1 FROM rates",
)
def f1_by_class(spark, folder):
    rates = classify.precision_recall(predictions(spark, folder), CLASSES + 2)
    return rates.select("class", F.coalesce(rounded("f1", 10), F.lit(-1.0)).alias("f1"))


@query("accuracy", f"WITH {PREDICTED} SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 10) AS accuracy FROM pred")
def accuracy(spark, folder):
    return classify.accuracy(predictions(spark, folder)).select(rounded("accuracy", 10).alias("accuracy"))


@query(
    "tree_best_split",
    """
    WITH pts AS (SELECT CAST(i - 1 AS INTEGER) AS feature, round(CAST(embedding[i] AS DOUBLE), 1) AS x,
                        CASE WHEN label >= 5 THEN 1 ELSE 0 END AS y FROM embeddings, range(1, 65) t(i)),
    bins AS (SELECT feature, x, count(*) AS n, sum(y) AS p FROM pts GROUP BY 1, 2),
    cum AS (
        SELECT feature, x, lead(x) OVER w AS x2, sum(n) OVER w AS ln, sum(p) OVER w AS lp,
               sum(n) OVER (PARTITION BY feature) AS n, sum(p) OVER (PARTITION BY feature) AS p
        FROM bins WINDOW w AS (PARTITION BY feature ORDER BY x)),
    cost AS (
        SELECT feature, (x + x2) / 2 AS threshold,
               2.0 * lp * (ln - lp) / ln + 2.0 * (p - lp) * (n - ln - p + lp) / (n - ln) AS c
        FROM cum WHERE x2 IS NOT NULL)
    SELECT feature, round(threshold, 10) AS threshold FROM cost ORDER BY c, feature, threshold LIMIT 1
    """,
)
def tree_best_split(spark, folder):
    """First split of a one-level tree on a binary label; the values are in tenths, so a fixed number of bins holds them all."""
    tenths = F.transform("features", lambda x: F.round(x.cast("double"), 1))
    pts = points(spark, folder).withColumns({"label": (F.col("label") >= 5).cast("double"), "features": tenths})
    feature, threshold = classify.root_split(classify.fit_tree(pts, "gini", 1, TENTHS))
    return pts.limit(1).select(F.lit(feature).alias("feature"), rounded(F.lit(threshold), 10).alias("threshold"))


def split(spark, folder):
    parts = sampling.hash_split(points(spark, folder), F.col("vec_id"), seed=3)
    return [parts.filter(F.col("part") == name) for name in ("train", "cv", "test")]


def grown_sql(settings: list[tuple[str, int]], depth: int, learned: str) -> str:
    """Common tables that grow trees level by level: ``grown`` has the node of every point at every level of every tree."""
    trees = ", ".join(f"('{impurity}', {bins})" for impurity, bins in settings)
    g = "({0}) * ln(greatest({0}, 1))".format
    return f"""
    RECURSIVE parts AS (
        SELECT vec_id, label AS y, embedding, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'cv' ELSE 'test' END AS part
        FROM (SELECT *, {uniform_sql(3, 'vec_id')} AS u FROM embeddings)),
    pts AS (SELECT vec_id, y, part, part IN ({learned}) AS t, CAST(i - 1 AS INTEGER) AS f, CAST(embedding[i] AS DOUBLE) AS x
            FROM parts, range(1, 65) r(i)),
    trees AS (SELECT * FROM (VALUES {trees}) v(impurity, bins)),
    ranked AS (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS rn, count(*) OVER (PARTITION BY f) AS n FROM pts WHERE t),
    cuts AS (SELECT DISTINCT bins, unnest(range(1, bins)) AS i FROM trees),
    values_of AS (SELECT DISTINCT bins, f, x FROM cuts JOIN ranked ON rn = greatest(CAST(ceil(i::DOUBLE / bins * n) AS BIGINT), 1)),
    edges AS (SELECT bins, f, x, row_number() OVER (PARTITION BY bins, f ORDER BY x) AS code FROM values_of),
    wide AS (SELECT b.bins, p.* FROM pts p, (SELECT DISTINCT bins FROM trees) b),
    codes AS MATERIALIZED (
        SELECT p.bins, p.vec_id, p.f, CAST(coalesce(e.code, 0) AS INTEGER) AS code
        FROM wide p ASOF LEFT JOIN edges e ON p.bins = e.bins AND p.f = e.f AND p.x > e.x),
    grown AS (
        SELECT impurity, trees.bins, vec_id, y, part, part IN ({learned}) AS t, 0 AS level, 1::BIGINT AS node FROM trees, parts
        UNION ALL
        SELECT impurity, bins, vec_id, y, part, t, level + 1,
               CASE WHEN best IS NULL THEN node ELSE 2 * node + CAST(code > -best.code AS INTEGER) END
        FROM (SELECT *, max(CASE WHEN t AND code <> after AND score > whole THEN {{'score': score, 'feature': -f, 'code': -code}} END)
                     OVER (PARTITION BY impurity, bins, node) AS best
              FROM (SELECT *,
                           CASE WHEN nr = 0 THEN NULL WHEN impurity = 'gini' THEN round(l / nl + (w - r) / nr, 6)
                                ELSE round(l - {g('nl')} + w - r - {g('nr')}, 6) END AS score,
                           CASE WHEN impurity = 'gini' THEN round(w / nw, 6) ELSE round(w - {g('nw')}, 6) END AS whole
                    FROM (SELECT *, lead(code) OVER run AS after, count(*) OVER run AS nl, count(*) OVER side AS nw, count(*) OVER side - count(*) OVER run AS nr,
                                 sum(grow) OVER run AS l, sum(shrink) OVER run AS r, sum(grow) OVER side AS w
                          FROM (SELECT *, CASE WHEN impurity = 'gini' THEN 2 * k - 1 ELSE {g('k')} - {g('k - 1')} END AS grow,
                                       CASE WHEN impurity = 'gini' THEN 2 * (ny - k) + 1 ELSE {g('ny - k + 1')} - {g('ny - k')} END AS shrink
                                FROM (SELECT grown.*, f, code,
                                             row_number() OVER (PARTITION BY impurity, bins, node, f, t, y ORDER BY code, vec_id) AS k,
                                             count(*) OVER (PARTITION BY impurity, bins, node, f, t, y) AS ny
                                      FROM grown JOIN codes USING (bins, vec_id) WHERE level < {depth}))
                          WINDOW run AS (PARTITION BY impurity, bins, node, f, t ORDER BY code, vec_id ROWS UNBOUNDED PRECEDING),
                                 side AS (PARTITION BY impurity, bins, node, f, t))))
        WHERE f = coalesce(-best.feature, 0)),
    votes AS (SELECT impurity, bins, level, node, y, count(*) AS n FROM grown WHERE t GROUP BY ALL),
    leaves AS (SELECT impurity, bins, level, node, y AS prediction FROM votes
               QUALIFY row_number() OVER (PARTITION BY impurity, bins, level, node ORDER BY n DESC, y) = 1),
    predicted AS (SELECT impurity, bins, level, vec_id, part, y AS label, prediction FROM grown JOIN leaves USING (impurity, bins, level, node))
    """


FIT = grown_sql([("gini", 100)], 4, "'train'") + f""",
    pred AS (SELECT label, prediction FROM predicted WHERE level = 4 AND part = 'cv'),
    classes AS (SELECT CAST(i AS INTEGER) AS class FROM range(0, {CLASSES}) t(i)),
    tallies AS (
        SELECT class, count(*) FILTER (WHERE label = class) AS actual, count(*) FILTER (WHERE prediction = class) AS predicted,
               count(*) FILTER (WHERE label = class AND prediction = class) AS hits
        FROM classes, pred GROUP BY class),
    rates AS (SELECT class, CASE WHEN predicted = 0 THEN 0.0 ELSE hits / predicted END AS p, CASE WHEN actual > 0 THEN hits / actual END AS r FROM tallies)
"""


@query(
    "tree_fit",
    f"WITH {FIT} SELECT class, round(p, 10) AS precision, coalesce(round(r, 10), -1) AS recall, coalesce(round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) END, 10), -1) AS f1 FROM rates",
)
def tree_fit(spark, folder):
    """Depth four, a hundred bins: precision, recall and F1 on held-out points, -1 where undefined."""
    train, held_out, _ = split(spark, folder)
    rates = classify.precision_recall(classify.predict_one(train, held_out), CLASSES)
    known = lambda c: F.coalesce(rounded(c, 10), F.lit(-1.0)).alias(c)
    return rates.select("class", rounded("precision", 10).alias("precision"), known("recall"), known("f1"))


GRID = grown_sql([(i, b) for i in classify.IMPURITIES for b in classify.BINS], max(classify.DEPTHS), "'train'")
SHOWN = ", ".join(map(str, classify.DEPTHS))


@query(
    "tree_grid",
    f"""
    WITH {GRID} SELECT impurity, CAST(level AS INTEGER) AS depth, bins, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 10) AS accuracy
    FROM predicted WHERE part = 'cv' AND level IN ({SHOWN}) GROUP BY ALL
    """,
)
def tree_grid(spark, folder):
    """Accuracy of the eight settings."""
    train, held_out, _ = split(spark, folder)
    return classify.grid_search(train, held_out).withColumn("accuracy", rounded("accuracy", 10))


@query(
    "tree_refit",
    f"""
    WITH {grown_sql([('entropy', 300)], 20, "'train', 'cv'")}
    SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 10) AS accuracy FROM predicted WHERE part = 'test' AND level = 20
    """,
)
def tree_refit(spark, folder):
    """Accuracy on the test part of the tree grown on the other two."""
    return classify.refit(*split(spark, folder)).select(rounded("accuracy", 10).alias("accuracy"))


@query("tree_fit_laws", "SELECT true AS all_counted, true AS no_worse_than_prior")
def tree_fit_laws(spark, folder):
    """On its own training points a tree is at least as often right as the most frequent label."""
    train, _, _ = split(spark, folder)
    train = train.persist()
    try:
        found = classify.predict_one(train, train)
        prior = train.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
        hits, counted = classify.confusion(found).agg(
            F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)), F.sum("n")
        ).first()
    finally:
        train.unpersist()
    return spark.createDataFrame([(counted == prior[1], hits >= prior[0])], "all_counted boolean, no_worse_than_prior boolean")


@query("tree_grid_laws", "SELECT CAST(8 AS BIGINT) AS settings, true AS in_range")
def tree_grid_laws(spark, folder):
    """The grid has every setting once, each with an accuracy."""
    train, held_out, _ = split(spark, folder)
    grid = classify.grid_search(train, held_out)
    return grid.agg(
        F.countDistinct(*[c for c in grid.columns if c != "accuracy"]).alias("settings"),
        F.bool_and(F.col("accuracy").between(0, 1)).alias("in_range"),
    )
