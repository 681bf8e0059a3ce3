"""Clustering queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import clustering
from tidemark.plans.catalog import query, rounded
from tidemark.plans.inputs import POINTS, points

WIDTH = 64


def label_centers(pts):
    """The mean point of each label as a starting centre; one row per label."""
    means = clustering.mean_by(pts, "label", WIDTH).orderBy("label").collect()
    return [list(r["center"]) for r in means]


# Squared distance to every centre; the nearest one, ties to the lower number.
def nearest_sql(centers: str, out: str) -> str:
    return f"""
    {out}_d AS (SELECT vec_id, label, c, sum((x - m) * (x - m)) AS d FROM pts JOIN {centers} USING (j) GROUP BY ALL),
    {out} AS (SELECT vec_id, any_value(label) AS label, arg_min(c, d) AS c, sqrt(min(d)) AS distance
              FROM {out}_d GROUP BY vec_id)
    """


NEAREST = f"{POINTS}, {nearest_sql('ctr', 'near')}"


def assigned(spark, folder):
    pts = points(spark, folder)
    return clustering.assign(pts, label_centers(pts))


@query(
    "kmeans_assign",
    f"WITH {NEAREST} SELECT vec_id, CAST(c AS INTEGER) AS cluster, round(distance, 8) AS distance FROM near",
)
def kmeans_assign(spark, folder):
    return assigned(spark, folder).select("vec_id", "cluster", rounded("distance", 8).alias("distance"))


@query(
    "dist_to_centroid",
    f"WITH {NEAREST} SELECT vec_id, label, round(distance, 8) AS score FROM near",
)
def dist_to_centroid(spark, folder):
    """The anomaly score of every point, the farthest first."""
    scored = assigned(spark, folder).select("vec_id", "label", rounded("distance", 8).alias("score"))
    return scored.orderBy(F.desc("score"), "vec_id")


@query("clustering_score", f"WITH {NEAREST} SELECT round(avg(distance), 8) AS score FROM near")
def clustering_score(spark, folder):
    pts = points(spark, folder)
    return clustering.clustering_score(pts, label_centers(pts)).select(rounded("score", 8).alias("score"))


@query(
    "cluster_label_crosstab",
    f"WITH {NEAREST} SELECT CAST(c AS INTEGER) AS cluster, label, count(*) AS n FROM near GROUP BY 1, 2",
)
def cluster_label_crosstab(spark, folder):
    return clustering.purity_table(assigned(spark, folder))


@query(
    "kmeans_lloyd",
    f"""
    WITH {NEAREST},
    ctr1 AS (SELECT near.c, j, avg(x) AS m FROM pts JOIN near USING (vec_id) GROUP BY 1, 2),
    ctr1f AS (SELECT * FROM ctr1 UNION ALL SELECT * FROM ctr WHERE c NOT IN (SELECT c FROM ctr1)),
    {nearest_sql('ctr1f', 'near1')},
    ctr2 AS (SELECT near1.c, j, avg(x) AS m FROM pts JOIN near1 USING (vec_id) GROUP BY 1, 2),
    ctr2f AS (SELECT * FROM ctr2 UNION ALL SELECT * FROM ctr1f WHERE c NOT IN (SELECT c FROM ctr2))
    SELECT CAST(c AS INTEGER) AS cluster, j AS dim, round(m, 8) AS value FROM ctr2f
    """,
)
def kmeans_lloyd(spark, folder):
    pts = points(spark, folder)
    rows = clustering.lloyd(pts, label_centers(pts), rounds=2)
    return clustering.centers_frame(spark, rows).withColumn("value", rounded("value", 8))


@query("kmeans_fit")
def kmeans_fit(spark, folder):
    """Library fit with two clusters: size and mean distance of each."""
    pts = points(spark, folder)
    rows = clustering.centers(clustering.fit(pts))
    out = clustering.assign(pts, rows).groupBy("cluster")
    return out.agg(F.count("*").alias("n"), F.avg("distance").alias("mean_distance"))


def lloyd_sql(ks: list[int], rounds: int) -> str:
    """Common tables of k-means for several k, from the points of lowest digest on: ``moved`` has the centres after each round."""
    means = ", ".join(f"coalesce(avg(x[{j}]) FILTER (near), any_value(m[{j}]))" for j in range(1, WIDTH + 1))
    return f"""
    RECURSIVE pts AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    firsts AS (SELECT x, CAST(row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR))) - 1 AS INTEGER) AS c FROM pts),
    moved AS (
        SELECT 0 AS r, k, c, x AS m FROM firsts, (SELECT unnest({ks}) AS k) WHERE c < k
        UNION ALL
        SELECT r + 1, k, c, [{means}] AS m
        FROM (SELECT moved.*, vec_id, x, row_number() OVER (PARTITION BY k, vec_id ORDER BY list_distance(x, m), c) = 1 AS near
              FROM moved, pts WHERE r < {rounds})
        GROUP BY r, k, c)
    """


def by_digest():
    return F.md5(F.col("vec_id").cast("string").cast("binary"))


@query(
    "kmeans_final",
    f"""
    WITH {lloyd_sql([clustering.FINAL_K], 20)}
    SELECT c AS cluster, CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS dim, round(unnest(m), 8) AS value FROM moved WHERE r = 20
    """,
)
def kmeans_final(spark, folder):
    """A hundred clusters: the centres after twenty rounds."""
    pts = points(spark, folder)
    (rows,) = clustering.shared_lloyd(pts, [clustering.starting_centers(pts, clustering.FINAL_K, by_digest())])
    return clustering.centers_frame(spark, rows).withColumn("value", rounded("value", 8))


@query(
    "k_sweep",
    f"""
    WITH {lloyd_sql(list(clustering.SWEEP), 20)},
    near AS (SELECT k, vec_id, min(list_distance(x, m)) AS d FROM moved, pts WHERE r = 20 GROUP BY ALL)
    SELECT k, round(avg(d), 8) AS score FROM near GROUP BY k
    """,
)
def k_sweep(spark, folder):
    """All numbers of clusters in the same twenty scans."""
    return clustering.k_sweep(points(spark, folder), order=by_digest()).withColumn("score", rounded("score", 8))


@query("kmeans_fit_laws", "SELECT count(*) AS n, true AS nearest, true AS no_worse_than_one FROM embeddings")
def kmeans_fit_laws(spark, folder):
    """Of the fit with two clusters: every point counts, is at its nearest centre, and the cost is not above that of one centre."""
    pts = points(spark, folder)
    rows = clustering.centers(clustering.fit(pts))
    table, mean = np.array(rows), clustering.mean_by(pts.withColumn("one", F.lit(1)), "one", WIDTH).first()["center"]
    cell = lambda c: sum(((F.col("features")[j] - F.lit(float(c[j]))) ** 2 for j in range(WIDTH)), F.lit(0.0))
    best = F.least(*[cell(c) for c in table])
    out = clustering.assign(pts, rows).select("distance", best.alias("best"), cell(mean).alias("one"))
    return out.agg(
        F.count("*").alias("n"),
        (F.max(F.abs(F.col("distance") ** 2 - F.col("best"))) < 1e-6).alias("nearest"),
        (F.sum("best") <= F.sum("one")).alias("no_worse_than_one"),
    )


@query("k_sweep_laws", f"SELECT unnest({list(clustering.SWEEP)}) AS k, true AS no_worse_than_one")
def k_sweep_laws(spark, folder):
    """Every swept number of clusters has a score, and none is above that of one centre."""
    pts = points(spark, folder)
    mean = clustering.mean_by(pts.withColumn("one", F.lit(1)), "one", WIDTH).first()["center"]
    one = clustering.clustering_score(pts, [list(mean)]).first()["score"]
    return clustering.k_sweep(pts).select("k", (F.col("score") <= one + 1e-9).alias("no_worse_than_one"))
