"""K-means and the distance of points to their centre."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.stats import crosstab_counts
from tidemark.session import discard, written
from tidemark.sources.delimited import with_vector
from tidemark.sources.files import spread_scan

# The swept numbers of clusters and the final one.
SWEEP = tuple(range(5, 41, 5))
FINAL_K = 100
# Numbers that tasks send without adding them up first.
DIRECT = 1 << 21


def fit(points: DataFrame, k: int = 2, max_iter: int = 20, seed: int = 1) -> KMeansModel:
    """K-means on the array column ``features``, without scaling."""
    return KMeans(k=k, maxIter=max_iter, seed=seed).fit(with_vector(points.select("features")))


def centers(model: KMeansModel) -> list[list[float]]:
    return [[float(v) for v in c] for c in model.clusterCenters()]


def centers_frame(spark: SparkSession, rows: list[list[float]]) -> DataFrame:
    """``(cluster, dim, value)``; k times d rows."""
    cells = [(i, j, float(v)) for i, row in enumerate(rows) for j, v in enumerate(row)]
    return spark.createDataFrame(cells, "cluster int, dim int, value double")


def nearest(features: Column, rows: list[list[float]]) -> Column:
    """Struct of the nearest centre and the distance to it.

    The centres are part of the model and travel with the task; the points are
    compared batch by batch.  Equal distances go to the lower cluster number.
    """
    table = np.asarray(rows, dtype=float)

    def search(batch: pa.Array) -> pa.Array:
        points = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), table.shape[1])
        best = np.full(len(points), np.inf)
        which = np.zeros(len(points), dtype=np.int32)
        for i, center in enumerate(table):
            square = ((points - center) ** 2).sum(axis=1)
            closer = square < best
            best[closer] = square[closer]
            which[closer] = i
        return pa.StructArray.from_arrays([pa.array(which), pa.array(np.sqrt(best))], ["cluster", "distance"])

    return F.arrow_udf(search, "cluster int, distance double")(features.cast("array<double>"))


def assign(points: DataFrame, rows: list[list[float]], features: str = "features") -> DataFrame:
    """Add ``cluster`` and ``distance``, the anomaly score of a point."""
    near = points.withColumn("_near", nearest(F.col(features), rows))
    return near.withColumns(
        {"cluster": F.col("_near.cluster"), "distance": F.col("_near.distance")}
    ).drop("_near")


def mean_by(points: DataFrame, key: str, width: int, features: str = "features") -> DataFrame:
    """Mean point of every group, as one aggregate: ``(key, n, center)``."""
    means = F.array(*[F.avg(F.col(features)[j].cast("double")) for j in range(width)])
    return points.groupBy(key).agg(F.count("*").alias("n"), means.alias("center"))


def lloyd(points: DataFrame, start: list[list[float]], rounds: int, features: str = "features") -> list[list[float]]:
    """A fixed number of assign-and-average rounds; an empty cluster stays put."""
    rows = [list(r) for r in start]
    for _ in range(rounds):
        moved = mean_by(assign(points, rows, features), "cluster", len(rows[0]), features)
        for r in moved.collect():  # one row per cluster
            rows[r["cluster"]] = list(r["center"])
    return rows


def clustering_score(points: DataFrame, rows: list[list[float]], features: str = "features") -> DataFrame:
    """Mean distance, not squared, of the points to their centres."""
    return assign(points, rows, features).agg(F.avg("distance").alias("score"))


def starting_centers(points: DataFrame, k: int, order: Column, features: str = "features") -> list[list[float]]:
    """The first k points by ``order``, such as a hash of their id; of fewer points, all of them."""
    rows = points.filter(F.col(features).isNotNull()).orderBy(order).limit(k)
    return [list(r[0]) for r in rows.select(F.col(features).cast("array<double>")).collect()]


def shared_lloyd(points: DataFrame, starts: list[list[list[float]]], rounds: int = 20, features: str = "features") -> list[list[list[float]]]:
    """Several sets of centres moved side by side: each round is one scan that assigns and averages for all of them.

    A set that a round leaves as it is takes no part in later ones. An empty
    cluster stays put. Per round the driver gets one number for each centre and
    dimension, of every task as long as these are no more than ``DIRECT``.
    """
    sets = [np.asarray(s, dtype=float) for s in starts]
    active = [i for i, s in enumerate(sets) if len(s)]
    rows = points.filter(F.col(features).isNotNull()).select(F.col(features).cast("array<double>").alias("point"))
    tasks = rows.rdd.getNumPartitions()
    for _ in range(rounds):
        if not active:
            break
        moving = {i: sets[i] for i in active}

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = {i: np.zeros((len(s), s.shape[1] + 1)) for i, s in moving.items()}
            for batch in batches:
                table = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                for i, which in zip(moving, _nearest_of(table, moving.values()), strict=True):
                    order = np.argsort(which, kind="stable")
                    found, first = np.unique(which[order], return_index=True)
                    if len(found):
                        totals[i][found, :-1] += np.add.reduceat(table[order], first, axis=0)
                        totals[i][found, -1] += np.diff(np.append(first, len(which)))
            for i, total in totals.items():
                used = np.flatnonzero(total[:, -1])
                yield pa.record_batch(
                    [pa.array(np.full(len(used), i, dtype=np.int32)), pa.array(used.astype(np.int32)), pa.array(list(total[used]), pa.list_(pa.float64()))],
                    names=["set", "cluster", "total"],
                )

        grown = {i: np.zeros((len(s), s.shape[1] + 1)) for i, s in moving.items()}
        found = rows.mapInArrow(sums, "set int, cluster int, total array<double>")
        if tasks * sum(g.size for g in grown.values()) <= DIRECT:
            for batch in found.toArrow().to_batches():
                width = len(batch.column(2)[0]) if len(batch) else 0
                for i, c, total in zip(*(batch.column(j).to_numpy() for j in (0, 1)), batch.column(2).flatten().to_numpy().reshape(-1, max(width, 1)), strict=True):
                    grown[i][c] += total
        else:
            cells = found.select("set", "cluster", F.posexplode("total").alias("dim", "value"))
            found = cells.groupBy("set", "cluster", "dim").agg(F.sum("value").alias("value")).toArrow()
            which, cluster, dim, value = (found[c].to_numpy() for c in ("set", "cluster", "dim", "value"))
            for i, total in grown.items():
                mine = which == i
                total[cluster[mine], dim[mine]] = value[mine]
        active = []
        for i, total in grown.items():
            full = total[:, -1] > 0
            moved = sets[i].copy()
            moved[full] = total[full, :-1] / total[full, -1:]
            if np.abs(moved - sets[i]).max() > 1e-12 * max(np.abs(moved).max(), 1.0):
                active.append(i)
            sets[i] = moved
    return [s.tolist() for s in sets]


def _nearest_of(table: np.ndarray, sets) -> Iterator[np.ndarray]:
    """For each set of centres, the nearest one of every point; equal distances go to the lower number.

    Products tell which centres can be nearest at all; where that leaves several,
    their distances are computed one by one.
    """
    size = (table**2).sum(axis=1)
    for centers in sets:
        lengths = (centers**2).sum(axis=1)
        rough = lengths - 2 * (table @ centers.T)
        which = rough.argmin(axis=1)
        close = rough <= (rough.min(axis=1) + 1e-9 * (size + lengths.max()))[:, None]
        for i in np.flatnonzero(close.sum(axis=1) > 1):
            among = np.flatnonzero(close[i])
            which[i] = among[((table[i] - centers[among]) ** 2).sum(axis=1).argmin()]
        yield which


def k_sweep(points: DataFrame, ks=SWEEP, max_iter: int = 20, order: Column | None = None) -> DataFrame:
    """Score of a fit for each number of clusters: ``(k, score)``.

    All fits move in the same scans, and one scan more scores them. The first
    centres are the first points by ``order``, by default a hash of their features.
    """
    order = F.xxhash64("features") if order is None else order
    first = starting_centers(points, max(ks), order)
    if not first:
        return points.sparkSession.createDataFrame([(k, None) for k in ks], "k int, score double")
    kept = written(spread_scan(points.filter("features is not null").select(F.col("features").cast("array<double>").alias("features"))))
    fits = shared_lloyd(kept, [first[:k] for k in ks], max_iter)
    distances = [nearest(F.col("features"), rows)["distance"] for rows in fits]
    means = kept.agg(*[F.avg(d).alias(f"_{k}") for k, d in zip(ks, distances, strict=True)]).first()
    discard(kept)
    return points.sparkSession.createDataFrame([(k, means[f"_{k}"]) for k in ks], "k int, score double")


def purity_table(assigned: DataFrame, label: str = "label") -> DataFrame:
    """Counts per cluster and label, ordered."""
    return crosstab_counts(assigned, "cluster", label)


def formatted_purity(table: DataFrame, label: str = "label") -> DataFrame:
    """The table as lines of fixed-width fields."""
    line = F.format_string(
        "%1s%18s%8s", F.col("cluster").cast("string"), F.col(label).cast("string"), F.col("n").cast("string")
    )
    return table.select(line.alias("line"))
