"""Latent semantic analysis: decomposition and relevance queries."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.operators.gram import gram_matrix
from tidemark.operators.joins import lookup_join
from tidemark.operators.matrix import (
    matrix_row,
    multiply_diagonal,
    multiply_vector,
    normalize_rows,
    transpose_multiply,
    vector_array,
)
from tidemark.session import discard, written
from tidemark.sources.delimited import with_vector

# Products whose eigenvalue is below this share of the largest are taken for zero.
RANK_TOLERANCE = 1e-13


@dataclass(frozen=True)
class Decomposition:
    """``u (id, vec)``, ``s (col, s)`` and ``v (id, vec)`` with A = U S V'."""

    u: DataFrame
    s: DataFrame
    v: DataFrame


def _fix_signs(v: np.ndarray) -> np.ndarray:
    """The entry of largest magnitude in each column becomes positive."""
    peak = v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])]
    return v * np.where(peak < 0, -1.0, 1.0)


def _local_frames(spark: SparkSession, s: np.ndarray, v: np.ndarray) -> tuple[DataFrame, DataFrame]:
    sigma = spark.createDataFrame([(i, float(x)) for i, x in enumerate(s)], "col int, s double")
    table = pa.table(
        {"id": pa.array(np.arange(len(v), dtype=np.int64)), "vec": pa.array(list(v), pa.list_(pa.float64()))}
    )
    return sigma, spark.createDataFrame(table)


def svd(rows: DataFrame, k: int) -> Decomposition:
    """Truncated SVD of dense rows ``(id, vec)`` by the library.

    k is cut down to the number of columns and to the numerical rank.  Column
    signs are fixed.  The library keeps V, one row per column, on the driver, as
    rows of that width have to fit a task anyway; a matrix given as entries, of
    any width, belongs in ``subspace_svd``.
    """
    spark = rows.sparkSession
    width = rows.select(F.size("vec").alias("n")).first()["n"]
    k = min(k, width)
    # The library reads the rows once per iteration.
    vectors = MLUtils.convertVectorColumnsFromML(with_vector(rows.select("vec"), "vec"), "vec").persist()
    try:
        found = RowMatrix(vectors, 0, width).computeSVD(k, computeU=False)
    finally:
        vectors.unpersist()
    s = np.array(found.s.toArray())
    v = _fix_signs(np.array(found.V.toArray()))
    projection = v / s

    def project(batch: pa.Array) -> pa.Array:
        points = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
        return pa.array(list(points @ projection), pa.list_(pa.float64()))

    u = rows.select("id", F.arrow_udf(project, "array<double>")(F.col("vec").cast("array<double>")).alias("vec"))
    sigma, right = _local_frames(spark, s, v)
    return Decomposition(u, sigma, right)


def _sum_runs(ids: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of equal ids; ids ascend."""
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    return ids[first], np.add.reduceat(table, first, axis=0)


def _vectors(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _id_vec(ids: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * table.shape[1])
    vec = pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(table).reshape(-1)))
    return pa.record_batch([pa.array(ids), vec], names=["id", "vec"])


# Numbers of one piece of a batch while rows are multiplied and summed (32 MB).
PIECE = 4_000_000


def _half_step(entries: DataFrame, blocks: DataFrame, key: str, other: str, k: int) -> DataFrame:
    """``(id, vec)``: the sum of v times the block row of ``other``, per ``key``.

    Products are summed per batch before they are dealt by ``key``, and once more
    where the sorted rows of a key run by; the plan is the same for any k.
    """
    keyed = blocks.select(F.col("id").alias(other), F.col("vec").alias("_q"))
    joined = entries.select(key, other, "v").join(keyed, other).select(F.col(key).cast("long").alias("id"), "v", "_q")
    step = max(PIECE // k, 1)

    def products(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                table = _vectors(batch.column(2), k)[order] * batch.column(1).to_numpy(zero_copy_only=False)[order, None]
                yield _id_vec(*_sum_runs(ids[order], table))

    def sums(batches):
        last, held = None, np.zeros(k)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                ids, table = _sum_runs(batch.column(0).to_numpy(zero_copy_only=False), _vectors(batch.column(1), k))
                if last == ids[0]:
                    table[0] += held
                elif last is not None:
                    yield _id_vec(np.array([last]), held[None])
                last, held = ids[-1], table[-1]
                if len(ids) > 1:
                    yield _id_vec(ids[:-1], table[:-1])
        if last is not None:
            yield _id_vec(np.array([last]), held[None])

    schema = "id long, vec array<double>"
    partitions = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partial = joined.mapInArrow(products, schema).repartition(partitions, "id").sortWithinPartitions("id")
    return partial.mapInArrow(sums, schema)


def _times(blocks: DataFrame, small: np.ndarray) -> DataFrame:
    """Each row times a small matrix."""
    height = small.shape[0]

    def multiply(batches):
        for batch in batches:
            if batch.num_rows:
                yield _id_vec(batch.column(0).to_numpy(zero_copy_only=False), _vectors(batch.column(1), height) @ small)

    return blocks.select(F.col("id").cast("long").alias("id"), "vec").mapInArrow(multiply, "id long, vec array<double>")


def start_block(entries: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """A random starting row of k numbers for every column of the matrix, drawn from seed and id."""
    ids = entries.select(F.col("col").cast("long").alias("id")).distinct()

    def draw(batches):
        for batch in batches:
            if batch.num_rows:
                mine = batch.column(0).to_numpy(zero_copy_only=False)
                rows = [np.random.default_rng([seed, int(i) & (2**63 - 1)]).standard_normal(k) for i in mine]
                yield _id_vec(mine, np.array(rows))

    return ids.mapInArrow(draw, "id long, vec array<double>")


def _whitening(product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(values, q)``: eigenvalues of a product matrix, largest first, and the matrix that makes the block orthonormal.

    Directions of no weight are left out, so q may have fewer columns than rows.
    """
    values, vectors = np.linalg.eigh(product)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = values > max(values[0], 0) * RANK_TOLERANCE
    return values[keep], vectors[:, keep] / np.sqrt(values[keep])


def power_rounds(
    entries: DataFrame, block: DataFrame, k: int, rounds: int, wanted: int | None = None, tolerance: float = 0.0
) -> tuple[DataFrame, DataFrame | None, np.ndarray, np.ndarray]:
    """Up to ``rounds`` times: multiply by A'A and make the columns orthonormal.

    Both halves of a round are made orthonormal through the eigenvalues of their
    product matrix, which drops directions beyond the rank.  Stops as soon as the
    ``wanted`` first pairs satisfy ``|A'A v - s^2 v| <= tolerance * s^2``.  Gives
    the block, the image of it (once converged, else None), the squared singular
    values and the rotation of the block to their vectors.  Only k by k products
    reach the driver.  Each half step is stored, and what came before it deleted.
    """
    stored: list[DataFrame] = []
    values, q = _whitening(gram_matrix(block, F.col("vec"), k))
    block, k, rotation = _times(block, q), len(values), np.zeros((len(values), 0))
    for _ in range(rounds):
        image = written(_half_step(entries, block, "row", "col", k))
        values, q = _whitening(gram_matrix(image, F.col("vec"), k))
        rotation = q * np.sqrt(values)
        if not len(values):
            return block, image, values, rotation
        raw = written(_half_step(entries, _times(image, q), "col", "row", len(values)))
        product = gram_matrix(raw, F.col("vec"), len(values))
        gap = np.sqrt(np.clip(values * np.diag(product) - values**2, 0, None))[:wanted]
        if tolerance and (gap <= tolerance * values[:wanted]).all():
            discard(raw)
            return block, image, values, rotation
        _, q = _whitening(product)
        discard(image, *stored)
        block, k, stored = _times(raw, q), q.shape[1], [raw]
    return block, None, values, rotation


def subspace_svd(
    entries: DataFrame, k: int, tolerance: float = 1e-3, oversample: int | None = None, max_rounds: int = 200, seed: int = 1
) -> Decomposition:
    """Truncated SVD of a sparse matrix ``(row, col, v)`` of any width.

    Block power rounds on A'A, with an eigenproblem inside the block, until
    every pair kept satisfies ``|A'A v - s^2 v| <= tolerance * s^2``; the error of
    s is then of the order of the tolerance squared.  k is cut down to the rank;
    a zero matrix gives empty frames.  If ``max_rounds`` do not suffice it raises.
    """
    oversample = max(24, k) if oversample is None else oversample
    spark = entries.sparkSession
    entries = entries.filter("v <> 0")
    width = entries.select("col").distinct().limit(k + oversample).count()
    if not width:
        empty = spark.createDataFrame([], "id long, vec array<double>")
        return Decomposition(empty, spark.createDataFrame([], "col int, s double"), empty)
    start = written(start_block(entries, width, seed))
    block, image, values, rotation = power_rounds(entries, start, width, max_rounds, k, tolerance)
    if image is None:
        raise ArithmeticError(f"no convergence in {max_rounds} rounds")
    s, rotation = np.sqrt(values[:k]), rotation[:, :k]
    v = _times(block, rotation)
    sign = np.where(_peaks(v, len(s)) < 0, -1.0, 1.0)
    sigma = spark.createDataFrame([(i, float(x)) for i, x in enumerate(s)], "col int, s double")
    return Decomposition(_times(image, rotation * sign / s), sigma, _times(block, rotation * sign))


def _peaks(rows: DataFrame, k: int) -> np.ndarray:
    """Per column the entry of largest magnitude, of equal ones the largest; one row per task and column is compared."""

    def best(batches):
        peak = np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                table = np.vstack([_vectors(batch.column(0), k), peak])
                peak = table[np.lexsort((table, np.abs(table)), axis=0)[-1], np.arange(k)]
        yield pa.record_batch([pa.array(np.arange(k, dtype=np.int32)), pa.array(peak)], names=["pos", "value"])

    found = rows.select("vec").mapInArrow(best, "pos int, value double")
    most = found.groupBy("pos").agg(F.max(F.struct(F.abs("value").alias("size"), "value"))["value"].alias("value"))
    out = np.zeros(k)
    for r in most.collect():
        out[r["pos"]] = r["value"]
    return out


def top_per_concept(rows: DataFrame, concepts: int, n: int, descending: bool) -> DataFrame:
    """The n first ids of each of the first concepts: ``(concept, rank, id, score)``.

    Ties go by id in the same direction.  The rank filter is applied before the
    shuffle as well, so each task sends at most n rows per concept.
    """
    cells = rows.select("id", F.posexplode(F.slice("vec", 1, concepts)).alias("concept", "score"))
    order = [F.desc("score"), F.desc("id")] if descending else [F.asc("score"), F.asc("id")]
    rank = F.row_number().over(Window.partitionBy("concept").orderBy(*order))
    return cells.withColumn("rank", rank).filter(F.col("rank") <= n)


def top_terms_per_concept(
    v: DataFrame, terms: DataFrame, concepts: int = 4, n: int = 10, descending: bool = False
) -> DataFrame:
    """Terms of each concept, by default those of lowest score first."""
    return _named(top_per_concept(v, concepts, n, descending), terms)


def top_docs_per_concept(u: DataFrame, docs: DataFrame, concepts: int = 4, n: int = 10) -> DataFrame:
    """Documents of each concept, highest score first."""
    return _named(top_per_concept(u, concepts, n, True), docs)


def _named(scored: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``name`` for the few scored ids; an id without a name is kept.

    The scores are a few rows per concept or query.  They are gathered first,
    because they are used twice and come from a scan of a whole matrix.
    """
    scored = scored.sparkSession.createDataFrame(scored.toArrow())
    few = F.broadcast(scored.select("id").distinct())
    wanted = names.select("id", "name").join(few, "id", "left_semi")
    return scored.join(F.broadcast(wanted), "id", "left")


def concept_report(terms: DataFrame, docs: DataFrame) -> DataFrame:
    """Terms and documents of a concept side by side, each as one line."""

    def line(side: DataFrame, name: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("rank", "name")))
        joined = F.array_join(F.transform(ordered, lambda e: e["name"].cast("string")), ", ")
        return side.groupBy("concept").agg(joined.alias(name))

    return line(terms, "terms").join(line(docs, "docs"), "concept").orderBy("concept")


def _best(scores: DataFrame, n: int) -> DataFrame:
    return scores.orderBy(F.desc("score"), F.desc("id")).limit(n)


def scaled(rows: DataFrame, s: DataFrame) -> DataFrame:
    """US or VS."""
    return multiply_diagonal(rows, s)


def top_docs_for_doc(normalized_us: DataFrame, doc_id: int, n: int = 10) -> DataFrame:
    """Documents by cosine with one document, itself included, NaN left out."""
    scores = multiply_vector(normalized_us, matrix_row(normalized_us, doc_id))
    return _best(scores.filter(F.col("score").isNotNull() & ~F.isnan("score")), n)


def top_terms_for_term(normalized_vs: DataFrame, term_id: int, n: int = 10) -> DataFrame:
    """Terms by cosine with one term, itself included; NaN comes last."""
    scores = multiply_vector(normalized_vs, matrix_row(normalized_vs, term_id)).filter(F.col("score").isNotNull())
    return scores.orderBy(F.isnan("score"), F.desc("score"), F.asc("id")).limit(n)


def top_docs_for_term(us: DataFrame, v: DataFrame, term_id: int, n: int = 10) -> DataFrame:
    """Documents by the product of US with the term's row of V."""
    scores = multiply_vector(us, matrix_row(v, term_id))
    return _best(scores.filter(F.col("score").isNotNull()), n)


def query_vector(query: DataFrame, vocabulary: DataFrame, must_exist: bool = False) -> DataFrame:
    """``(id, w)`` of query terms ``(term)`` weighted by idf.

    ``vocabulary`` has ``term``, ``id`` and ``idf``.  A repeated term counts as
    often as it is given; an unknown one is left out or, on request, an error.
    """
    counts = query.groupBy("term").agg(F.count("*").alias("times"))
    known = lookup_join(vocabulary.select("term", "id", "idf"), counts, ["term"], "inner")
    if must_exist:
        missing = counts.join(known.select("term"), "term", "left_anti").select("term").first()
        if missing is not None:
            raise KeyError(missing["term"])
    return known.select("id", (F.col("idf") * F.col("times")).alias("w"))


def top_docs_for_query(us: DataFrame, v: DataFrame, query: DataFrame, n: int = 10) -> DataFrame:
    """Documents by US times (V' q)."""
    concept_weights = vector_array(transpose_multiply(v, query))
    return _best(multiply_vector(us, concept_weights).filter(F.col("score").isNotNull()), n)


def id_of(names: DataFrame, name: str) -> int:
    """The id of a term or document; the smallest one when a name occurs twice."""
    found = names.filter(F.col("name") == F.lit(name)).agg(F.min("id").alias("id")).first()["id"]
    if found is None:
        raise KeyError(name)
    return found


def terms_like(normalized_vs: DataFrame, names: DataFrame, term: str, n: int = 10) -> DataFrame:
    """Terms relevant to a term, by name."""
    return named_scores(top_terms_for_term(normalized_vs, id_of(names, term), n), names)


def docs_like(normalized_us: DataFrame, names: DataFrame, doc: str, n: int = 10) -> DataFrame:
    """Documents relevant to a document, by name."""
    return named_scores(top_docs_for_doc(normalized_us, id_of(names, doc), n), names)


def docs_about(
    us: DataFrame, v: DataFrame, terms: DataFrame, docs: DataFrame, term: str, n: int = 10
) -> DataFrame:
    """Documents relevant to a term, by name."""
    return named_scores(top_docs_for_term(us, v, id_of(terms, term), n), docs)


def named_scores(scores: DataFrame, names: DataFrame) -> DataFrame:
    """Scores with names, for display."""
    return _named(scores, names)


def cosine_rows(rows: DataFrame, s: DataFrame) -> DataFrame:
    """Rows of US or VS at unit length."""
    return normalize_rows(scaled(rows, s))

