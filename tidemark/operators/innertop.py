"""The rows with the largest inner products, for many queries at once and without scoring every row.

Rows are stored in blocks of similar length, longest first. An inner product is at
most the product of both lengths, so once a query has n good rows, blocks whose
longest row is too short for it are never joined to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tidemark.functions import arrays
from tidemark.session import written

#: Rows of a stored block and queries of one product.
BLOCK, QUERIES = 4096, 256
#: Rounding allowed for when a row is compared with the worst one kept, as a share of both lengths.
SLACK = 1e-12


@dataclass(frozen=True)
class NormBlocks:
    """Blocks ``(block, high, ids, vecs)``, and on the driver one id and length per block, longest first."""

    frame: DataFrame
    ids: np.ndarray
    highs: np.ndarray
    kind: object


def _usable(rows: DataFrame, key: str, vec: str) -> DataFrame:
    """Rows with an id and a vector of finite numbers, and their length."""
    v = arrays.doubles(F.col(vec))
    found = rows.select(F.col(key).alias("id"), v.alias("vec")).filter(F.col("id").isNotNull() & F.col("vec").isNotNull())
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    return found.filter(finite).withColumn("norm", arrays.norm(F.col("vec")))


def _table(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _blocked(size: int, names: list[str]):
    """Consecutive rows of a task as blocks: ``block``, the first row's number, the ids and all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, []

        def block(part: pa.Table) -> pa.RecordBatch:
            nonlocal number
            ids, first = part.column(0).combine_chunks(), part.column(2)[0].as_py()
            flat = part.column(1).combine_chunks().flatten()
            lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], type=pa.int32()), a) for a in (ids, flat)]
            number += 1
            return pa.record_batch([pa.array([number - 1]), pa.array([first]), *lists], names=names)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < size:
                continue
            whole = pa.Table.from_batches(held)
            full = whole.num_rows // size * size
            for lo in range(0, full, size):
                yield block(whole.slice(lo, size))
            held = whole.slice(full).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return run


def _block_schema(kind, first: str) -> StructType:
    fields = [("block", LongType()), (first, DoubleType()), ("ids", ArrayType(kind)), ("vecs", ArrayType(DoubleType()))]
    return StructType([StructField(n, t) for n, t in fields])


def store_by_norm(rows: DataFrame, key: str = "id", vec: str = "features", block: int = BLOCK) -> NormBlocks:
    """Store ``(key, vec)`` in blocks by length.

    Rows without an id or with a vector that is NULL or not finite are left out. The
    driver gets two numbers per block.
    """
    sized = _usable(rows, key, vec)
    kind = sized.schema["id"].dataType
    ordered = sized.repartitionByRange(F.desc("norm"), F.col("id")).sortWithinPartitions(F.desc("norm"), "id")
    frame = written(ordered.mapInArrow(_blocked(block, ["block", "high", "ids", "vecs"]), _block_schema(kind, "high")))
    found = frame.select("block", "high").orderBy(F.desc("high"), "block").toPandas()
    return NormBlocks(frame, found["block"].to_numpy(np.int64), found["high"].to_numpy(float), kind)


def _bounded(queries: DataFrame, stored: NormBlocks, n: int, key: str, vec: str) -> DataFrame:
    """``(id, vec, norm, least, blocks)``: what a query's n-th row scores at least, and the blocks that may hold better ones.

    The longest block goes to every task, it is at most one block in size.
    """
    sized = _usable(queries, key, vec)
    first = stored.frame.filter(F.col("block") == F.lit(int(stored.ids[0]))).select("ids", "vecs").first()
    head, highs = np.array(first["vecs"]).reshape(len(first["ids"]), -1), stored.highs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, QUERIES):
                part = batch.slice(lo, QUERIES)
                norm = part.column(2).to_numpy()
                least = np.full(part.num_rows, -np.inf)
                if len(head) >= n:
                    scores = _table(part.column(1), part.num_rows) @ head.T
                    least = np.partition(scores, -n, axis=1)[:, -n] - SLACK * norm * highs[0]
                with np.errstate(divide="ignore", invalid="ignore"):
                    shortest = np.where(least > 0, least / norm, 0.0) * (1 - SLACK)
                blocks = np.searchsorted(-highs, -shortest, side="right")
                yield pa.record_batch([*part.columns, pa.array(least), pa.array(blocks)], names=["id", "vec", "norm", "least", "blocks"])

    schema = StructType(list(sized.schema.fields)).add("least", "double").add("blocks", "long")
    return sized.mapInArrow(run, schema)


def blocks_needed(stored: NormBlocks, queries: DataFrame, n: int, key: str = "id", vec: str = "features") -> DataFrame:
    """``(id, blocks, stored)``: how many blocks each query is compared with, of how many."""
    if not len(stored.ids):
        return _usable(queries, key, vec).select("id", F.lit(0).cast("bigint").alias("blocks"), F.lit(0).cast("bigint").alias("stored"))
    found = _bounded(queries, stored, n, key, vec)
    return found.select("id", "blocks", F.lit(len(stored.ids)).cast("bigint").alias("stored"))


def _products(n: int):
    """Joined blocks of queries and rows to the n best rows of each query: ``query, id, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked, least, ids = (batch.column(c)[i].values for c in ("queries", "least", "ids"))
                q = batch.column("wanted")[i].values.to_numpy().reshape(len(asked), -1)
                rows = batch.column("vecs")[i].values.to_numpy().reshape(len(ids), -1)
                slack = SLACK * np.linalg.norm(q, axis=1) * batch.column("high")[i].as_py()
                scores, least = q @ rows.T, least.to_numpy()
                if len(ids) > n:
                    least = np.maximum(least, np.partition(scores, -n, axis=1)[:, -n] - slack)
                # Equal rows must get equal scores in every block, so those that stay are summed again one by one.
                who, which = np.nonzero(scores >= least[:, None])
                exact = np.concatenate([(q[who[lo : lo + BLOCK]] * rows[which[lo : lo + BLOCK]]).sum(axis=1) for lo in range(0, len(who), BLOCK)] or [np.zeros(0)])
                yield pa.record_batch([asked.take(pa.array(who)), ids.take(pa.array(which)), pa.array(exact)], names=["query", "id", "score"])

    return run


def top_inner(stored: NormBlocks, queries: DataFrame, n: int, key: str = "id", vec: str = "features") -> DataFrame:
    """``(query, id, score, rank)``: the n stored rows of largest inner product for every query.

    The result is exact; equal scores go by the lower id. Queries without an id, or with a vector
    that is NULL or not finite, get no rows; a table of fewer than n rows is ranked whole. Query ids have to be unique.
    Queries of similar reach are multiplied with a stored block as one matrix, and a
    block is joined only to queries that it may hold a row for.
    """
    kinds = _usable(queries, key, vec).schema["id"].dataType
    out = StructType([StructField("query", kinds), StructField("id", stored.kind), StructField("score", DoubleType())])
    if not len(stored.ids):
        return queries.sparkSession.createDataFrame([], out).withColumn("rank", F.lit(1))
    bounded = _bounded(queries, stored, n, key, vec)
    order = stored.ids

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, QUERIES):
                part = batch.slice(lo, QUERIES)
                needed = order[: max(part.column("blocks").to_numpy())]
                lists = [part.column("id"), part.column("vec").flatten(), part.column("least"), pa.array(needed)]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], type=pa.int32()), a) for a in lists]
                yield pa.record_batch(lists, names=["queries", "wanted", "least", "needed"])

    fields = [("queries", ArrayType(kinds)), ("wanted", ArrayType(DoubleType())), ("least", ArrayType(DoubleType())), ("needed", ArrayType(LongType()))]
    alike = bounded.repartitionByRange("blocks", "id").sortWithinPartitions("blocks")
    blocks = alike.mapInArrow(packed, StructType([StructField(name, t) for name, t in fields]))
    # Never a broadcast: the copies of the queries, one a block, are small only while compressed, and would all pass the driver.
    pairs = blocks.withColumn("block", F.explode("needed")).drop("needed").hint("merge").join(stored.frame, "block")
    found = pairs.mapInArrow(_products(n), out)
    rank: Column = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc("id")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= n)
