"""Triangular factors of short arrays, merged from task to task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


#: Keys of one batch that leaves a task.
KEYS = 1024


def _segments(batch: pa.RecordBatch, key: str) -> Iterator[tuple[object, slice]]:
    """Runs of equal keys of a batch."""
    encoded = batch.column(key).dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi > lo:
            yield encoded.dictionary[int(codes[lo])].as_py(), slice(lo, hi)


def _reduced(key: str, kind: pa.DataType, width: int):
    """Rows sorted by key to one factor per key, read as a stream.

    The input has a flat block of rows ``_vec`` and the number of original rows
    ``_n`` behind it; so does the output, and the same code merges factors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, factor, n = None, None, 0
        done: list[tuple] = []

        def rows() -> pa.RecordBatch:
            names, factors, counts = zip(*done, strict=True)
            done.clear()
            columns = [pa.array(names, type=kind), pa.array(factors, type=pa.list_(pa.float64())), pa.array(counts, type=pa.int64())]
            return pa.record_batch(columns, names=[key, "_vec", "_n"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            vec = batch.column("_vec")
            ends, flat = vec.offsets.to_numpy(), vec.values.to_numpy(zero_copy_only=False)
            counts = batch.column("_n").to_numpy(zero_copy_only=False)
            for name, part in _segments(batch, key):
                table = flat[ends[part.start] : ends[part.stop]].reshape(-1, width)
                if factor is not None and name != last:
                    done.append((last, factor.ravel(), n))
                    factor, n = None, 0
                    if len(done) == KEYS:
                        yield rows()
                table = table if factor is None else np.vstack([factor, table])
                last, factor, n = name, np.linalg.qr(table, mode="r"), n + int(counts[part].sum())
        if factor is not None:
            done.append((last, factor.ravel(), n))
        if done:
            yield rows()

    return run


def grouped_triangle(rows: DataFrame, vec: Column, width: int, key: str) -> DataFrame:
    """``(key, factor, n)``: per key the triangular factor R of its rows, row by row, and their number.

    R'R is the matrix of products of the rows, but is never formed, so the condition
    of the rows is not squared. Each task turns its rows of a key into one
    factor of at most ``width`` rows; the factors of a key meet in one shuffle
    and are merged there as a stream, so a key may have any number of rows. Rows with a NULL key
    or vector are left out; vectors must be of ``width`` finite numbers. A key of fewer
    than ``width`` rows has as many rows in its factor.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    selected = rows.select(F.col(key), vec.cast("array<double>").alias("_vec"), F.lit(1).cast("bigint").alias("_n"))
    selected = selected.filter(F.col(key).isNotNull() & F.col("_vec").isNotNull()).sortWithinPartitions(key)
    kind = selected.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, _vec array<double>, _n bigint"
    step = _reduced(key, to_arrow_type(kind), width)
    partial = selected.mapInArrow(step, schema)
    merged = partial.repartition(key).sortWithinPartitions(key).mapInArrow(step, schema)
    return merged.withColumnsRenamed({"_vec": "factor", "_n": "n"})
