import math

import numpy as np
import pytest

from tidemark.operators import innertop


def frame(spark, table, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in row]) for i, row in enumerate(table)], "id long, features array<double>")


def plain(rows, queries, n):
    """Every product, one by one."""
    out = set()
    for q, wanted in enumerate(queries):
        scores = sorted(((-float((wanted * row).sum()), i) for i, row in enumerate(rows)))[:n]
        out |= {(q, i, rank + 1) for rank, (_, i) in enumerate(scores)}
    return out


@pytest.mark.parametrize("shape", ["skewed", "equal lengths", "copies", "negative"])
@pytest.mark.parametrize("n", [1, 5])
def test_equals_scoring_every_row(spark, shape, n):
    gen = np.random.default_rng(7)
    rows = gen.normal(size=(700, 6))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    if shape == "skewed":
        rows *= gen.pareto(1.0, 700)[:, None]
    elif shape == "copies":
        rows[100:400] = rows[0] * 3
    elif shape == "negative":
        rows = -np.abs(rows)
    queries = np.abs(gen.normal(size=(30, 6))) if shape == "negative" else np.vstack([gen.normal(size=(29, 6)), np.zeros(6)])
    stored = innertop.store_by_norm(frame(spark, rows).repartition(3), block=16)
    got = innertop.top_inner(stored, frame(spark, queries), n).collect()
    assert {(r["query"], r["id"], r["rank"]) for r in got} == plain(rows, queries, n)
    assert len(got) == 30 * n


def test_few_blocks_are_read_when_lengths_differ(spark):
    gen = np.random.default_rng(8)
    rows = gen.normal(size=(4000, 8)) * (1 / np.arange(1, 4001))[:, None]
    queries = frame(spark, gen.normal(size=(50, 8)))
    stored = innertop.store_by_norm(frame(spark, rows), block=32)
    needed = innertop.blocks_needed(stored, queries, 5).collect()
    assert len(needed) == 50
    assert sum(r.blocks for r in needed) < 0.2 * sum(r.stored for r in needed)


def test_odd_rows_and_queries(spark):
    schema = "id long, features array<double>"
    rows = [(1, [1.0, 0.0]), (2, None), (None, [9.0, 9.0]), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (5, [0.0, None]), (6, [0.0, 0.0])]
    table = spark.createDataFrame(rows, schema)
    stored = innertop.store_by_norm(table)
    got = innertop.top_inner(stored, table, 5).collect()
    assert {(r["query"], r["id"], r["score"], r["rank"]) for r in got} == {(1, 1, 1.0, 1), (1, 6, 0.0, 2), (6, 1, 0.0, 1), (6, 6, 0.0, 2)}
    assert innertop.top_inner(stored, table.limit(0), 5).count() == 0
    empty = innertop.store_by_norm(table.limit(0))
    assert innertop.top_inner(empty, table, 5).count() == 0
    assert [r.blocks for r in innertop.blocks_needed(empty, table, 5).collect()] == [0, 0]


def test_copies_of_the_queries_do_not_pass_the_driver(spark):
    rows = spark.createDataFrame([(i, [float(i % 7), float(i % 5)]) for i in range(60)], "id long, features array<double>")
    found = innertop.top_inner(innertop.store_by_norm(rows, block=4), rows.filter("id % 20 = 0"), 3)
    assert found.count() == 9
    rows = found.collect()
    assert len(rows) == 9 and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
