"""Trees grown in passes against a plain recursive one."""

import math
from collections import Counter

import numpy as np
import pytest

from tidemark.operators import classify, trees


def purity(labels, impurity):
    counts, n = Counter(labels), len(labels)
    if not n:
        return 0.0
    if impurity == "gini":
        return sum(c * c for c in counts.values()) / n
    return sum(c * math.log(c) for c in counts.values()) - n * math.log(n)


def plain(codes, labels, impurity, depth):
    """Nested (feature, code, left, right) or a label."""
    label = min(Counter(labels).items(), key=lambda x: (-x[1], x[0]))[0]
    best = None
    if depth:
        for f in range(len(codes[0])):
            for c in sorted({r[f] for r in codes})[:-1]:
                left = [y for r, y in zip(codes, labels, strict=True) if r[f] <= c]
                right = [y for r, y in zip(codes, labels, strict=True) if r[f] > c]
                score = round(purity(left, impurity) + purity(right, impurity), 6)
                if best is None or score > best[0]:
                    best = (score, f, c)
    if best is None or best[0] <= round(purity(labels, impurity), 6):
        return label
    _, f, c = best
    sides = [[(r, y) for r, y in zip(codes, labels, strict=True) if (r[f] > c) == side] for side in (False, True)]
    return (f, c, *(plain([r for r, _ in s], [y for _, y in s], impurity, depth - 1) for s in sides))


def nested(tree, node=1):
    if node not in tree.feature:
        return tree.label[node]
    return (tree.feature[node], tree.code[node], nested(tree, 2 * node), nested(tree, 2 * node + 1))


@pytest.fixture(scope="module")
def table():
    r = np.random.default_rng(5)
    x = np.round(r.standard_normal((90, 4)), 1)
    y = (x[:, 0] > 0).astype(int) + (x[:, 2] > 0.5) + (r.random(90) < 0.1)
    return x, y


@pytest.mark.parametrize("local, counters", [(10**6, 10**6), (20, 10**6), (5, 200)])
def test_equals_a_plain_tree(spark, monkeypatch, table, local, counters):
    x, y = table
    monkeypatch.setattr(trees, "LOCAL", local)
    monkeypatch.setattr(trees, "COUNTERS", counters)
    points = spark.createDataFrame([(int(b), [float(v) for v in a]) for a, b in zip(x, y, strict=True)] + [(None, [0.0] * 4), (1, None)], "label int, features array<double>")
    settings = [(i, b) for i in ("gini", "entropy") for b in (3, 40)]
    forest = trees.grow(points.repartition(3), settings, 5)
    for (impurity, bins), tree in forest.trees.items():
        edges = forest.edges[bins]
        for f in range(4):
            ranked = np.sort(x[:, f])
            assert edges[f].tolist() == sorted({ranked[max(math.ceil(i / bins * 90), 1) - 1] for i in range(1, bins)})
        codes = [[int((edges[f] < row[f]).sum()) for f in range(4)] for row in x]
        assert nested(tree) == plain(codes, y.tolist(), impurity, 5)


def test_predictions_at_several_depths(spark, table):
    x, y = table
    points = spark.createDataFrame([(int(b), [float(v) for v in a]) for a, b in zip(x, y, strict=True)], "label int, features array<double>")
    forest = trees.grow(points, [("gini", 40)], 6)
    rows = trees.predict_all(forest, points, (0, 1, 6)).collect()
    hits = [sum(r.predictions[j] == r.label for r in rows) for j in range(3)]
    assert hits[0] == max(Counter(y.tolist()).values()) <= hits[1] <= hits[2]
    one = {(tuple(r.features), r.prediction) for r in classify.predict_one(points, points, "gini", 6, 40).collect()}
    assert one == {(tuple(r.features), r.predictions[2]) for r in rows}


def test_one_class_equal_points_and_none(spark):
    same = spark.createDataFrame([(1, [0.5, 0.5])] * 30 + [(2, [0.5, 0.5])] * 5, "label int, features array<double>")
    (tree,) = trees.grow(same, [("gini", 10)], 3).trees.values()
    assert tree.label == {1: 1} and not tree.feature
    (tree,) = trees.grow(same.filter("label = 2"), [("entropy", 10)], 3).trees.values()
    assert tree.label == {1: 2}
    assert trees.grow(same.limit(0), [("gini", 10)], 3).classes == 0
    grid = classify.grid_search(same, same, depths=(1, 2), bins=(4,)).collect()
    assert len(grid) == 4 and {r.accuracy for r in grid} == {30 / 35}


def test_edges_are_exact_quantiles_of_many_values(spark):
    x = np.random.default_rng(8).standard_normal((30_000, 2)).round(5)
    x[:9000, 1] = 0.25  # one value that holds many ranks
    rows = spark.createDataFrame(x.tolist(), "a double, b double").selectExpr("array(a, b) features")
    for bins, edges in trees.bin_edges(rows.repartition(5), (10, 300)).items():
        for f in range(2):
            ranked = np.sort(x[:, f])
            assert edges[f].tolist() == sorted({ranked[max(math.ceil(i / bins * 30_000), 1) - 1] for i in range(1, bins)})
