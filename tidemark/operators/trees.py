"""Decision trees grown for several settings in the same passes.

Features are cut into bins once, at their exact quantiles, and the points stored as
bin codes. As long as a node has many points, one pass over them counts classes
per (tree, node, feature, bin) for all trees together and the counts, merged by
a shuffle, give the best splits of the level. A node that has become small goes,
with its points, to one task that grows the rest of its tree. A tree of less depth
is the upper part of a deeper one, so settings that differ in depth share a tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tidemark.session import discard, written

#: Points of a node that one task takes over.
LOCAL = 50_000
#: Counters of one pass in a task.
COUNTERS = 1 << 23
#: Decimals in which the gains of splits are compared; equal ones go to the lowest feature, then the lowest bin.
DECIMALS = 6
_SKETCH = 10_000
#: Slices of a feature among which its quantiles are looked for.
SLICES = 2048


@dataclass
class Tree:
    """Nodes by number, children of i being 2i and 2i + 1: split feature and bin, and the commonest class."""

    impurity: str
    bins: int
    feature: dict[int, int] = field(default_factory=dict)
    code: dict[int, int] = field(default_factory=dict)
    label: dict[int, int] = field(default_factory=dict)


def bin_edges(points: DataFrame, bins: tuple[int, ...]) -> dict[int, list[np.ndarray]]:
    """For each number of bins, the edges of every feature: its distinct quantiles. A value belongs to the first edge not below it.

    Quantiles are exact. A sketch cuts every feature into slices, one aggregate counts their values, and only the
    slices that hold a wanted rank are looked at value by value; equal values are counted, not listed.
    """
    cells = points.select(F.posexplode("features").alias("feature", "x")).select("feature", F.col("x").cast("double").alias("x")).filter("x is not null")
    shares = F.array(*(F.lit(i / SLICES) for i in range(1, SLICES)))
    rows = cells.groupBy("feature").agg(F.count("*").alias("n"), F.percentile_approx("x", shares, _SKETCH).alias("cuts")).orderBy("feature").collect()
    out: dict[int, list[np.ndarray]] = {n: [] for n in bins}
    if not rows:
        return out
    cuts = {r["feature"]: np.unique(r["cuts"]) for r in rows}
    # Ranks from 1, as a share of the values is rounded up.
    ranks = {r["feature"]: {n: [max(math.ceil(i / n * r["n"]), 1) for i in range(1, n)] for n in bins} for r in rows}
    width = max(cuts) + 1

    def sliced(features: np.ndarray, x: np.ndarray) -> np.ndarray:
        places = np.empty(len(x), dtype=np.int32)
        for f, c in cuts.items():
            mine = features == f
            places[mine] = np.searchsorted(c, x[mine], side="left")
        return places

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((width, SLICES), dtype=np.int64)
        for batch in batches:
            features, x = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            sums += np.bincount(features.astype(np.int64) * SLICES + sliced(features, x), minlength=sums.size).reshape(sums.shape)
        feature, place = np.nonzero(sums)
        yield pa.record_batch([pa.array(feature.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(sums[feature, place])], names=["feature", "slice", "n"])

    sizes = np.zeros((width, SLICES), dtype=np.int64)
    for r in cells.mapInArrow(counted, "feature int, slice int, n long").groupBy("feature", "slice").agg(F.sum("n").alias("n")).collect():
        sizes[r["feature"], r["slice"]] = r["n"]
    before = np.cumsum(sizes, axis=1) - sizes
    wanted: dict[tuple[int, int], set[int]] = {}
    for f, by_bins in ranks.items():
        for rank in {rank for many in by_bins.values() for rank in many}:
            place = int(np.searchsorted(before[f], rank, side="left")) - 1
            wanted.setdefault((f, place), set()).add(rank - int(before[f, place]))
    looked = np.zeros((width, SLICES), dtype=bool)
    for key in wanted:
        looked[key] = True

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, x = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            places = sliced(features, x)
            mine = np.flatnonzero(looked[features, places])
            yield pa.record_batch([pa.array(features[mine]), pa.array(places[mine]), pa.array(x[mine])], names=["feature", "slice", "x"])

    values = cells.mapInArrow(picked, "feature int, slice int, x double").groupBy("feature", "slice", "x").agg(F.count("*").alias("n"))
    up_to = F.sum("n").over(Window.partitionBy("feature", "slice").orderBy("x"))
    asked = points.sparkSession.createDataFrame([(f, s, sorted(r)) for (f, s), r in wanted.items()], "feature int, slice int, ranks array<long>") if wanted else None
    found: dict[tuple[int, int], float] = {}
    if asked is not None:
        held = values.withColumn("up_to", up_to).join(F.broadcast(asked), ["feature", "slice"])
        held = held.withColumn("ranks", F.filter("ranks", lambda r: (r <= F.col("up_to")) & (r > F.col("up_to") - F.col("n"))))
        # One row per feature and rank at most.
        for r in held.filter(F.size("ranks") > 0).select("feature", "slice", "x", "ranks").collect():
            for rank in r["ranks"]:
                found[r["feature"], int(before[r["feature"], r["slice"]]) + rank] = r["x"]
    for f in sorted(ranks):
        for n in bins:
            out[n].append(np.unique([found[f, rank] for rank in ranks[f][n]]) if n > 1 else np.zeros(0))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _codes(table: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, table[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint16)


def _score(left: np.ndarray, impurity: str, right: np.ndarray) -> np.ndarray:
    """Purity of both sides together, more being better; classes are the last axis."""
    if impurity == "gini":
        parts = [(c * c).sum(axis=-1) / np.maximum(c.sum(axis=-1), 1) for c in (left, right)]
    else:
        xlogx = lambda n: n * np.log(np.maximum(n, 1))
        parts = [xlogx(c).sum(axis=-1) - xlogx(c.sum(axis=-1)) for c in (left, right)]
    return np.round(parts[0] + parts[1], DECIMALS)


def _best(left: np.ndarray, total: np.ndarray, codes: np.ndarray, feature: np.ndarray, impurity: str) -> tuple[float, int, int] | None:
    """The best of the cuts with class counts ``left``; None if none is better than no cut."""
    inside = (left.sum(axis=1) > 0) & (left.sum(axis=1) < total.sum())
    if not inside.any():
        return None
    left, codes, feature = left[inside], codes[inside], feature[inside]
    score = _score(left, impurity, total - left)
    best = np.lexsort((codes, feature, -score))[0]
    if score[best] <= _score(total[None], impurity, np.zeros_like(total)[None])[0]:
        return None
    return float(score[best]), int(feature[best]), int(codes[best])


def _grow(codes: np.ndarray, labels: np.ndarray, classes: int, tree: Tree, root: int, depth: int) -> None:
    """The subtree below ``root`` of at most ``depth`` levels, from all its points."""
    width = codes.shape[1]
    step = max((1 << 24) // max(len(codes) * classes, 1), 1)
    stack = [(root, np.arange(len(codes)), depth)]
    while stack:
        node, rows, left = stack.pop()
        total = np.bincount(labels[rows], minlength=classes).astype(np.int64)
        tree.label[node] = int(total.argmax())
        if not left or (total > 0).sum() < 2:
            continue
        found = None
        for lo in range(0, width, step):
            part = codes[rows, lo : lo + step]
            order = np.argsort(part, axis=0, kind="stable")
            ranked = np.take_along_axis(part, order, axis=0)
            seen = np.zeros((*ranked.shape, classes), dtype=np.int32)
            np.put_along_axis(seen, labels[rows][order][..., None], 1, axis=2)
            row, col = np.nonzero(ranked[1:] != ranked[:-1])
            counts = np.cumsum(seen, axis=0)[row, col].astype(np.int64)
            cut = _best(counts, total, ranked[row, col].astype(np.int64), col + lo, tree.impurity) if len(row) else None
            if cut and (found is None or cut[0] > found[0]):
                found = cut
        if found is None:
            continue
        _, tree.feature[node], tree.code[node] = found
        right = codes[rows, found[1]] > found[2]
        stack += [(2 * node, rows[~right], left - 1), (2 * node + 1, rows[right], left - 1)]


def _nodes(codes: np.ndarray, tree: Tree, depth: int) -> np.ndarray:
    """The node that each row reaches within ``depth`` levels."""
    at = np.ones(len(codes), dtype=np.int64)
    names = np.array(sorted(tree.feature), dtype=np.int64)
    if not len(names):
        return at
    feature, code = (np.array([d[n] for n in names.tolist()]) for d in (tree.feature, tree.code))
    for _ in range(depth):
        place = np.minimum(np.searchsorted(names, at), len(names) - 1)
        inner = names[place] == at
        if not inner.any():
            break
        rows = np.flatnonzero(inner)
        p = place[rows]
        at[rows] = 2 * at[rows] + (codes[rows, feature[p]] > code[p])
    return at


@dataclass
class Forest:
    """Trees by (impurity, bins), the bins' edges and the number of classes."""

    trees: dict[tuple[str, int], Tree]
    edges: dict[int, list[np.ndarray]]
    classes: int
    depth: int


def grow(points: DataFrame, settings: list[tuple[str, int]], depth: int) -> Forest:
    """A tree for each (impurity, bins) on ``(label, features)``, ``depth`` levels deep.

    Labels are whole numbers from 0; points without a label or features are left
    out. The trees reach the driver, one row per node; no points give none.
    """
    points = points.filter("label is not null and features is not null").select(F.col("label").cast("int").alias("label"), "features")
    bins = tuple(sorted({b for _, b in settings}))
    edges = bin_edges(points, bins)
    width = len(edges[bins[0]])
    forest = Forest({(i, b): Tree(i, b) for i, b in settings}, edges, 0, depth)
    if not width:
        return forest

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = _matrix(batch.column(1), width)
                columns = [_codes(table, edges[b]) for b in bins]
                rows = [pa.array([r.tobytes() for r in c], pa.binary()) for c in columns]
                yield pa.RecordBatch.from_arrays([batch.column(0), *rows], ["label", *(f"b{b}" for b in bins)])

    stored = written(points.mapInArrow(coded, "label int, " + ", ".join(f"b{b} binary" for b in bins)))
    classes = forest.classes = stored.agg(F.max("label").alias("n")).first()["n"] + 1
    counts = stored.groupBy("label").agg(F.count("*").alias("n")).collect()
    root = np.zeros(classes, dtype=np.int64)
    root[[r.label for r in counts]] = [r.n for r in counts]
    # Nodes that are still to be split, with their class counts.
    open_nodes = {key: {1: root} for key in forest.trees}
    local: dict[tuple[str, int], dict[int, np.ndarray]] = {key: {} for key in forest.trees}
    for level in range(depth + 1):
        for key, nodes in open_nodes.items():
            for n in [n for n, c in nodes.items() if c.sum() <= LOCAL]:
                local[key][n] = nodes.pop(n)
            for n, c in nodes.items():
                forest.trees[key].label[n] = int(c.argmax())
        if level == depth or not any(open_nodes.values()):
            break
        splits = _level(stored, forest, open_nodes, level, width)
        grown = {}
        for key, nodes in open_nodes.items():
            grown[key] = {}
            for n in nodes:
                if (key, n) in splits:
                    _, forest.trees[key].feature[n], forest.trees[key].code[n], left = splits[key, n]
                    grown[key] |= {2 * n: left, 2 * n + 1: nodes[n] - left}
        open_nodes = grown
    _finish(stored, forest, local, width)
    discard(stored)
    return forest


def _rows_of(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), dtype=np.uint16).reshape(-1, width)


def _level(stored: DataFrame, forest: Forest, open_nodes: dict, level: int, width: int) -> dict:
    """Best split of every open node, with the class counts of its left side."""
    classes, trees, out = forest.classes, forest.trees, {}
    wanted = [(key, n) for key, nodes in open_nodes.items() for n in nodes]
    while wanted:
        # As many nodes as the counters of a task allow.
        taken, size = [], 0
        while wanted and (not taken or size + width * wanted[0][0][1] * classes <= COUNTERS):
            taken.append(wanted.pop(0))
            size += width * taken[-1][0][1] * classes
        out |= _counted(stored, {k: trees[k] for k, _ in taken}, taken, {t: open_nodes[t[0]][t[1]] for t in taken}, level, width, classes)
    return out


def _counted(stored: DataFrame, trees: dict, taken: list, totals: dict, level: int, width: int, classes: int) -> dict:
    places = {t: i for i, t in enumerate(taken)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((width, t[0][1], classes), dtype=np.int64) for t in taken}
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = batch.column("label").to_numpy()
            for key, tree in trees.items():
                codes = _rows_of(batch, f"b{key[1]}", width)
                at = _nodes(codes, tree, level)
                for t in (t for t in taken if t[0] == key):
                    rows = np.flatnonzero(at == t[1])
                    flat = (np.arange(width) * key[1] + codes[rows]) * classes + labels[rows, None]
                    sums[t] += np.bincount(flat.ravel(), minlength=width * key[1] * classes).reshape(width, key[1], classes)
        for t, table in sums.items():
            used = np.flatnonzero(table.any(axis=(1, 2)))
            if len(used):
                yield pa.record_batch(
                    [pa.array([places[t]] * len(used), pa.int32()), pa.array(used.astype(np.int32)), pa.array([table[f].tobytes() for f in used], pa.binary())],
                    names=["node", "feature", "counts"],
                )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def close():
            t = taken[now[0]]
            left = np.cumsum(total.reshape(t[0][1], classes), axis=0)
            cut = _best(left, totals[t], np.arange(len(left)), np.full(len(left), now[1]), t[0][0])
            rows = [(now[0], *cut, left[cut[2]].tobytes())] if cut else []
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True) if rows else [[]] * 5, [pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.binary()], strict=True)]
            return pa.record_batch(columns, names=["node", "score", "feature", "code", "left"])

        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                value = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.int64)
                if key != now:
                    if now is not None:
                        yield close()
                    now, total = key, value
                else:
                    total = total + value
        if now is not None:
            yield close()

    sums = stored.mapInArrow(count, "node int, feature int, counts binary")
    partitions = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sums.repartition(partitions, "node", "feature").sortWithinPartitions("node", "feature")
    cuts = dealt.mapInArrow(split, "node int, score double, feature int, code int, left binary")
    best = cuts.groupBy("node").agg(F.max_by(F.struct("score", "feature", "code", "left"), F.struct("score", -F.col("feature"), -F.col("code"))).alias("b"))
    return {taken[r.node]: (r.b.score, r.b.feature, r.b.code, np.frombuffer(bytes(r.b.left), dtype=np.int64)) for r in best.collect()}


def _finish(stored: DataFrame, forest: Forest, local: dict, width: int) -> None:
    """Grow the small nodes, each in one task, and add what comes out to the trees."""
    keys, depth, classes = [k for k in forest.trees if local[k]], forest.depth, forest.classes
    trees, wanted = [forest.trees[k] for k in keys], [np.array(sorted(local[k]), dtype=np.int64) for k in keys]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for i, (key, tree) in enumerate(zip(keys, trees, strict=True)):
                at = _nodes(_rows_of(batch, f"b{key[1]}", width), tree, depth)
                rows = np.flatnonzero(np.isin(at, wanted[i]))
                yield pa.record_batch(
                    [pa.array(np.full(len(rows), i, dtype=np.int32)), pa.array(at[rows]), batch.column("label").take(pa.array(rows)), batch.column(f"b{key[1]}").take(pa.array(rows))],
                    names=["tree", "node", "label", "codes"],
                )

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def close():
            tree = Tree(*keys[now[0]])
            codes = np.frombuffer(b"".join(c for _, cs in parts for c in cs), dtype=np.uint16).reshape(-1, width)
            _grow(codes, np.concatenate([y for y, _ in parts]), classes, tree, now[1], depth - now[1].bit_length() + 1)
            nodes = list(tree.label)
            columns = [[now[0]] * len(nodes), nodes, *([d.get(n) for n in nodes] for d in (tree.label, tree.feature, tree.code))]
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["tree", "node", "label", "feature", "code"])

        for batch in batches:
            pairs = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (0, 1)], axis=1)
            edges = [0, *(np.flatnonzero((pairs[1:] != pairs[:-1]).any(axis=1)) + 1), len(pairs)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                key = (int(pairs[lo][0]), int(pairs[lo][1]))
                if key != now:
                    if now is not None:
                        yield close()
                    now, parts = key, []
                parts.append((batch.column(2).slice(lo, hi - lo).to_numpy(), batch.column(3).slice(lo, hi - lo).to_pylist()))
        if now is not None:
            yield close()

    if not keys:
        return
    rows = stored.mapInArrow(deal, "tree int, node long, label int, codes binary")
    # A few nodes are dealt one to a task; a hash would put some together and leave tasks without any.
    names = [(i, n) for i, w in enumerate(wanted) for n in w.tolist()]
    if len(names) <= 256:
        places = F.map_from_arrays(F.array(*(F.lit(f"{i} {n}") for i, n in names)), F.array(*map(F.lit, range(len(names)))))
        dealt = rows.repartitionById(len(names), places[F.concat_ws(" ", "tree", "node")].cast("int"))
    else:
        dealt = rows.repartition("tree", "node")
    for r in dealt.sortWithinPartitions("tree", "node").mapInArrow(grown, "tree int, node long, label int, feature int, code int").collect():
        tree = trees[r.tree]
        tree.label[r.node] = r.label
        if r.feature is not None:
            tree.feature[r.node], tree.code[r.node] = r.feature, r.code


def predict_all(forest: Forest, points: DataFrame, depths: tuple[int, ...]) -> DataFrame:
    """The points with ``predictions``: one for each tree of the forest and each depth, in this order (trees sorted)."""
    keys = sorted(forest.trees)
    width, trees, edges = len(next(iter(forest.edges.values()))), forest.trees, forest.edges

    def run(table: pa.Array) -> pa.Array:
        values = _matrix(table, width)
        coded = {b: _codes(values, edges[b]) for b in {b for _, b in keys}}
        out = []
        for key in keys:
            names = np.array(sorted(trees[key].label), dtype=np.int64)
            labels = np.array([trees[key].label[n] for n in names.tolist()], dtype=np.int32)
            for depth in depths:
                out.append(labels[np.searchsorted(names, _nodes(coded[key[1]], trees[key], depth))])
        flat = np.stack(out, axis=1) if len(values) else np.zeros((0, len(out)), dtype=np.int32)
        ends = np.arange(len(values) + 1, dtype=np.int32) * len(out)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel().astype(np.int32)))

    udf = F.arrow_udf(run, ArrayType(IntegerType()))
    return points.filter("features is not null").withColumn("predictions", udf(F.col("features").cast("array<double>")))
