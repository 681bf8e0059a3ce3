"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Vectors are compared only within a group (equal label and length). Equal vectors
of a group, told by a digest of 128 bits, are one class with a count. Cells come
from spherical k-means on a sample; every vector is at home in the cell of its
nearest centre. A vector x at home in c lies ``s = (x.c - x.d) / |c - d|`` in front
of the plane between c and d, and a vector y at home in d as far behind it as its
own ``s`` tells, so ``|x - y|`` is at least the sum of both. Guests of a cell are
the vectors whose ``s`` allows a partner within the angle, so no link is lost,
however good the centres are.

Vectors are stored once, by ranges of cells, and never copied: a task holds one
stored part and reads the others of its group from the shared folder. Pairs that the
planes leave are compared along a few axes first, which bounds the cosine from
above, and in double precision where that bound reaches the cosine. A task yields
counts and a spanning set of its links, never its pairs.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import connected_components
from tidemark.session import discard, remove, storage, stored, written

#: Vectors that the centres are fit to; they are gathered on the driver.
SAMPLE = 20_000
#: Vectors that a cell should hold, and sampled vectors that a centre needs.
CELL, PER_CENTRE = 512, 16
#: Vectors of one stored row, and of one stored part about.
BLOCK, PART = 1024, 1 << 15
#: Rows and columns of the products that are made at a time.
HIGH, WIDE = 256, 1024
#: Axes of the first comparison; one more holds the length of the rest.
AXES = 15
#: Links that a task holds before they are reduced to a spanning set.
EDGES = 1 << 18
ROUNDS = 8
#: Far above the error of single precision in a product of unit vectors.
SLACK = 1e-5
STORED = "part int, group string, cell int, ids binary, counts binary, one binary, two binary, vectors binary"


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of unit length in double precision."""
    x = np.asarray(rows, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def centres(x: np.ndarray, k: int) -> np.ndarray:
    """``k`` unit centres of unit rows; empty ones stay where they were."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        home = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        size = np.sqrt((total * total).sum(axis=1))
        moved = size > 1e-12
        c[moved] = total[moved] / size[moved][:, None]
    return c


def _place(one: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """A number that orders the vectors of a group by cell, and in a cell by digest."""
    return cell + one.view(np.uint64) / 2.0**64


@dataclass(frozen=True)
class Model:
    """Per group the centres, the first of its parts and the places where the next ones begin; per length the axes."""

    centres: dict[str, np.ndarray]
    cuts: dict[str, tuple[int, np.ndarray]]
    axes: dict[int, np.ndarray]
    parts: int

    def home(self, group: str, x: np.ndarray) -> np.ndarray:
        if group not in self.centres:
            return np.zeros(len(x), dtype=np.int32)
        return (x @ self.centres[group].T).argmax(axis=1).astype(np.int32)

    def part(self, group: str, place: np.ndarray) -> np.ndarray:
        if group not in self.cuts:
            return np.full(len(place), zlib.crc32(group.encode()) % self.parts, dtype=np.int32)
        first, cuts = self.cuts[group]
        return (first + np.searchsorted(cuts, place, side="right")).astype(np.int32)

    def coarse(self, x: np.ndarray) -> np.ndarray:
        """Rows along the axes and the length of what is left, in single precision: products are at least those of the rows."""
        axes = self.axes.get(x.shape[1], np.eye(x.shape[1])[:, :AXES])
        near = x @ axes
        left = np.sqrt(np.maximum(1 - (near * near).sum(axis=1), 0))
        return np.column_stack([near, left]).astype(np.float32)


def fit(rows: DataFrame, partitions: int, sample: int = SAMPLE) -> Model:
    """Centres per group that has more vectors than a cell should hold, at most ``sample / PER_CENTRE`` in all, and parts of
    about equal size; ``rows`` has ``group, vector, one, two``."""
    total = rows.count()
    parts = max(partitions, -(-total // PART))
    share = F.lit(int(min(sample / max(total, 1), 1) * (1 << 30)))
    drawn = rows.filter(F.pmod("two", F.lit(1 << 30)) < share).dropDuplicates(["one", "two"]).select("group", "vector", "one").limit(2 * sample)
    drawn = drawn.toArrow().combine_chunks().sort_by([("group", "ascending"), ("one", "ascending")])
    found, cuts, seen, first = {}, {}, defaultdict(list), 0
    groups = np.array(drawn.column("group").to_pylist(), dtype=object)
    for g, lo, hi in _runs(groups):
        some = drawn.slice(lo, hi - lo)
        x = unit(_matrix(some.column("vector").combine_chunks()))
        seen[x.shape[1]].append(x)
        k = min(math.ceil(len(x) * total / len(groups) / CELL), len(x) // PER_CENTRE)
        cell = np.zeros(len(x))
        if k > 1:
            found[g] = centres(x, k)
            cell = (x @ found[g].T).argmax(axis=1)
        mine = round(parts * len(x) / len(groups))
        if mine:
            place = np.sort(_place(some.column("one").to_numpy(), cell))
            cuts[g] = first, place[np.arange(1, mine) * len(x) // mine]
            first += mine
    axes = {}
    for width, xs in seen.items():
        x = np.vstack(xs)
        axes[width] = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :AXES]
    return Model(found, cuts, axes, max(parts, first))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _binary(table: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    table = np.ascontiguousarray(table)
    ends = np.arange(len(table) + 1, dtype=np.int32) * (table.shape[1] * table.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(table), [None, pa.py_buffer(ends), pa.py_buffer(table)])


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)))


def _runs(names: np.ndarray) -> list[tuple[str, int, int]]:
    if not len(names):
        return []
    first = _changes(names)
    return [(names[lo], int(lo), int(hi)) for lo, hi in zip(first, np.append(first[1:], len(names)), strict=True)]


def _celled(model: Model):
    """``group, id, vector, one, two`` to a row per class of the batch, with its part and home cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, one, two = batch.column(1), batch.column(3).to_numpy(), batch.column(4).to_numpy()
            order = np.lexsort((pc.fill_null(ids, 0).to_numpy(), pc.is_null(ids).to_numpy(zero_copy_only=False), two, one))
            first = _changes(one[order], two[order])
            counts, batch = np.diff(np.append(first, len(order))), batch.take(pa.array(order[first]))
            lengths = pc.list_value_length(batch.column(2)).to_numpy()
            for width in np.unique(lengths):
                mine = np.flatnonzero(lengths == width)
                some = batch.take(pa.array(mine))
                raw, one = _matrix(some.column(2)), some.column(3).to_numpy()
                x, coded = unit(raw), some.column(0).dictionary_encode()
                codes = coded.indices.to_numpy()
                by_group = np.argsort(codes, kind="stable")
                part, cell = np.empty(len(x), dtype=np.int32), np.empty(len(x), dtype=np.int32)
                for rows in np.split(by_group, _changes(codes[by_group])[1:]):
                    g = coded.dictionary[int(codes[rows[0]])].as_py()
                    cell[rows] = model.home(g, x[rows])
                    part[rows] = model.part(g, _place(one[rows], cell[rows]))
                columns = [pa.array(part), some.column(0), pa.array(cell), some.column(1), pa.array(counts[mine].astype(np.int64)), some.column(3), some.column(4), _binary(raw)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "group", "cell", "id", "n", "one", "two", "vector"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, group, cell and digest to ``STORED`` rows of up to ``BLOCK`` classes; classes without an id are left out."""

    def row(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        one, two = t.column("one").to_numpy(), t.column("two").to_numpy()
        first = _changes(one, two)
        ids = t.column("id")
        known = np.flatnonzero(np.logical_or.reduceat(pc.is_valid(ids).to_numpy(), first))
        if not len(known):
            return
        least = np.minimum.reduceat(pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy(), first)[known]
        counts, at = np.add.reduceat(t.column("n").to_numpy(), first)[known], first[known]
        vectors = b"".join(t.column("vector").take(pa.array(at)).to_pylist())
        blobs = [pa.array([v if isinstance(v, bytes) else v.tobytes()], pa.binary()) for v in (least, counts, one[at], two[at], vectors)]
        heads = [t.column(c).combine_chunks().slice(0, 1) for c in ("part", "group", "cell")]
        yield pa.RecordBatch.from_arrays([*heads, *blobs], ["part", "group", "cell", "ids", "counts", "one", "two", "vectors"])

    held, last, classes = [], None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        part, cell, one, two = (batch.column(c).to_numpy() for c in ("part", "cell", "one", "two"))
        group = batch.column("group").dictionary_encode()
        first = _changes(part, group.indices.to_numpy(), cell, one, two)
        ends, lo = np.append(first[1:], len(part)), 0
        names = group.dictionary.to_pylist()
        codes = group.indices.to_numpy()
        for at, end in zip(first, ends, strict=True):
            key = (part[at], names[codes[at]], cell[at])
            digest = (one[at], two[at])
            if last is not None and (key, digest) == last:
                continue
            if last is not None and (key != last[0] or classes == BLOCK):
                if at > lo:
                    held.append(batch.slice(lo, at - lo))
                yield from row(held)
                held, lo, classes = [], at, 0
            last, classes = (key, digest), classes + 1
        held.append(batch.slice(lo))
    if held:
        yield from row(held)


def _spread(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the same components as the links ``near`` between rows ``a`` and ``b``: each linked row with its smallest reachable id."""
    rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near, a, b = near[np.ix_(rows, cols)], a[rows], b[cols]
    # The component of the row with most links is taken out at once; in a large group it is all there is.
    mine = np.zeros(len(a), dtype=bool)
    mine[np.count_nonzero(near, axis=1).argmax()] = True
    while True:
        there = near[mine].any(axis=0)
        grown = near[:, there].any(axis=1)
        if grown.sum() == mine.sum():
            break
        mine = grown
    ids = np.concatenate([a[mine], b[there]])
    low = np.full(len(ids), ids.min())
    if mine.all() and there.all():
        return ids, low
    near, a, b, big = near[np.ix_(~mine, ~there)], a[~mine], b[~there], np.iinfo(np.int64).max
    left, right = a.copy(), b.copy()
    while True:
        new_left = np.minimum(left, np.where(near, right[None, :], big).min(axis=1, initial=big))
        new_right = np.minimum(right, np.where(near, new_left[:, None], big).min(axis=0, initial=big))
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    return np.concatenate([ids, a, b]), np.concatenate([low, left, right])


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one edge for each node, to the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.split(at, 2)
    name = np.arange(len(nodes))
    while True:
        low, high = np.minimum(name[x], name[y]), np.maximum(name[x], name[y])
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(name, high[apart], low[apart])
        while (name[name] != name).any():
            name = name[name]
    moved = name != np.arange(len(nodes))
    return nodes[moved], nodes[name[moved]]


class _Links:
    """The spanning edges of a task."""

    def __init__(self) -> None:
        self.a, self.b, self.held = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        use = a != b
        self.a.append(a[use])
        self.b.append(b[use])
        self.held += int(use.sum())

    def reduce(self) -> None:
        a, b = _forest(np.concatenate(self.a), np.concatenate(self.b)) if self.held else (np.zeros(0, dtype=np.int64),) * 2
        self.a, self.b, self.held = [a], [b], len(a)


class _Rows:
    """The vectors of one group in one part."""

    def __init__(self, model: Model, group: str, table: pa.Table, kind: str):
        numbers = lambda c, k: np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=k)
        sizes = np.array([len(v) // 8 for v in table.column("ids").to_pylist()])
        self.ids, self.counts = numbers("ids", np.int64), numbers("counts", np.int64)
        self.cell = np.repeat(table.column("cell").to_numpy(), sizes)
        self.x = unit(numbers("vectors", kind).reshape(len(self.ids), -1))
        self.single = self.x.astype(np.float32)
        self.coarse = model.coarse(self.x)
        self.links = np.zeros(len(self.ids), dtype=np.int64)
        self.cells = {int(c): np.flatnonzero(self.cell == c) for c in np.unique(self.cell)}

    def in_front(self, rows: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How far the rows lie on their centre's side of the plane between two centres."""
        across = own - other
        length = np.sqrt(across @ across)
        return self.single[rows] @ (across / length if length > 1e-9 else np.zeros_like(across)).astype(np.float32)


def _compare(a: _Rows, b: _Rows, centre: np.ndarray | None, cosine: float, edges: _Links) -> None:
    """Count the links between the rows of two parts (or of one) and take in their edges."""
    reach = math.sqrt(max(2 - 2 * cosine, 0)) + SLACK
    for c, mine in a.cells.items():
        for d, theirs in b.cells.items():
            if a is b and d < c:
                continue
            rows, cols, same = mine, theirs, a is b and c == d
            ahead = np.zeros(len(rows), dtype=np.float32)
            behind = np.zeros(len(cols), dtype=np.float32)
            if c != d:
                ahead, behind = a.in_front(rows, centre[c], centre[d]), b.in_front(cols, centre[d], centre[c])
                guests, hosts = ahead <= reach - behind.min(), behind <= reach - ahead.min()
                rows, cols, ahead, behind = rows[guests], cols[hosts], ahead[guests], behind[hosts]
                by_row, by_col = np.argsort(ahead), np.argsort(behind)
                rows, cols, ahead, behind = rows[by_row], cols[by_col], ahead[by_row], behind[by_col]
            wide = a.coarse[rows], np.ascontiguousarray(b.coarse[cols].T)
            for lo in range(0, len(rows), HIGH):
                end = int(np.searchsorted(behind, reach - ahead[lo], side="right"))
                for left in range(lo if same else 0, end, WIDE):
                    above = wide[0][lo : lo + HIGH] @ wide[1][:, left : min(left + WIDE, end)]
                    if above.max() < cosine - SLACK:
                        continue
                    _verify(a, b, rows[lo : lo + HIGH], cols[left : min(left + WIDE, end)], above >= cosine - SLACK, lo - left if same else None, cosine, edges)


def _verify(a: _Rows, b: _Rows, rows: np.ndarray, cols: np.ndarray, near: np.ndarray, diagonal: int | None, cosine: float, edges: _Links) -> None:
    """The links among pairs that may be near; with ``diagonal`` both sides are one, and a pair counts where its column comes later."""
    if diagonal is not None:
        near &= np.arange(near.shape[1]) > np.arange(near.shape[0])[:, None] + diagonal
    rows, cols, near = rows[some := near.any(axis=1)], cols[others := near.any(axis=0)], near[np.ix_(some, others)]
    if not len(rows):
        return
    exact = (a.x[rows] @ b.x[cols].T) >= cosine
    near &= exact
    if not near.any():
        return
    # Counts of copies are whole numbers far below 2^53.
    links = near.astype(np.float64)
    a.links[rows] += (links @ b.counts[cols]).astype(np.int64)
    b.links[cols] += (a.counts[rows] @ links).astype(np.int64)
    edges.add(*_spread(near, a.ids[rows], b.ids[cols]))
    if edges.held > EDGES:
        edges.reduce()


def _compared(model: Model, path: str, kind: str, cosine: float, held: dict[str, list[int]]):
    """A number of a part to ``id, other, links``: spanning edges, or a count of links (other null)."""

    def read(part: int, groups: set[str]) -> dict[str, _Rows]:
        files, name = storage(f"{path}/part={part}")
        table = pads.dataset(name, format="parquet", filesystem=files).to_table(columns=["group", "cell", "ids", "counts", "vectors"], filter=pc.field("group").isin(sorted(groups)))
        table = table.sort_by([("group", "ascending"), ("cell", "ascending")])
        names = np.array(table.column("group").to_pylist(), dtype=object)
        return {g: _Rows(model, g, table.slice(lo, hi - lo), kind) for g, lo, hi in _runs(names)}

    def counted(rows: _Rows) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(rows.links)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(rows.ids[at]), pa.nulls(len(at), pa.int64()), pa.array(rows.links[at])], ["id", "other", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (int(p) for batch in batches for p in batch.column(0).to_pylist()):
            groups = {g for g, parts in held.items() if part in parts}
            if not groups:
                continue
            mine, edges = read(part, groups), _Links()
            for g, rows in mine.items():
                _compare(rows, rows, model.centres.get(g), cosine, edges)
            shared = defaultdict(set)
            for g in groups:
                for other in held[g]:
                    # Of two parts the lower one compares them where the sum of their numbers is odd, else the higher one.
                    if other != part and (other > part) == bool((other + part) % 2):
                        shared[other].add(g)
            for other, names in sorted(shared.items()):
                for g, rows in read(other, names).items():
                    _compare(mine[g], rows, model.centres.get(g), cosine, edges)
                    yield from counted(rows)
            for rows in mine.values():
                yield from counted(rows)
            edges.reduce()
            if edges.held:
                yield pa.RecordBatch.from_arrays([pa.array(edges.a[0]), pa.array(edges.b[0]), pa.array(np.zeros(edges.held, dtype=np.int64))], ["id", "other", "links"])

    return run


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stored rows to ``one, two, first, copies`` of their classes."""
    for batch in batches:
        if batch.num_rows:
            one, two, ids, counts = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.int64) for c in ("one", "two", "ids", "counts"))
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(ids), pa.array(counts - 1)], ["one", "two", "first", "copies"])


def near_duplicate_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98
) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row.

    Rows of one label are linked where the cosine in double precision reaches
    ``cosine``. Null labels, and vectors that are null, empty, zero or hold a null
    or non-finite component link with nothing and are their own component.
    Vectors of different length are not compared. Equal vectors link with each
    other and share their partners; a null key has a null component unless its
    vector has another key, and is never kept. An empty table gives an empty
    result. Columns beside the three named are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").cast("string").alias("label"))
    broken = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("label").isNotNull() & (F.size("vector") > 0) & ~broken & F.exists("vector", lambda v: v != 0)
    group = F.when(F.coalesce(usable, F.lit(False)), F.concat_ws("/", F.size("vector").cast("string"), "label"))
    rows = rows.select("id", "vector", group.alias("group"))
    digest = lambda *parts: F.when(F.col("group").isNotNull(), F.xxhash64(*parts))
    rows = rows.withColumn("one", digest("group", "vector")).withColumn("two", digest(F.lit(1), "group", "vector"))
    element = rows.schema["vector"].dataType.elementType.simpleString()
    if element not in ("float", "double"):
        rows, element = rows.withColumn("vector", F.col("vector").cast("array<double>")), "double"
    usable_rows = rows.filter("group is not null").select("group", "id", "vector", "one", "two")
    model = fit(usable_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    celled = usable_rows.mapInArrow(_celled(model), "part int, group string, cell int, id long, n long, one long, two long, vector binary")
    dealt = celled.repartitionById(model.parts, F.col("part")).sortWithinPartitions("part", "group", "cell", "one", "two")
    path = stored(dealt.mapInArrow(_packed, STORED), "part")
    blocks = spark.read.schema(STORED).parquet(path)
    held: dict[str, list[int]] = defaultdict(list)
    for r in blocks.select("group", "part").distinct().collect():
        held[r["group"]].append(r["part"])
    kind = "f4" if element == "float" else "f8"
    pairs = spark.range(0, model.parts, 1, model.parts).mapInArrow(_compared(model, path, kind, cosine, dict(held)), "id long, other long, links long")
    found = written(pairs)
    counts = found.filter("other is null").groupBy(F.col("id").alias("first")).agg(F.sum("links").alias("links"))
    components = connected_components(found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = blocks.select("one", "two", "ids", "counts").mapInArrow(_classes, "one long, two long, first long, copies long")
    named = named.join(counts, "first", "left").join(components, F.col("first") == F.col("node"), "left")
    named = named.select("one", "two", (F.col("copies") + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component"))
    named = written(named)
    discard(found)
    remove(spark, path)
    out = rows.select("id", "group", "one", "two").join(named, ["one", "two"], "left")
    component = F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
