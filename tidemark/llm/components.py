"""Connected components of a graph given as a DataFrame of edges.

Randomised contraction: in each round every node goes over to the neighbour (or
itself) with the lowest hash, edges are renamed and those that became loops
vanish. About a third of the nodes or more go in each round whatever the shape,
so the rounds are logarithmic in the nodes. A round only takes minima per node,
which combine before the shuffle, and joins with one row per node, where Spark
can split a node with very many edges.
(Boegeholz, Brand, Todor: In-database connected component analysis, 2020.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import discard, written


def _renamed(frame: DataFrame, column: str, names: DataFrame) -> DataFrame:
    other = names.select(F.col("node").alias("_node"), F.col("to").alias("_to"))
    return frame.join(other, F.col(column) == F.col("_node"), "left").withColumn(column, F.coalesce("_to", column)).drop("_node", "_to")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b`` (longs); a component is named by its smallest node.

    Null ends, loops and repeated edges are allowed and change nothing; no edges give no rows.
    """
    edges = start = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a is not null and a < b").distinct())
    moves, seed = [], 0
    while not edges.isEmpty():
        seed += 1
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(seed)).alias("h"), F.col(c).alias("node"))
        best = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("best"))
        best = written(best.select("node", F.least("best", rank("node"))["node"].alias("to")))
        moves.append(best)
        renamed = _renamed(_renamed(edges, "a", best), "b", best)
        renamed = renamed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
        renamed = written(renamed)
        discard(edges)
        edges = renamed
    if not moves:
        return start.select(F.col("a").alias("node"), F.col("b").alias("component"))
    place = moves[0].select("node", "to")
    for best in moves[1:]:
        place = _renamed(place, "to", best)
    place = written(place)
    names = place.groupBy("to").agg(F.min("node").alias("component"))
    out = written(place.join(names, "to").select("node", "component"))
    discard(edges, place, *moves)
    return out


def joined_components(components: DataFrame, edges: DataFrame) -> DataFrame:
    """Components after more edges, from those before; only the edges between components are looked at."""
    ends = edges.select("a", "b")
    for end in "ab":
        ends = _renamed(ends, end, components.select("node", F.col("component").alias("to")))
    merged = connected_components(ends)
    fresh = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(components, "node", "left_anti")
    nodes = components.select("node", "component").union(fresh.select("node", F.col("node").alias("component")))
    named = _renamed(nodes, "component", merged.select("node", F.col("component").alias("to")))
    out = written(named)
    discard(components, merged)
    return out
