"""Connected components of links, by joins and groupings.

Links point from a node to a smaller one. In a round each task reduces the links that
it reads to a forest, then the links of a node come together, and the node and those
it is linked to point to the smallest of them. Ahead of that a link to a node that
points on itself is moved to where that node points, which halves chains. So a round
has one join and one shuffle, and is written once. When no node has two links, chains
alone are left; they are halved by the join, without the shuffle. Rounds go on until
each component is a star around its smallest node; they grow with the logarithm of
the longest chain. A task gives a node one link at most for each NODES that it joins,
so the links that come together for a node are bounded by the tasks, not by its
neighbours, and a task's memory by NODES.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, staged

# Nodes that a task joins at once; with more, it goes on with the next rows' links apart.
NODES = 500_000


class Sets:
    """Disjoint sets; the smallest member stands for its set."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (above := self.up.get(root, root)) != root:
            root = above
        while (above := self.up.get(x, x)) != root:
            self.up[x] = root
            x = above
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links -> a link from each node to the smallest of those that they connect."""
    sets = Sets()
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            if len(sets.up) >= NODES:
                yield _pointed(sets)
                sets = Sets()
            sets.join(a, b)
    yield _pointed(sets)
    del sets
    give_back()


def _pointed(sets: Sets) -> pa.RecordBatch:
    nodes = list(sets.up)
    roots = [sets.find(x) for x in nodes]
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["a", "b"])


def _pulled(edges: DataFrame) -> DataFrame:
    """Each node that has links points to the smallest node that it is linked to (one
    row, ``own``), and so do the others that it is linked to."""
    near = Window.partitionBy("a").orderBy("b")
    rows = edges.mapInArrow(_forest, "a long, b long")
    rows = rows.select("a", "b", F.first("b").over(near).alias("least"), (F.row_number().over(near) == 1).alias("own"))
    rows = rows.filter(F.col("own") | (F.col("b") != F.col("least")))
    node = F.when(F.col("own"), F.col("a")).otherwise(F.col("b"))
    return staged(rows.select(node.alias("a"), F.col("least").alias("b"), "own"), "edges")


def _moved(edges: DataFrame) -> DataFrame:
    """Links to a node that points on, moved to where it points."""
    above = edges.filter("own").select(F.col("a").alias("b"), F.col("b").alias("above"))
    return edges.join(above, "b", "left").select("a", F.coalesce("above", "b").alias("b"), "own")


def _points_on(edges: DataFrame) -> bool:
    """Whether a link leads to a node that points on itself."""
    return not edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of the component) for all nodes that have a
    link to another node, except the roots. ``edges`` has a and b (long)."""
    edges = _pulled(edges.select("a", "b").filter(F.col("a") != F.col("b")))
    # Rows that are not ``own`` are of nodes that may have a row elsewhere.
    while not edges.filter(~F.col("own")).isEmpty():
        edges = _pulled(_moved(edges).select("a", "b"))
    while _points_on(edges):
        edges = staged(_moved(edges), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
