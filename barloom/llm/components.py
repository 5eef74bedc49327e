"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


class Forest:
    """Union-find over any hashable nodes; the smallest node of a tree is its root."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, node):
        path = []
        while (up := self.parent.get(node, node)) != node:
            path.append(node)
            node = up
        for p in path:
            self.parent[p] = node
        return node

    def unite(self, a, b) -> bool:
        """Joins two trees; false if they were one."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        low, high = (a, b) if a < b else (b, a)
        self.parent[high] = low
        self.parent.setdefault(low, low)
        return True


def _contracted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of one partition as stars, block by block."""
    for frame in frames:
        forest = Forest()
        for a, b in zip(frame["a"], frame["b"]):
            forest.unite(a, b)
        nodes = [n for n in forest.parent if forest.root(n) != n]
        yield pd.DataFrame({"a": nodes, "b": [forest.root(n) for n in nodes]})


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is its component's smallest node.

    Each block of edges is reduced by union-find, then large-star and small-star
    steps alternate until nothing changes. Every step is two shuffles of the edges, and
    is written to the shared folder. Null ends are dropped.
    """
    kind = edges.schema["a"].dataType.simpleString()
    shape = f"a {kind}, b {kind}"
    proper = edges.select("a", "b").filter("a is not null and b is not null and a <> b")
    # from here on a is the larger end
    stars = stored(proper.mapInPandas(_contracted, shape).distinct(), "edges")
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        # large star: all larger neighbours of a node go to its smallest neighbour
        large = (
            both.filter("b > a")
            .join(lowest, "a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        large = stored(large, "edges")
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        small = stored(small, "edges")
        if small.groupBy("a").count().filter("count > 1").isEmpty() and small.join(
            small.select(F.col("a").alias("b")), "b", "left_semi"
        ).isEmpty():
            roots = small.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
        stars = small
