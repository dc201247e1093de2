"""Connected components over link tables, and the link forest that one task sends on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.llm.shared import staged


class Forest:
    """Labels of nodes 0 to n-1 of one task: links in, at most n-1 of them out.

    A task that meets all pairs of a dense group keeps one link for each node
    instead of the pairs.
    """

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        differ = a != b
        if not differ.any():
            return
        pairs = np.unique(np.stack([np.minimum(a, b)[differ], np.maximum(a, b)[differ]], 1), axis=0)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := root.get(x, x)) != x:
                root[x] = root.get(y, y)
                x = y
            return x

        for x, y in pairs.tolist():
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
        if root:
            to = np.arange(len(self.label))
            moved = np.fromiter(root, np.int64)
            to[moved] = [find(x) for x in moved.tolist()]
            self.label = to[self.label]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Each node that isn't the first of its group, and the first."""
        node = np.flatnonzero(self.label != np.arange(len(self.label)))
        return node, self.label[node]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); component is the smallest node reachable.

    Alternates large-star and small-star steps until the links no longer
    change: the number of rounds grows with the logarithm of the longest path.
    A hub is met by a minimum with a partial step on the map side and by a join
    whose other side has one row for each node, so no task needs all its links
    in memory. Each round is a written table, so a lost executor costs no more
    than a round. Null ends and links of a node with itself are left out.
    """
    def directed(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = staged(directed(links.where("a <> b").select("a", "b")), "links")
    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "links")
        before, seen = seen, mark(now)
        if before == seen:
            break
    first = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(first)
