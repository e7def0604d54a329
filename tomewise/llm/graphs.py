"""Connected components of a link table, without a hot key in one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewise.operators.joins import join_once
from tomewise.session import reliable


class Forest:
    """Union-find over ``0..n-1`` that takes many links at once."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            root = self.roots()
            low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
            apart = low != high
            if not apart.any():
                return
            i, j = i[apart], j[apart]
            np.minimum.at(self.parent, high[apart], low[apart])


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` of every node but the roots of a table of links between
    longs ``a, b``; the root is the component's smallest node.

    Alternates two steps until the links stay the same: every larger
    neighbour, then every smaller one, is tied to the smallest neighbour.  The
    rounds grow with the logarithm of the longest chain; each is an aggregate
    with map-side minimum and a join whose hot keys can be split, and ends in
    a ``checkpoint()``."""
    edges = (links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct())
    edges, before = reliable(edges), None
    for _ in range(max_rounds):
        mark = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"),
                         F.expr("bit_xor(xxhash64(b, a, 1L))")).head()
        if mark == before or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("n")).select("a", F.least("a", "n").alias("least"))
        large = (join_once(both, least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
                 .distinct())
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        tied = join_once(large, least, "a")
        small = (tied.select(F.explode(F.array(
                    F.struct(F.greatest("b", "least").alias("a"), F.least("b", "least").alias("b")),
                    F.struct(F.col("a"), F.col("least").alias("b")))).alias("x"))
                 .select("x.a", "x.b").where("a <> b").distinct())
        edges = reliable(small)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
