"""Connected components of a graph whose edges are rows; nothing is gathered on the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import scratch


class Forest:
    """Union-find over numbers that keeps the smallest of a set as its root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        top = x
        while (up := self.parent.get(top, top)) != top:
            top = up
        while x != top:
            self.parent[x], x = top, self.parent.get(x, x)
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _contract(edges: DataFrame) -> DataFrame:
    """The same components with fewer edges: each partition replaces its edges by stars around its own roots."""

    def star(batches):
        forest = Forest()
        for b in batches:
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                forest.join(u, v)
        nodes = list(forest.parent)
        pairs = [(x, forest.root(x)) for x in nodes]
        pairs = [(x, r) for x, r in pairs if x != r]
        u, v = np.array(pairs, np.int64).reshape(-1, 2).T
        for i in range(0, len(u), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(u[i : i + (1 << 16)]), pa.array(v[i : i + (1 << 16)])], names=["u", "v"])

    return edges.mapInArrow(star, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge that joins two nodes (``u, v`` long); ``component`` is the smallest node reachable.

    Alternating large-star and small-star steps, each a minimum by node and a join, until the edges stay as they are. Loops and nulls are ignored.
    """
    clean = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now, mark = scratch.table(_contract(clean).distinct(), "edges"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        mark = tuple(seen)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = scratch.table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = scratch.table(both.join(first, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = scratch.table(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, scratch.table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(before, first, large, least)
