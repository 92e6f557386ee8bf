"""Connected components of a distributed edge list.

Large-star and small-star rounds: every round links the neighbours of a node to the
smallest one, which halves distances; rounds end when the edges no longer change, as
stars around each component's smallest node.  Minima are combined before the shuffle and
written to the shared folder, so that the join with them is between two plain shuffles and
Spark can split the partition of a hub.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, scratch


class Forest:
    """Union-find over integers; `join` tells whether an edge linked two trees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up, top = self.up, x
        while (above := up.get(top, top)) != top:
            top = above
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a partition that link different trees (the others say nothing new)."""
    trees = Forest()
    for batch in batches:
        u, v = (batch.column(i).to_numpy() for i in range(2))
        keep = np.fromiter((trees.join(a, b) for a, b in zip(u.tolist(), v.tolist())), bool, len(u))
        yield pa.RecordBatch.from_arrays([pa.array(u[keep]), pa.array(v[keep])], ["u", "v"])


def _minima(edges: DataFrame, name: str) -> DataFrame:
    return scratch(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least")), name)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) of every node of the edges (u, v: long)."""
    spread = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = scratch(spread.repartition(F.col("u")).mapInArrow(lean(_spanning), "u long, v long"), "cc-edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _minima(both, "cc-large-min")
        large = (both.join(least, both["u"] == least["node"]).where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct())
        large = scratch(large, "cc-large")
        least = _minima(large, "cc-small-min")
        small = large.join(least, large["u"] == least["node"])
        small = small.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").union(
            least.select(F.col("node").alias("u"), F.col("least").alias("v"))).distinct()
        now = scratch(small, "cc-small")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
