"""Connected components by distributed union-find.

Each task first runs union-find over the edges it holds and gives a star for every local component. In a round every
node then ties its neighbours and itself to the smallest of them, and tasks contract what they hold; when no node that
has a smaller neighbour has a second one, only stars are left. The rows of a node with many neighbours are those of a
plain join, which Spark splits where a key is skewed: both of its sides are written first. Every round is written to
the shared folder, so that a lost executor costs one round's tasks. Nothing but a flag reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shared


def spanning_stars(a: Iterable[int], b: Iterable[int]) -> tuple[list[int], list[int]]:
    """(node, smallest node of its component) for each node but the smallest ones."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for x, y in zip(a, b):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if root(x) != x]
    return nodes, [root(x) for x in nodes]


def _local(edges: DataFrame) -> DataFrame:
    def work(batches):
        nodes, roots = [], []
        for batch in batches:  # stars so far, and the next batch
            nodes, roots = spanning_stars(nodes + batch.column("a").to_pylist(), roots + batch.column("b").to_pylist())
        yield pa.RecordBatch.from_pydict({"a": pa.array(nodes, pa.int64()), "b": pa.array(roots, pa.int64())})

    return edges.mapInArrow(work, "a long, b long")


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (smallest node reachable) for each node of edges a, b (longs, not null).

    Loops and repeated edges don't matter; without edges the result is empty.
    """
    # distinct() deals edges out evenly, and parts _local from what made them, so that no task holds two Python workers.
    e = shared(_local(edges.select("a", "b").where("a <> b").distinct()))
    for _ in range(most_rounds):
        both = e.select("a", "b").union(e.select(e["b"].alias("a"), e["a"].alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"))
        near = shared(near.select("a", F.least("a", "low").alias("m"), ((F.col("low") < F.col("a")) & (F.col("high") > F.col("low"))).alias("open")))
        if near.where("open").isEmpty():
            return near.select(F.col("a").alias("node"), F.col("m").alias("component"))
        tied = both.join(near.select("a", "m"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(near.select("a", "m"))
        e = shared(_local(tied.where("a <> b").distinct()))
    raise RuntimeError(f"components are not stable after {most_rounds} rounds")


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)
