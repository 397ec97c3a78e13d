"""Connected components by alternating large and small stars, with written tables between rounds; of few edges in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: So many edges (16 MB of numbers) are few: one task is done with them before a round has started its tasks.
FEW = 1 << 20


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _rooted(batches):
    """All edges at once: each root goes below the least one that an edge leads it to, until every edge is within one tree."""
    held = [np.stack([c.to_numpy() for c in b.columns]) for b in batches if b.num_rows]
    if not held:
        return
    nodes, ends = np.unique(np.concatenate(held, axis=1), return_inverse=True)
    one, two = ends.reshape(2, -1)
    root = np.arange(len(nodes))
    while (root[one] != root[two]).any():
        x, y = root[one], root[two]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    for x in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[x : x + 100_000]), pa.array(nodes[root[x : x + 100_000]])], names=["node", "root"])


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """`edges` (a long, b long) to (node, root): the least node of each component; nodes without edges do not appear.
    Up to `few` different edges go to one task, more go through rounds; the results are the same. In the rounds the least
    neighbour of a node is found by a partial aggregate and joined back, so that a node with very many neighbours is never
    gathered."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _state(now)
    if seen[0] <= few:
        return now.coalesce(1).mapInArrow(_rooted, "node long, root long")
    while True:
        both = now.select("a", "b").union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = written(small, "edges")
        new = _state(now)
        if new == seen:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = new
