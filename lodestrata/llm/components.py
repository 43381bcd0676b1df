"""Connected components of an edge table by alternating large-star and small-star rounds.

The two rounds are those of Kiveris et al., "Connected Components in MapReduce
and Beyond" (2014), in which nothing but two numbers per round reaches the
driver. An edge table of at most ``FEW`` rows (2 MB) isn't worth eight stages
a round: the driver finds its components, which are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: Edges that the driver takes at once; more are never collected.
FEW = 1 << 17


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60, few: int = FEW) -> DataFrame:
    """(node long, root long) for every node of ``edges(a long, b long)``; root is the least node of its component.

    Nulls and self-loops are left out; repeated edges and either direction are
    alike; an empty table gives an empty one. A node of very many edges is no
    bottleneck: minima are summed up before the shuffle, and the join back to
    the edges is one that adaptive execution splits.
    """
    long = lambda c: F.col(c).cast("long")
    e = edges.select(F.greatest(long("a"), long("b")).alias("a"), F.least(long("a"), long("b")).alias("b")).where("a <> b")
    e = scratch.put(e, "edges")
    if e.count() <= few:
        got = e.toArrow()
        node, root = forest(*(got.column(c).to_numpy() for c in "ab"))
        return e.sparkSession.createDataFrame(pa.table({"node": node, "root": root}), "node long, root long")
    e = scratch.put(e.distinct(), "edges")
    state = _state(e)
    for _ in range(rounds):
        if not state[0]:
            break
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.put(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = scratch.put(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "large")
        down = scratch.put(large.groupBy("a").agg(F.min("b").alias("m")), "down")
        small = large.join(down, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        after = scratch.put(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        now = _state(after)
        scratch.drop(e, low, large, down)
        e, done, state = after, now == state, now
        if done:
            break
    else:
        raise RuntimeError(f"components: no fixed point after {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, roots) of edges from a to b; a root is the least node of its component."""
    node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, (a, b) = np.arange(len(node)), at.reshape(2, -1)
    while len(a):
        x, y = root[a], root[b]
        on = x != y
        a, b, x, y = a[on], b[on], x[on], y[on]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return node, node[root]


def _state(e: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum over them that doesn't depend on their order."""
    n, s = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return n, int(s or 0)
