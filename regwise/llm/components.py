"""Connected components by alternating large and small stars, every round cut by a written table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regwise.llm.common import Cut


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes on the edges ``a[i]``-``b[i]`` and the smallest node that each reaches.

    This turns the links that one task has found into at most one edge a node.
    """
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, before[i], low)
        np.minimum.at(root, before[j], low)
        root = root[root]
        if np.array_equal(root, before):
            return nodes, nodes[root]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node on an edge ``(a, b)``; the root is the smallest node reached.

    Null ends, loops and repeated edges are allowed and change nothing. Each
    round is two grouped minima (combined before the shuffle) and two joins
    that adaptive execution may split; no neighbour list is ever collected.
    Rounds grow with the logarithm of the longest path.
    """
    pair = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, mark = Cut(pair, "stars"), None
    while True:
        new = state.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark or not new[0]:
            return state.df.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                state.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark, old = new, state
        both = old.df.union(old.df.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = Cut(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "stars")
        low = large.df.groupBy("u").agg(F.min("v").alias("m"))
        near = large.df.join(low, "u")
        state = Cut(near.select("u", F.col("m").alias("v")).union(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "stars")
        old.drop()
        large.drop()
