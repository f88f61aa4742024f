"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def local_roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of the nodes 0 .. count - 1, for the edges (a, b)."""
    root = np.arange(count)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges lead from the larger to the smaller node: all smaller neighbours move to the smallest."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component; nodes without an edge do not appear.

    ``edges`` has columns a and b, in any direction, loops and repeats allowed. A hub's edges are reduced
    by partial minima and joined by equality, which adaptive execution splits; nothing is gathered per
    node. Each round is written to the shared folder; rounds grow with the logarithm of the path lengths.
    """
    ordered = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, seen = materialize(ordered, "edges"), None
    while True:
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
        current = materialize(_small_star(_large_star(current)), "edges")
