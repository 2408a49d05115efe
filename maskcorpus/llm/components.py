"""Connected components over an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import staged


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) with the same components as edges ``a``-``b``.

    Used inside tasks to shrink a dense block of links: a clique of k nodes
    leaves as k - 1 rows instead of k * (k - 1) / 2.
    """
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class ForestBuffer:
    """Collects links of one block and keeps only a spanning forest once they pass ``limit``."""

    def __init__(self, limit: int = 1_000_000):
        self.limit, self.size, self.parts = limit, 0, []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.parts.append((a, b))
            self.size += len(a)
            if self.size > self.limit:
                self.parts = [self.edges()]
                self.size = len(self.parts[0][0])
                self.limit = max(self.limit, 2 * self.size)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        return forest(*(np.concatenate(x) for x in zip(*self.parts)))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v"))).distinct())


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; component is its smallest node.

    Each round is two aggregations and two joins; minima combine before the
    shuffle, so a node with a third of all links stays cheap, and joins on it
    are skew joins that can be split. Rounds end when the edge set repeats,
    after O(log^2 n) rounds at worst. Every round is written to the shared
    folder. Self links and repeated links are allowed; null ends are dropped
    (a null links with nothing). An empty table gives an empty one.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now = staged(now, "links")
    mark = _mark(now)
    if mark[0]:
        while True:
            now = staged(_small_star(_large_star(now)), "star")
            mark, before = _mark(now), mark
            if mark == before:
                break
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
