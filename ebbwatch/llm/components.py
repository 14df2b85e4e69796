"""Connected components of a link table, by hooking to smaller neighbours and pointer jumping."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbwatch.sources.storage import materialize


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of (a, b) links; the component is its smallest node.

    Every round links each node's larger neighbours to its smallest one, then the other way round, and writes the
    links; rounds end when a round changes nothing. A node with very many neighbours is never gathered:
    the smallest neighbour is an aggregate with partial sums, joined back to the links.
    """
    links = materialize(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        after = materialize(_small_star(_large_star(links)), "links")
        if _summary(after) == _summary(links):
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                after.select("b", "b").distinct()
            )
        links = after


def _summary(links: DataFrame) -> tuple:
    """Count and order-free digest of the links; equal links have equal ones."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), digest).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where("b > a").join(smallest, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(smallest, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(smallest.select("a", F.col("m").alias("b")))
        .where("a != b")
        .distinct()
    )


def roots(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Inside a task: the smallest of n rows reachable over links (a, b), going on from ``parent``."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    return parent
