"""Connected components by alternating large-star and small-star."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import cut, release


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) for every id of the edges (a, b); the component is its smallest id.

    NULL ends and loops are left out; direction and repeated edges do not matter. Every round is written to the
    shared folder, and minima are computed before the join that hands them out, so that a hub's rows may be split.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = cut(_down(edges), "edges")
    while True:
        large, lowest = _large_star(edges)
        large = cut(large, "edges")
        release(lowest)
        small, lowest = _small_star(large)
        small = cut(small, "edges")
        release(large, lowest)
        # Both steps only move ends down; when neither changes the set of edges, every edge ends at a root.
        if _digest(small) == _digest(edges):
            break
        release(edges)
        edges = small
    release(edges)
    # Each edge (a, b) now has b < a, and b is the root.
    found = small.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    return found.unionByName(small.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())


def _down(edges):
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges):
    """Every neighbour above an id is linked to the smallest of the id and its neighbours; with the minima that were written."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "minima")
    moved = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct(), lowest


def _small_star(edges):
    """Every neighbour below an id, and the id itself, is linked to the smallest of them; with the minima that were written."""
    lowest = cut(edges.groupBy("a").agg(F.min("b").alias("m")), "minima")
    moved = edges.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = lowest.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct(), lowest


def _digest(edges):
    code = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(code), F.sum("b")).first())


def smallest_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest label that the pairs (i, j) of places connect each place to, for a block of rows in memory."""
    while True:
        low = np.minimum(labels[i], labels[j])
        new = labels.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == labels).all():
            return labels
        labels = new
