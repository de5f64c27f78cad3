"""Connected components by alternating star contraction on written edge tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitrank.operators.joins import Size, lookup_join
from traitrank.sources.staging import Staging

# Bytes of a node and its least neighbour where they are broadcast, for ids of up to 64 characters.
_ENTRY = 192


def spanning_forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions over the links (i, j)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if np.array_equal(label, before):
            return label


def _tied(rows: DataFrame, least: DataFrame, key: str, n: int) -> DataFrame:
    """``rows`` with the least neighbour ``m`` of their ``key``; ``least`` counts them in ``n_near``.

    At most ``n`` nodes are looked up. Within the bound for broadcasts no row is shuffled; beyond it
    the hubs, at most 1024 of them, are broadcast, so that none of them fills a task.
    """
    size = Size(rows=n, bytes=n * _ENTRY, weight=n, largest=n)
    return lookup_join(rows, least, [key], weight="n_near", size=size)


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every neighbour above a node is tied to the smallest of the node's neighbourhood."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = near.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n_near"))
    return (
        _tied(near.filter("v > u"), least, "u", 2 * n)
        .select(F.col("m").alias("a"), F.col("v").alias("b"))
        .filter("a <> b").distinct()
    )


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("n_near"))
    moved = _tied(edges, least, "b", n).select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).filter("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, component) for every node that has an edge in ``edges`` (a, b).

    ``component`` is the smallest node that is reachable. Edges may come in any direction,
    repeated, and as loops; loops and edges with a null are no edges. The edges of each round
    are written to the shared folder; only their count and a checksum reach the driver. That count
    bounds the nodes, which are broadcast with their least neighbour up to some 350,000 edges; beyond
    them only hubs are. No edges: an empty result.
    """
    current = staging.write(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b").distinct(),
        "edges",
    )
    seen = _digest(current)
    while seen[0]:
        # A large star has no more edges than it is given, so one count bounds both steps.
        current = staging.write(_small_star(_large_star(current, seen[0]), seen[0]), "edges")
        now = _digest(current)
        if now == seen:
            break
        seen = now
    members = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(
        current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
