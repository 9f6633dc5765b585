"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, spill


def _shape(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1] or 0


def _hang(edges: DataFrame, key: str, lowest, rows) -> DataFrame:
    """Join each edge with the lowest neighbour of its ``key``.

    The lowest neighbours are written first: a join of two shuffled sides lets
    Spark split a node with very many edges, and the minimum is pre-aggregated.
    """
    low = spill(edges.groupBy(key).agg(F.min(lowest).alias("low")), "lowest")
    out = spill(rows(edges.join(low, key)).distinct(), "edges")
    discard(low)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of undirected edges (a, b) of longs; a component is its smallest node.

    Alternating large-star and small-star steps (Kiveris et al., "Connected
    components in MapReduce and beyond", 2014): each step hangs neighbours under
    the lowest node they share, until nothing changes, after O(log^2 n) rounds.
    Self-links and repeated links do not matter; null ends are left out; no link
    gives no row.  Every round is written to the shared folder.
    """
    now = spill(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    shape = _shape(now)
    while True:
        both = now.union(now.select("b", "a"))
        large = _hang(both, "a", F.least("a", "b"),
                      lambda j: j.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        discard(now)
        small = _hang(large, "a", F.col("b"), lambda j: j.select("a", F.col("low").alias("b")).union(
            j.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))))
        discard(large)
        now, before, shape = small, shape, _shape(small)
        if shape == before:
            roots = now.select("b").distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                roots.select(F.col("b").alias("node"), F.col("b").alias("component")))
