"""Connected components by joins and minimum aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.session import settle, settle_measured


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star algorithm on edges (a, b) with a > b.

    Large star: each node's larger neighbours are linked to its smallest neighbour. Small
    star: each node and its smaller neighbours are linked to the smallest of them.
    """
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(lowest.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not its own root.

    The root is the smallest node reachable. Each round writes its edges to the shared folder
    and reads them back; the rounds end when the edges no longer change.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state = {"n": F.count(F.lit(1)), "h": F.bit_xor(F.xxhash64("a", "b"))}
    now, seen = settle_measured(ordered.filter("a <> b").distinct(), "edges", **state)
    while seen["n"]:
        large = settle(_stars(now, large=True), "stars")
        after, found = settle_measured(_stars(large, large=False), "edges", **state)
        if found == seen:
            break
        now, seen = after, found
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
