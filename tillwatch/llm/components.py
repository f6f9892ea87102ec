"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.session import written

MAX_ROUNDS = 60


def _towards_smaller(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (a, b).

    Each round points every node's larger neighbours (large star), then its smaller ones
    (small star), at the node's minimum, until nothing changes. A node's neighbours are never
    gathered: the minimum is an aggregate that combines map-side, and is joined back."""
    edges = written(_towards_smaller(edges), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(_towards_smaller(large), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
        edges = written(_towards_smaller(small), "small-star")
        now = tuple(edges.agg(
            F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.groupBy("a").agg(F.min("b").alias("component")).select(
                F.col("a").alias("node"), "component"
            ).union(edges.select("b", "b").distinct())
        before = now
    raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
