"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without an edge don't appear.

    edges has columns a and b of one type. Each round is written to the shared folder. A hub's edges are aggregated
    before they are shuffled and never meet in one task.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small_least).distinct()
        now, before = staged(small, "edges"), mark
        mark = _mark(now)
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError("components did not settle")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())
