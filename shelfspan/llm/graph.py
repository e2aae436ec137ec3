"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspan.session import settle

ROUNDS = 60


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of every node on its smallest one; large: only the greater neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    hung = both.where("b > a") if large else both
    joined = hung.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.where("m < a").select("a", F.col("m").alias("b"))
    joined = joined.unionByName(own) if not large else joined
    return joined.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, class_id`` of every node of ``edges (a, b)``; the class is its smallest node.

    Every round is written to the shared folder, so lineage stays short and a
    lost executor costs one round. Rounds grow with the logarithm of the graph.
    """
    now = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    was = None
    for _ in range(ROUNDS):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h"), F.sum(F.xxhash64("b", "a") % 1_000_003).alias("s")).first()
        if state == was or not state["n"]:
            break
        was = state
        now = settle(_stars(_stars(now, True), False), "edges")
    else:
        raise RuntimeError("components did not settle")
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("class_id")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("class_id")).unionByName(tops)
