"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``edges`` but the roots themselves.

    ``root`` is the smallest node reachable.  Null ends, loops and repeated
    edges are ignored; no edges give no rows.  Each round is written to the
    shared folder; rounds end when a round changes nothing (about the
    logarithm of the longest path).
    """
    cur = materialise(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "cc")
    seen = None
    while True:
        state = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or state[0] == 0:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        cur = materialise(_small_star(_large_star(cur)), "cc")
