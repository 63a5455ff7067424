"""K-d tree sharding: weighted-median splits along the widest metadata dimension.

DataFrame functions only.  Rows are first reduced to groups of equal texts,
which stay together.  Every group is a point in metadata space (text length,
smallest doc_id, smallest language, smallest source) weighted by its bytes.  A node is
split along the dimension that its points span widest, at the weighted
median, which is found by radix selection: a histogram over 4,096 bins of a
62-bit order key, then a finer one inside the bin that holds the median.
Each round is one aggregate over all nodes; only one row per node (at most
the number of leaves) comes back to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import materialise

DIM_BITS = 31          # resolution of one normalised dimension
KEY_BITS = 2 * DIM_BITS  # dimension, then a hash of the text that breaks ties
BIN_BITS = 12
SLOT_ROWS = 20_000     # rows numbered by one window group


def _lexical(c: Column) -> Column:
    """Order-preserving number of the first six UTF-8 bytes (null: 0)."""
    head = F.rpad(F.substring(F.hex(F.encode(F.coalesce(c.cast("string"), F.lit("")), "utf-8")), 1, 12), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def _points(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """One weighted point per group of equal texts, dimensions scaled to 31 bits, all in the root node."""
    raw = rows.groupBy("_k1", "_k2").agg(
        F.sum("size").alias("w"), F.max("size").cast("double").alias("d0"),
        F.min("_id").cast("double").alias("d1"), F.min("_lang").alias("d2"), F.min("_source").alias("d3"), F.lit(1).cast("long").alias("node"))
    raw = materialise(raw, "shard-groups")
    dims = ["d0", "d1", "d2", "d3"]
    low = raw.agg(*[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims]).first()
    scaled = []
    for d in dims:
        lo, hi = low[f"lo_{d}"], low[f"hi_{d}"]
        span = (hi - lo) if lo is not None and hi > lo else 1.0
        scaled.append(F.coalesce(F.floor((F.col(d) - F.lit(lo)) / span * (2 ** DIM_BITS - 1)), F.lit(0))
                      .cast("long").alias(d))
    tie = F.shiftrightunsigned("_k2", 64 - DIM_BITS).alias("tie")
    return raw.select("_k1", "_k2", "w", "node", tie, *scaled), dims


def _values(spark, rows: list[tuple], cols: list[str]) -> DataFrame:
    """An inline table of one row per open node."""
    return spark.sql("SELECT * FROM VALUES " + ", ".join(
        "(" + ", ".join(f"{int(v)}L" for v in r) + ")" for r in rows) + f" AS t({', '.join(cols)})")


def _order_key(dims: list[str]) -> Column:
    picked = F.lit(0).cast("long")
    for i, d in enumerate(dims):
        picked = F.when(F.col("dim") == i, F.col(d)).otherwise(picked)
    return F.shiftleft(picked, DIM_BITS).bitwiseOR(F.col("tie"))


def _split_points(pts: DataFrame, dims: list[str], leaves: dict[int, int], tolerance: float) -> dict[int, tuple[int, int]]:
    """node -> (dimension, threshold): keys below the threshold go left."""
    spark = pts.sparkSession
    spans = pts.groupBy("node").agg(F.sum("w").alias("w"), *[(F.max(d) - F.min(d)).alias(d) for d in dims]).collect()
    # state of a node: dimension, bits fixed so far, their value, weight below, target weight, total
    state = {r["node"]: [max(range(len(dims)), key=lambda i: (r[dims[i]], -i)), 0, 0, 0,
                         r["w"] * (leaves[r["node"]] // 2) / leaves[r["node"]], r["w"]]
             for r in spans if leaves.get(r["node"], 1) > 1}
    done: dict[int, tuple[int, int]] = {}
    while state:
        given = _values(spark, [(n, s[0], KEY_BITS - s[1], s[2], max(KEY_BITS - s[1] - BIN_BITS, 0), s[3])
                                for n, s in state.items()],
                        ["node", "dim", "up", "prefix", "down", "below"])
        keyed = pts.join(F.broadcast(given), "node").withColumn("v", _order_key(dims))
        inside = keyed.where(F.expr("shiftright(v, cast(up as int)) = prefix"))
        hist = inside.groupBy("node", F.expr("shiftright(v, cast(down as int))").alias("bin")).agg(
            F.sum("w").alias("w"), F.count("*").alias("n"), F.first("below").alias("below"))
        run = Window.partitionBy("node").orderBy("bin")
        goals = _values(spark, [(n, math.ceil(s[4])) for n, s in state.items()], ["node", "goal"])
        hit = (hist.withColumn("upto", F.col("below") + F.sum("w").over(run))
               .join(F.broadcast(goals), "node").where("upto >= goal")
               .groupBy("node").agg(F.min(F.struct("bin", "upto", "w", "n")).alias("x")).select("node", "x.*").collect())
        for r in hit:
            s = state[r["node"]]
            down = max(KEY_BITS - s[1] - BIN_BITS, 0)
            before = r["upto"] - r["w"]
            if r["w"] <= tolerance * s[5] or r["n"] == 1 or down == 0:
                # cut at the nearer edge of the bin
                right = s[4] - before > r["upto"] - s[4]
                done[r["node"]] = (s[0], (r["bin"] + int(right)) << down)
                del state[r["node"]]
            else:
                s[1], s[2], s[3] = KEY_BITS - down, r["bin"], before
    return done


def kd_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.0005) -> DataFrame:
    """Put every row into a shard by a k-d tree over row metadata.

    ``n_shards`` leaves, or as many as ``target_bytes`` asks for.  Returns
    (id, size, text_crc32, shard, slot): size is UTF-8 bytes plus 1, slots
    count from 0 in each shard.  Shard sizes are as near equal as whole groups of equal
    texts allow.  A null text counts as no bytes (size 1, crc of nothing) and is
    grouped with empty texts; null ids, languages and sources order first.  Repeated
    rows are kept.  An empty table gives no rows.  Columns other than id, text,
    ``lang`` and ``source`` are ignored, whatever their names.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    meta = [(_lexical(F.col(c)) if c in docs.columns else F.lit(0.0)).alias(f"_{c}") for c in ("lang", "source")]
    rows = materialise(docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.xxhash64(text).alias("_k1"), F.xxhash64(text, F.lit(1)).alias("_k2"), *meta), "shard-rows")
    total, n_rows = rows.agg(F.sum("size"), F.count("*")).first()
    if n_shards is None:
        n_shards = max(1, math.ceil((total or 0) / target_bytes))
    pts, dims = _points(rows)
    leaves, first = {1: n_shards}, {1: 0}   # node -> leaves under it, its first shard
    while any(n > 1 for n in leaves.values()) and n_rows:
        cuts = _split_points(pts, dims, leaves, tolerance)
        if not cuts:
            break
        given = _values(spark, [(n, d, t) for n, (d, t) in cuts.items()], ["node", "dim", "cut"])
        pts = (pts.join(F.broadcast(given), "node", "left")
               .withColumn("node", F.when(F.col("cut").isNull(), F.col("node"))
                           .otherwise(2 * F.col("node") + (_order_key(dims) >= F.col("cut")).cast("long")))
               .drop("dim", "cut"))
        for n in list(cuts):
            left = leaves[n] // 2
            leaves[2 * n], leaves[2 * n + 1] = left, leaves[n] - left
            first[2 * n], first[2 * n + 1] = first[n], first[n] + left
            del leaves[n], first[n]
    shards = F.broadcast(_values(spark, [(n, s) for n, s in first.items()], ["node", "shard"]))
    placed = materialise(pts.join(shards, "node").select("_k1", "_k2", F.col("shard").cast("int").alias("shard")),
                         "shard-leaves")
    out = rows.join(placed, ["_k1", "_k2"]).select("_id", "size", "text_crc32", "shard")
    # slots: rows of a shard are dealt to buckets, numbered there, and shifted by the buckets before
    buckets = max(1, math.ceil((n_rows or 0) / n_shards / SLOT_ROWS))
    buckets = max(buckets, math.ceil(64 / n_shards))
    out = out.withColumn("_b", F.pmod(F.xxhash64("_id", "text_crc32"), F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = (out.groupBy("shard", "_b").agg(F.count("*").alias("n"))
             .select("shard", "_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")))
    within = Window.partitionBy("shard", "_b").orderBy("_id", "text_crc32")
    return (out.withColumn("_r", F.row_number().over(within) - 1).join(shift, ["shard", "_b"])
            .select(F.col("_id").alias(id_col), "size", "text_crc32", "shard",
                    (F.col("_r") + F.col("shift")).cast("long").alias("slot")))
