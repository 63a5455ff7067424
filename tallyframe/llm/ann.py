"""Approximate nearest neighbours: stable projections, kd-trees, chi-square stop.

Largest inner product becomes nearest distance by one more dimension
(``sqrt(M^2 - |x|^2)`` for data, 0 for queries).  Gaussian (2-stable) projections to ``M_PROJ``
dimensions make the squared projected distance of a pair its squared
distance times a chi-square variable, so after all points nearer than
r in the projection are verified, a point at the present k-th distance d is still unseen
with probability 1 - chi2(r^2/d^2).  Each index shard keeps a kd-tree over
its projected points; leaves are visited in order of distance and their
points verified exactly, until that probability is at most ``1 - confidence``.

Rows with equal vectors are one point that carries its smallest k + 1 ids.
Work is dealt in (index shard, query block) cells of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import materialise

M_PROJ = 8            # even, so that the chi-square law has a closed form
LEAF = 32
SHARD_ROWS = 4096     # points of an index shard, rows of a query block
BLOCK_ROWS = 1024
SALTS = 64


def chi2_cdf(x: np.ndarray, dof: int = M_PROJ) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.minimum(np.asarray(x, dtype=float) / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, dof // 2):
        term = term * half / i
        total += term
    return 1 - np.exp(-half) * total


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Leaves of a kd-tree: median splits along the widest dimension."""
    todo, out = [np.arange(len(points))], []
    while todo:
        at = todo.pop()
        if len(at) <= leaf:
            out.append(at)
            continue
        p = points[at]
        axis = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
        order = np.argsort(p[:, axis], kind="stable")
        half = len(at) // 2
        todo += [at[order[:half]], at[order[half:]]]
    return out


def search(base: np.ndarray, queries: np.ndarray, k: int, norm: float, confidence: float, seed: int = 3):
    """Indices (q, k) of the points with the largest inner products found, -1 where none, and scores."""
    dim = base.shape[1]
    lift = np.sqrt(np.maximum(norm ** 2 - (base ** 2).sum(axis=1), 0))
    proj = np.random.default_rng(seed).standard_normal((dim + 1, M_PROJ))
    p = np.hstack([base, lift[:, None]]) @ proj
    q = queries @ proj[:-1]
    leaves = kd_leaves(p)
    low = np.array([p[a].min(axis=0) for a in leaves])
    high = np.array([p[a].max(axis=0) for a in leaves])
    member = np.full((len(leaves), LEAF), -1)
    for i, a in enumerate(leaves):
        member[i, :len(a)] = a
    gap = np.zeros((len(q), len(leaves)))
    for d in range(M_PROJ):
        gap += np.maximum(np.maximum(low[None, :, d] - q[:, None, d], q[:, None, d] - high[None, :, d]), 0) ** 2
    order = np.argsort(gap, axis=1)
    best_s = np.full((len(q), k), -np.inf)
    best_i = np.full((len(q), k), -1)
    q2 = (queries ** 2).sum(axis=1)
    active = np.arange(len(q))
    for step in range(len(leaves)):
        cell = order[active, step]
        r2 = gap[active, cell]
        worst = best_s[active].min(axis=1)
        d2 = np.where(np.isfinite(worst), norm ** 2 + q2[active] - 2 * worst, np.inf)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(d2 > 0, r2 / d2, np.inf)
        go = ~(chi2_cdf(np.nan_to_num(ratio, nan=0.0, posinf=1e9)) >= confidence)
        active, cell = active[go], cell[go]
        if not len(active):
            break
        near = member[cell]
        s = np.einsum("qld,qd->ql", base[near], queries[active])
        s[near < 0] = -np.inf
        alls = np.hstack([best_s[active], s])
        alli = np.hstack([best_i[active], near])
        top = np.argpartition(-alls, k - 1, axis=1)[:, :k]
        best_s[active] = np.take_along_axis(alls, top, axis=1)
        best_i[active] = np.take_along_axis(alli, top, axis=1)
    best_i[~np.isfinite(best_s)] = -1
    return best_i, best_s


def _cell(k: int, norm: float, confidence: float):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        cols = ["query_id", "vec_id", "score"]
        if not len(index) or not len(queries):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                                 "score": pd.Series(dtype="float64")})
        index = index.sort_values("_first", kind="stable")
        base = np.stack(index["_v"].to_numpy()).astype(np.float64)
        qs = np.stack(queries["_v"].to_numpy()).astype(np.float64)
        found, score = search(base, qs, k + 1, norm, confidence)
        ids = index["_ids"].to_numpy()
        out = []
        for qid, f, s in zip(queries["_id"].tolist(), found, score):
            rows = sorted((-sc, int(v)) for i, sc in zip(f, s) if i >= 0 for v in ids[i] if v != qid)[:k]
            out += [(qid, v, -sc) for sc, v in rows]
        return pd.DataFrame(out, columns=cols).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def nearest(vectors: DataFrame, k: int = 20, query_mod: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", confidence: float = 0.97, shard_rows: int = SHARD_ROWS,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row.

    Queries are the rows whose id is divisible by ``query_mod``; candidates all rows but the
    query's own; nearness the inner product in double precision, ties to the
    smaller id.  Rows with a null id, and vectors that are null, empty, zero, of another
    length than the most common one or hold null or non-finite components, take no part.  Rows that repeat an id
    and vector count once.  Fewer candidates than k give fewer rows; an empty
    table none.  Other columns are ignored.
    """
    v = F.col("_v")
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    rows = rows.where(F.col("_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
                      & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size(v) == sizes["d"])
    # equal vectors: one point with its smallest ids, found in two salted steps
    salted = rows.select("_id", "_v", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).alias("_s")).distinct()
    first = Window.partitionBy("_v", "_s").orderBy("_id")
    second = Window.partitionBy("_v").orderBy("_id")
    few = (salted.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k + 1)
           .withColumn("_r", F.row_number().over(second)).where(F.col("_r") <= k + 1))
    points = materialise(few.groupBy("_v").agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
                         .withColumn("_first", F.col("_ids")[0]), "ann-points")
    norm2, n_points = points.agg(F.max(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x)), F.count("*")).first()
    queries = rows.where(F.col("_id") % query_mod == 0).distinct()
    n_queries = queries.count()
    shards = max(1, math.ceil(n_points / shard_rows))
    blocks = max(1, math.ceil(n_queries / block_rows))
    left = (points.withColumn("_shard", F.pmod(F.xxhash64("_first"), F.lit(shards)))
            .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    right = (queries.withColumn("_block", F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int"))
             .withColumn("_shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))))
    found = (left.groupBy("_shard", "_block").cogroup(right.groupBy("_shard", "_block"))
             .applyInPandas(_cell(k, math.sqrt(norm2), confidence), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
