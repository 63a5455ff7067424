"""Sketch fields stay within their published error bounds."""

import math

from pyspark.sql import functions as F

from tallyframe.operators.profile import profile
from tallyframe.operators.stats import exact_distinct
from tallyframe.operators.summary import distinct_estimate, flat_summary

LI = "/root/testdata/sf0.01/lineitem.parquet"


def test_theta_within_bound(spark):
    li = spark.read.parquet(LI)
    p = profile(li, "li")
    est, lo, hi = distinct_estimate(F.col("theta"), 12)
    got = {r[0]: r[1:] for r in p.select("column", est, lo, hi).collect()}
    exact = {r[0]: r[1] for r in exact_distinct(li, li.columns).collect()}
    for c, n in exact.items():
        e, a, b = got[c]
        assert abs(e - n) <= 3 / math.sqrt(4096) * n + 1, c
        assert a <= n <= b, c


def test_kll_rank_error(spark):
    li = spark.read.parquet(LI)
    p = profile(li.select("l_extendedprice"), "li")
    pts = [5000.0, 20000.0, 40000.0, 80000.0]
    arr = F.array(*[F.lit(x) for x in pts])
    ranks = p.select(F.call_function("kll_sketch_get_rank_double", F.col("kll"), arr)).first()[0]
    n = li.count()
    for x, r in zip(pts, ranks):
        true = li.filter(F.col("l_extendedprice") <= x).count() / n
        assert abs(true - r) <= 0.0133


def test_topk_exact_when_few_values(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    fs = flat_summary(profile(o.select("o_orderpriority"), "o"))["frequent_strings"]
    got = {r["value"]: r["count"] for r in fs.collect()}
    exact = {r[0]: r[1] for r in o.groupBy("o_orderpriority").count().collect()}
    assert got == exact


def test_flat_summary_shapes(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    flat = flat_summary(profile(li, "li"), bins=30)
    s = {r["column"]: r for r in flat["summary"].collect()}
    assert s["l_returnflag"]["inferred_dtype"] == "string"
    assert s["l_quantity"]["inferred_dtype"] == "fractional"
    assert s["l_orderkey"]["inferred_dtype"] == "integral"
    h = {r["column"]: r for r in flat["hist"].collect()}
    q = h["l_quantity"]
    assert len(q["bin_edges"]) == 31 and len(q["counts"]) == 30
    assert abs(sum(q["counts"]) - s["l_quantity"]["count"]) <= 30


def test_describe_approx_path(spark):
    from tallyframe.operators.stats import describe_numeric
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    exact = {r["column"]: r for r in describe_numeric(li, ["l_extendedprice"]).collect()}
    approx = {r["column"]: r for r in describe_numeric(li, ["l_extendedprice"], exact=False).collect()}
    e, a = exact["l_extendedprice"], approx["l_extendedprice"]
    assert e["count"] == a["count"] and e["min"] == a["min"] and e["max"] == a["max"]
    n = e["count"]
    for q, col in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
        rank = li.filter(li["l_extendedprice"] <= a[col]).count() / n
        assert abs(rank - q) <= 0.01, (col, rank)
