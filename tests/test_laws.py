"""Merge laws and metric laws on generated data (hypothesis, few examples)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.operators import drift as D
from tallyframe.operators.merge import merge_profiles
from tallyframe.operators.profile import ProfileOptions, profile
from tallyframe.operators.summary import exact_view

EXACT = ProfileOptions(sketches=False)
KEYS = ["column", "count", "null_count", "type_integral", "type_fractional", "type_boolean",
        "type_string", "type_unknown", "n", "min", "max"]

rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(-50, 50)),
                             st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)),
                             st.one_of(st.none(), st.sampled_from(["1", "2.5", "true", "x", ""]))),
                   min_size=3, max_size=40)
SCHEMA = "a int, b double, c string"
SETTINGS = settings(max_examples=4, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _exact(p):
    return {r["column"]: r for r in exact_view(p).collect()}


def _close(x, y):
    if x is None or y is None:
        return x is None and y is None
    return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-6)


def _same(p1, p2):
    a, b = _exact(p1), _exact(p2)
    assert a.keys() == b.keys()
    for c in a:
        for k in KEYS:
            assert a[c][k] == b[c][k], (c, k)
        assert _close(a[c]["total"], b[c]["total"]) and _close(a[c]["stddev"], b[c]["stddev"])


@SETTINGS
@given(rows=rows_st, cut=st.integers(1, 2))
def test_merge_of_parts_is_whole(spark, rows, cut):
    df = spark.createDataFrame(rows, SCHEMA)
    k = max(1, len(rows) * cut // 3)
    a = spark.createDataFrame(rows[:k], SCHEMA)
    b = spark.createDataFrame(rows[k:], SCHEMA)
    parts = profile(a, "t", options=EXACT).unionByName(profile(b, "t", options=EXACT))
    _same(merge_profiles(parts), profile(df, "t", options=EXACT))


@SETTINGS
@given(rows=rows_st)
def test_merge_commutes_and_associates(spark, rows):
    n = len(rows)
    parts = [spark.createDataFrame(rows[i * n // 3:(i + 1) * n // 3], SCHEMA) for i in range(3)]
    ps = [profile(p, "t", options=EXACT) for p in parts]
    left = merge_profiles(merge_profiles(ps[0].unionByName(ps[1])).unionByName(ps[2]))
    right = merge_profiles(ps[2].unionByName(merge_profiles(ps[1].unionByName(ps[0]))))
    _same(left, right)


def test_roundtrip_identity(spark, tmp_path):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    p = profile(li, "lineitem")
    p.write.parquet(str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    _same(p, back)
    # sketches survive: the same estimates after the round trip
    est = F.call_function("theta_sketch_estimate", F.col("theta"))
    e1 = {r[0]: r[1] for r in p.select("column", est).collect()}
    e2 = {r[0]: r[1] for r in back.select("column", est).collect()}
    assert e1 == e2


def test_tree_aggregation_equals_direct(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").repartition(12)
    direct = profile(li, "li", options=ProfileOptions(tree_fanout=1))
    tree = profile(li, "li", options=ProfileOptions(tree_fanout=4))
    _same(direct, tree)


def test_metric_laws(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    side = F.when(F.col("l_linenumber") % 2 == 0, "reference").otherwise("target")
    same = F.lit("reference")
    # identical sides: intersection 1, KL = PSI = KS = 0
    lo, hi = D.range_of(li, "l_extendedprice", same)
    bins = D.shared_bins(lo, hi, 30)
    long = D.cell_table(li, "l_extendedprice", same, bins, ("reference",))
    twin = long.unionByName(long.withColumn("side", F.lit("target")))
    m = D.metrics(D.pair(twin, "reference", "target"), 30).first()
    assert math.isclose(m["intersection"], 1.0, abs_tol=1e-12)
    assert abs(m["kl"]) < 1e-12 and abs(m["psi"]) < 1e-12 and abs(m["ks"]) < 1e-12
    _, cells = D.two_sided(li, "l_extendedprice", side, 30)
    m2 = D.metrics(cells, 30).first()
    assert 0 <= m2["ks"] <= 1 and 0 <= m2["intersection"] <= 1 and m2["psi"] >= 0


def test_shared_bins_follow_recipe():
    b = D.shared_bins(901.82, 104997.88, 60)
    assert b.step == int((104997.88 - 901.82) / 60)
    assert b.edges[0] == 901.0 and b.edges == tuple(float(e) for e in range(901, 104997, 1734))
    neg = D.shared_bins(-994.28, 9997.41, 10)
    assert neg.edges[0] == -994.0   # int() truncates toward zero
    tiny = D.shared_bins(0.1, 0.5, 60)  # step 0: float fallback
    assert not tiny.integer and len(tiny.edges) == 61
