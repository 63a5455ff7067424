"""Jobs over stored profile tables: ranks at per-row points, drift between time buckets, trailing merges, runs."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators.drift_table import consecutive_drift
from tallyframe.operators.merge import merge_profiles, trailing_merge
from tallyframe.operators.profile import profile
from tallyframe.operators.ranks import RANK_ERROR, quantile_grid, rows_below
from tallyframe.operators.summary import histogram_table
from tallyframe.session import scratch_path
from tallyframe.sources.runs import RunTable

INF = float("inf")


@pytest.mark.parametrize("n", [1, 2, 7, 150, 5000])
def test_rows_below_any_point(spark, n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 40, n).astype(float)
    points = [-1.0, 0.0, 3.5, 20.0, 39.0, 40.0, INF]
    p = profile(spark.createDataFrame([(float(v),) for v in values], "a double"), "d").withColumn("g", quantile_grid(F.col("kll")))
    got = p.select(*[rows_below(F.col("g"), F.col("n"), F.lit(x), inc).alias(f"{i}{inc}")
                     for i, x in enumerate(points) for inc in (False, True)]).first()
    for i, x in enumerate(points):
        for inc in (False, True):
            want = int((values <= x).sum() if inc else (values < x).sum())
            assert abs(got[f"{i}{inc}"] - want) <= (0 if n <= 150 else RANK_ERROR * n)


def test_histogram_with_infinite_and_huge_values(spark):
    def counts(values, bins=4):
        r = histogram_table(profile(spark.createDataFrame([(v,) for v in values], "a double"), "d"), bins=bins).first()
        return r["bin_edges"], r["counts"]
    edges, got = counts([-INF, 0.0, 1.0, 2.0, 4.0, INF, INF])
    assert edges == [0.0, 1.0, 2.0, 3.0, 4.0] and got == [2, 1, 1, 3]
    edges, got = counts([-1e308, 1e308, 1e308])
    assert all(math.isfinite(e) for e in edges) and got == [1, 0, 0, 2]
    assert counts([INF, INF])[1] == [2, 0, 0, 0] and sum(counts([-INF, INF])[1]) == 2
    assert counts([5.0, 6.0], bins=1)[1] == [2]
    empty = spark.createDataFrame([(None,)], "a double")
    assert histogram_table(profile(empty, "d")).count() == 0


def plain(p, q):
    out = {"ks": max(abs(a - b) for a, b in zip(np.cumsum(p), np.cumsum(q))), "intersection": sum(map(min, p, q)),
           "kl": sum(a * math.log(a / max(b, 1e-9)) for a, b in zip(p, q) if a),
           "psi": sum((a - b) * math.log(max(a, 1e-9) / max(b, 1e-9)) for a, b in zip(p, q)),
           "hellinger": math.sqrt(max(0, 1 - sum(math.sqrt(a * b) for a, b in zip(p, q))))}
    half = lambda a, b: a / 2 * math.log(2 * a / (a + b)) if a else 0
    return {**out, "js": sum(half(a, b) + half(b, a) for a, b in zip(p, q))}


def test_drift_of_every_column_and_segment(spark):
    rng = np.random.default_rng(5)
    start, rows = dt.datetime(2024, 1, 1), []
    for day, tag in [(0, "x"), (1, "x"), (3, "x"), (0, "y"), (3, "y"), (4, "z")]:
        for _ in range(60):
            rows.append((start + dt.timedelta(days=day), tag, float(rng.normal(day, 2)), int(rng.integers(0, 9)), 7.0, None))
    rows += [(None, "x", 1.0, 1, 1.0, None), (start + dt.timedelta(days=4), "x", INF, 5, 7.0, None)]
    df = spark.createDataFrame(rows, "ts timestamp, tag string, a double, b int, same double, none double")
    p = profile(df, "d", time_column="ts", grain="day", tags=["tag"])
    got = {(r["tags"][0]["value"], r["column"], (r["dataset_timestamp"] - start).days): r for r in consecutive_drift(p, 8).collect()}
    pairs = {("x", 1): 0, ("x", 3): 1, ("x", 4): 3, ("y", 3): 0}
    assert set(got) == {(t, c, d) for t, d in pairs for c in ("a", "b", "same")}
    for (tag, column, day), r in got.items():
        pick = {"a": 2, "b": 3, "same": 4}[column]
        old, new = ([float(w[pick]) for w in rows if w[0] == start + dt.timedelta(days=d) and w[1] == tag] for d in (pairs[tag, day], day))
        lo, hi = (f([v for v in old + new if math.isfinite(v)]) for f in (min, max))
        assert (r["lo"], r["hi"], r["n_reference"], r["n"]) == (lo, hi, len(old), len(new))
        edges = [lo + j * (hi / 8 - lo / 8) for j in range(1, 8)]
        p_, q_ = (np.bincount([sum(v >= e for e in edges) for v in vs], minlength=8) / len(vs) for vs in (old, new))
        for k, v in plain(p_, q_).items():
            assert math.isclose(r[k], v, abs_tol=1e-6), (tag, column, day, k)
    assert consecutive_drift(p.limit(0)).count() == 0


def test_trailing_merge_keeps_every_field(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(days=d, minutes=i), "s" * (1 + i % 3), float(i % 10 + d)) for d in (0, 1, 2, 5, 20) for i in range(50)]
    df = spark.createDataFrame(rows, "ts timestamp, t string, x double")
    daily = profile(df, "d", time_column="ts", grain="day")
    got = {((r["dataset_timestamp"] - start).days, r["column"]): r for r in trailing_merge(daily, 4).collect()}
    assert {k[0] for k in got} == {1, 2, 5}
    raw = profile(df.filter(F.col("ts").between(start + dt.timedelta(days=1), start + dt.timedelta(days=3))), "d")
    for w in raw.collect():
        if w["column"] in ("t", "x"):
            g = got[5, w["column"]]
            assert g["profiles"] == 2 and [g[f] for f in ("count", "n", "min", "max", "low", "high")] == [w[f] for f in ("count", "n", "min", "max", "low", "high")]
            assert g["m2"] is None and w["m2"] is None or math.isclose(g["m2"], w["m2"])
            assert g["kll"] is not None and g["theta"] is not None and (g["topk"] is None) == (w["topk"] is None)
    everything = merge_profiles(daily.filter(F.col("dataset_timestamp") < F.lit(start + dt.timedelta(days=2)))
                                .withColumn("dataset_timestamp", F.lit(None).cast("timestamp")))
    assert {r["column"]: r["count"] for r in everything.collect()}["x"] == got[2, "x"]["count"]


def test_run_table_replaces_a_run_and_is_read_by_another_session(spark):
    def run(i, mae, experiment="e"):
        return (spark.createDataFrame([(experiment, i, mae)], "experiment string, run_id string, mae double"),
                profile(spark.range(int(mae)).toDF("a"), "d").withColumn("experiment", F.lit(experiment)).withColumn("run_id", F.lit(i)))
    t = RunTable(scratch_path(spark, "runs"))
    for args in (("1", 5.0), ("2", 6.0), ("1", 7.0), ("1", 9.0, "f")):
        t.log(*run(*args))
    # profiles whose run was never written are a failed attempt
    orphan = run("3", 4.0)[1]
    orphan.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("experiment", "run_id").parquet(t.path + "/profiles")
    other = spark.newSession()
    assert sorted((r["run_id"], r["mae"]) for r in t.runs(other, "e").collect()) == [("1", 7.0), ("2", 6.0)]
    assert sorted((r["experiment"], r["run_id"], r["count"]) for r in t.profiles(other).collect()) == [("e", "1", 7), ("e", "2", 6), ("f", "1", 9)]
    assert t.profiles(other, "e").first()["kll"] is not None and t.runs(other, "none").count() == 0
