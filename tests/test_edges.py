"""Nulls, NaN, repeated keys and empty frames."""

import math

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import drift as D
from tallyframe.operators import shaping as S
from tallyframe.operators import stats
from tallyframe.operators.merge import merge_profiles
from tallyframe.operators.profile import ProfileOptions, extreme_text, profile
from tallyframe.operators.quantiles import exact_quantiles_columns
from tallyframe.operators.summary import histogram_table
from tallyframe.sources import files, writers
from tallyframe.streaming.profile_stream import split_recent_writer

EXACT = ProfileOptions(sketches=False)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [0, 1, 3, 5, 9, 12, 20])
def test_sample_has_its_size_with_repeated_and_null_keys(spark, size):
    df = spark.createDataFrame([(1, "a")] * 6 + [(1, "b"), (None, "c"), (2, None)] + [(i, "z") for i in (3, 4, 5)], "k int, v string")
    s = S.exact_sample(df, ["k"], size=size)
    assert s.rows.count() == min(size, 12)
    assert rows(s.rows.unionByName(s.complement)) == rows(df)


@pytest.mark.parametrize("cuts", [(2, 4), (3, 7), (5, 30), (0,), (0, 3), (0, 0)])
def test_slices_keep_every_row_once(spark, cuts):
    df = spark.createDataFrame([(None, "n1"), (None, "n2"), (1, "a"), (1, "a"), (1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, None), (4, "d")],
                               "k int, v string")
    out = S.slices(df, ["k"], cuts=cuts)
    assert rows(out.drop("slice")) == rows(df)
    counts = {r["slice"]: r["count"] for r in out.groupBy("slice").count().collect()}
    bounds = [0, *[min(c, 10) for c in cuts], 10]
    assert counts == {i: b - a for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a}
    assert S.slices(df.filter("k > 9"), ["k"]).count() == 0


def test_split_shares_at_the_ends(spark):
    df = spark.range(100)
    assert S.hash_split(df, ["id"], share=1.0).filter("split = 'train'").count() == 100
    assert S.hash_split(df, ["id"], share=0.0).filter("split = 'train'").count() == 0


def test_median_of_integers_may_lie_between(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    assert rows(S.impute_median(df, ["a"])) == [(1.0,), (1.5,), (2.0,)]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "a double")
    r = profile(df, "d").first()
    assert (r["count"], r["null_count"], r["n"], r["min"], r["max"], r["mean"]) == (4, 2, 2, 1.0, 2.0, 1.5)
    d = stats.describe_numeric(df, ["a"]).first()
    assert (d["count"], d["mean"], d["max"], d["p75"]) == (2, 1.5, 2.0, 1.75)
    assert {(r["bin"], r["count"]) for r in stats.equal_width_histogram(df, "a", 4).collect()} == {(0, 1), (3, 1)}


def test_profile_of_an_empty_frame_has_rows(spark):
    df = spark.createDataFrame([], "a double, b string")
    for options in (ProfileOptions(), EXACT, ProfileOptions(tree_fanout=4)):     # one plan's rows are the other's
        got = {r["column"]: (r["count"], r["null_count"], r["n"], r["min"]) for r in profile(df, "d", options=options).collect()}
        assert got == {"a": (0, 0, 0, None), "b": (0, 0, 0, None)}


def test_profiling_runs_no_job_before_the_action(spark):
    sc = spark.sparkContext
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    sc.setJobGroup("plan-only", "plan-only")
    profile(df, "d", options=EXACT)
    assert list(sc.statusTracker().getJobIdsForGroup("plan-only")) == []
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_quantiles_over_many_powers_of_ten(spark):
    df = spark.range(4000).select(F.pow(F.lit(10.0), (F.col("id") - 2000) / 8.0).alias("a"))
    got = exact_quantiles_columns(df, ["a"], [0.25, 0.5], small_range=1).first()
    want = df.agg(F.percentile("a", F.array(F.lit(0.25), F.lit(0.5)))).first()[0]
    assert all(math.isclose(g, w, rel_tol=1e-12) for g, w in zip((got["q0"], got["q1"]), want))


def test_histogram_shows_the_last_bin(spark):
    df = spark.range(100_040).select(F.when(F.col("id") < 100_000, 0.5).otherwise(9.9).alias("a"))
    assert histogram_table(profile(df, "d"), bins=10).first()["counts"][-1] >= 1


def test_histogram_counts_sum_to_n_with_rare_rows_in_inner_bins(spark):
    n, eps = 100_040, 0.0165
    x = F.when(F.col("id") < 100_000, 0.5).otherwise(9.9)
    got = histogram_table(profile(spark.range(n).select(x.alias("a")), "d"), bins=10).first()["counts"]
    assert sum(got) == n and 1 <= got[-1] <= 40 + eps * n and abs(got[0] - 100_000) <= eps * n
    # all values kept by the sketch: rare rows in inner bins are exact
    few = spark.createDataFrame([(0.0,)] * 150 + [(4.5,), (6.5,), (6.6,), (9.9,)], "a double")
    assert histogram_table(profile(few, "d"), bins=10).first()["counts"] == [150, 0, 0, 0, 1, 0, 2, 0, 0, 1]
    # rare inner rows of a large table, in sum over their bins
    rare = spark.range(n).select(F.when(F.col("id") % 100 == 7, 1.0 + F.col("id") % 97).otherwise(0.0).alias("a"))
    got = histogram_table(profile(rare, "d"), bins=98).first()["counts"]
    assert sum(got) == n and abs(sum(got[1:]) - 1000) <= eps * n
    for values in ([3.0], [3.0, 3.0], [1.0, 2.0]):
        one = spark.createDataFrame([(v,) for v in values], "a double")
        got = histogram_table(profile(one, "d"), bins=4).first()["counts"]
        assert sum(got) == len(values) and got[-1] == (2.0 in values)


def test_drift_between_two_profiles(spark):
    a = spark.range(20000).select((F.col("id") % 1000).cast("double").alias("x"))
    b = spark.range(20000).select((F.col("id") % 800 + 300).cast("double").alias("x"))
    bins, m = D.compare(profile(a, "a"), profile(b, "b"), "x", 10)
    both = a.withColumn("s", F.lit("a")).unionByName(b.withColumn("s", F.lit("b")))
    _, cells = D.two_sided(both, "x", F.col("s"), 10, sides=("a", "b"))
    got, want = m.first(), D.metrics(cells, 10).first()
    assert got["cells"] == want["cells"] == bins.cells
    assert abs(got["intersection"] - want["intersection"]) < 0.06 and abs(got["ks"] - want["ks"]) < 0.04
    none = D.compare(profile(a.limit(0), "a"), profile(b, "b"), "x", 10)[1].first()
    assert none["intersection"] is None


def test_drift_with_an_empty_side(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 5.0)], "s string, x double")
    _, cells = D.two_sided(df, "x", F.col("s"), 3, sides=("a", "b"))
    assert D.metrics(cells, 3).first()["cells"] > 0
    _, cells = D.two_sided(df.limit(0), "x", F.col("s"), 3, sides=("a", "b"))
    assert D.metrics(cells, 3).count() == 1


def test_stream_split_keeps_rows_without_time(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-10"), (2, "2024-01-01"), (3, None)], "i int, t string").withColumn("t", F.to_timestamp("t"))
    split_recent_writer("t", "2024-01-11", 3, f"{tmp_path}/new", f"{tmp_path}/old")(df, 0)
    assert [r["i"] for r in spark.read.parquet(f"{tmp_path}/new").collect()] == [1]
    assert sorted(r["i"] for r in spark.read.parquet(f"{tmp_path}/old").collect()) == [2, 3]


def test_stores_keep_name_time_and_tags(spark, tmp_path):
    df = spark.createDataFrame([("x", 1.0, "2024-01-10"), ("y", 2.0, "2024-02-10")], "g string, a double, t string").withColumn(
        "t", F.to_timestamp("t"))
    p = profile(df, "store-a", time_column="t", grain="month", tags=["g"])
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    writers.write_profile(p, f"{tmp_path}/s/one")
    writers.write_profile(profile(df.select("a"), "store-b"), f"{tmp_path}/s/two")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    assert files.read_profiles(spark, f"{tmp_path}/s", name="store-a", recursive=True).count() == 2
    assert files.read_profiles(spark, f"{tmp_path}/s/one", name="store-a").count() == 2
    writers.write_by_bucket(p, f"{tmp_path}/b", "month")
    assert {r["month"] for r in spark.read.option("basePath", f"{tmp_path}/b").parquet(f"{tmp_path}/b").select(
        F.col("month").cast("string")).collect()} == {"2024-01-01", "2024-02-01"}
    out = writers.write_flat(p, f"{tmp_path}/f")
    flat = files.read_flat_summary(spark, out["summary"]).collect()
    assert {(r["name"], str(r["dataset_timestamp"])[:7], r["tags"]) for r in flat} == {
        ("store-a", "2024-01", '[{"key":"g","value":"x"}]'), ("store-a", "2024-02", '[{"key":"g","value":"y"}]')}
    assert "tags" in spark.read.json(out["hist"]).columns
    with pytest.raises(ValueError):
        writers.write_all(p, [writers.WriterConfig(f"{tmp_path}/w", formats=["xml"])], "n")


def test_typed_extremes_merge_exactly(spark, tmp_path):
    wide = "12345678901234567890123456789012345678"
    rows = [(2**53 + 1, wide, "-0.5", "1.25", "2024-02-29", "z" * 100), (-(2**63), "-" + wide, "-1.5", "-0.000000000000000000000001", "1582-10-15", "Ä"),
            (2**63 - 1, None, None, None, "9999-12-31", ""), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a long, b string, c string, d string, e string, f string").select(
        "a", F.col("b").cast("decimal(38,0)").alias("b"), F.col("c").cast("decimal(5,1)").alias("c"), F.col("d").cast("decimal(30,24)").alias("d"),
        F.col("e").cast("date").alias("e"), F.col("e").cast("timestamp").alias("t"), F.col("f"), F.col("a").cast("double").alias("x"))
    want = {"a": (str(-(2**63)), str(2**63 - 1)), "b": ("-" + wide, wide), "c": ("-1.5", "-0.5"), "d": ("-0.000000000000000000000001", "1.25"),
            "e": ("1582-10-15", "9999-12-31"), "t": ("1582-10-15 00:00:00", "9999-12-31 00:00:00"), "f": ("", "Ä"), "x": (None, None)}
    look = lambda p: {r["column"]: (r["lo"], r["hi"]) for r in p.select("column", extreme_text(F.col("low")).alias("lo"), extreme_text(F.col("high")).alias("hi")).collect()}
    assert look(profile(df, "d")) == want
    each = [profile(df.filter(F.col("a").eqNullSafe(r[0])), "d") for r in rows]
    merged = merge_profiles(each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3]))
    merged.write.parquet(str(tmp_path / "p"))
    assert look(spark.read.parquet(str(tmp_path / "p"))) == want
    assert look(profile(df.filter("a = 9007199254740993"), "d"))["a"] == ("9007199254740993",) * 2
    assert look(profile(df, "d", options=ProfileOptions(tree_fanout=3))) == want
    assert look(profile(df.limit(0), "d")) == {c: (None, None) for c in want}
    # as numbers, not as rounded doubles, in the flat file
    flat = {r["column"]: r["max_value"] for r in files.read_flat_summary(spark, writers.write_flat(merged, str(tmp_path / "f"))["summary"]).collect()}
    assert flat["b"] == wide and flat["a"] == str(2**63 - 1) and flat["d"] == "1.25"


def test_infinite_ends_count_in_the_end_cells(spark):
    inf = float("inf")
    df = spark.createDataFrame([("a", v) for v in (-inf, 0.0, 5.0, 10.0, inf, inf)] + [("b", v) for v in (-inf, 3.0, 3.0)], "s string, x double")
    got = {r["bin"]: r["count"] for r in stats.equal_width_histogram(df.filter("s = 'a'"), "x", 10).collect()}
    assert got == {0: 2, 5: 1, 9: 3}
    assert {r["bin"]: r["count"] for r in stats.equal_width_histogram(df.filter("s = 'a'"), "x", 10, -inf, inf).collect()} == got
    only = spark.createDataFrame([(-inf,), (inf,), (None,)], "x double")
    assert {r["bin"]: r["count"] for r in stats.equal_width_histogram(only, "x", 4).collect()} == {0: 1, 3: 1}
    bins, cells = D.two_sided(df, "x", F.col("s"), 5, sides=("a", "b"))
    n = {r["cell"]: (r["na"], r["nb"]) for r in cells.collect()}
    assert (bins.lo, bins.hi) == (0.0, 10.0) and n[0] == (1, 1) and n[bins.cells - 1] == (3, 0)
    assert sum(a + b for a, b in n.values()) == 9 and 0 <= D.metrics(cells, 5).first()["intersection"] <= 1
    one, two = (profile(df.filter(F.col("s") == s).select("x"), s) for s in "ab")
    bins, m = D.compare(one, two, "x", 5)
    assert (bins.lo, bins.hi) == (0.0, 10.0) and 0 <= m.first()["intersection"] <= 1
    huge = spark.createDataFrame([("a", -1.7e308), ("a", 1.7e308), ("b", 0.0)], "s string, x double")
    assert {r["bin"]: r["count"] for r in stats.equal_width_histogram(huge, "x", 4).collect()} == {0: 1, 2: 1, 3: 1}
    bins, cells = D.two_sided(huge, "x", F.col("s"), 4, sides=("a", "b"))
    assert sum(r["na"] + r["nb"] for r in cells.collect()) == 3
