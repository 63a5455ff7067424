from pyspark.sql import functions as F

from tallyframe.operators.merge import merge_profiles
from tallyframe.operators.profile import ITEM_MARK, ProfileOptions, profile
from tallyframe.operators.summary import frequent_strings_table, whole_texts


def _rows(df):
    return {(r["column"], r["value"]): (r["count_low"], r["count"], r["digest"]) for r in df.collect()}


def test_long_texts_are_tracked_by_digest_and_fetched_whole(spark):
    a, b, short = "x" * 1_000_000, "x" * 1_000_000 + "y", "s" * 64
    odd = ITEM_MARK + "0" * 32 + "like a tracked item"
    df = spark.createDataFrame([(t, None) for t in [a] * 5 + [b] * 3 + [short] * 2 + [odd] * 2 + ["", None]], "t string, other string")
    p = profile(df, "d")
    assert p.select(F.max(F.length("topk.sketch"))).first()[0] < 4000
    f = frequent_strings_table(p)
    assert {r["digest"] is None for r in f.filter(F.length("value") == 24).collect()} == {False}
    got = _rows(whole_texts(f, df))
    assert {k: v[:2] for k, v in got.items()} == {("t", a): (5, 5), ("t", b): (3, 3), ("t", short): (2, 2), ("t", odd): (2, 2), ("t", ""): (1, 1)}
    assert got["t", short][2] is None and len(got["t", odd][2]) == 32
    # a table that does not hold the winners leaves the first characters
    assert ("t", "x" * 24) in _rows(whole_texts(f, df.limit(0))) and whole_texts(f, spark.range(1)).count() == 5


def test_counts_lie_within_bounds_after_merges_and_the_sketch_stays_small(spark):
    n = 60_000
    copy = F.when(F.col("id") % 20 == 0, F.lit(7)).when(F.col("id") % 20 == 1, F.lit(8)).otherwise(F.col("id") + 100)
    df = spark.range(n).repartition(6).select(F.rpad(F.concat(copy.cast("string"), F.lit("-")), 300, "ab").alias("t"))
    exact = {r["t"]: r["count"] for r in df.groupBy("t").count().filter("count > 1").collect()}
    whole = profile(df, "d", options=ProfileOptions(tree_fanout=3))
    halves = [profile(df.filter(F.pmod(F.xxhash64("t"), F.lit(2)) == i), "d") for i in range(2)]
    for p in (whole, merge_profiles(halves[0].unionByName(halves[1]))):
        got = _rows(whole_texts(frequent_strings_table(p), df))
        assert set(exact) <= {v for _, v in got}
        for text, count in exact.items():
            low, high, _ = got["t", text]
            assert low <= count <= high and high - low <= n * 3.5 / 256
        assert p.select(F.max(F.length("topk.sketch"))).first()[0] < 20_000
