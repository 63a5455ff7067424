"""Exact quantiles by range narrowing equal Spark's percentile (incl. a hot value)."""

import random
import struct

from pyspark.sql import functions as F

from tallyframe.operators.quantiles import exact_quantiles, ordered_image

QS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def _close(a, b):
    return all(abs(x - y) <= 1e-9 * max(1.0, abs(y)) for x, y in zip(a, b))


def test_global_and_hot_value(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    hot = li.select(F.when(F.col("l_linenumber") <= 2, F.lit(7.0))
                    .otherwise(F.col("l_extendedprice")).alias("v"))
    for df, c in ((li, "l_extendedprice"), (hot, "v")):
        got = exact_quantiles(df, c, QS, small_range=5).first()
        want = df.agg(F.percentile(c, QS)).first()[0]
        assert _close([got[f"q{i}"] for i in range(len(QS))], want)


def test_grouped(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet") \
        .withColumn("day", F.date_trunc("day", "ts"))
    got = {r["day"]: [r[f"q{i}"] for i in range(len(QS))]
           for r in exact_quantiles(ev, "value", QS, by=["day"], small_range=3).collect()}
    want = {r[0]: r[1] for r in ev.groupBy("day").agg(F.percentile("value", QS)).collect()}
    assert got.keys() == want.keys()
    assert all(_close(got[d], want[d]) for d in want)


SPECIAL = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, -2.0 ** -1022, 2.0 ** -1023, 1.0, 1.0 + 2.0 ** -52, 2.0 - 2.0 ** -52, 2.0, -1.5,
           1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 3e-310, 1e16, 2.0 ** 53 + 2]


def test_ordered_image_is_that_of_the_bits(spark):
    rng = random.Random(2)
    xs = SPECIAL + [m * 2.0 ** e * s for e in range(-1074, 1024, 7) for m in (1.0, 1 + rng.random() / 2, 2 - 2.0 ** -52) for s in (1, -1)]
    got = {r["i"]: r["k"] for r in spark.createDataFrame(list(enumerate(xs)), "i int, x double").select("i", ordered_image(F.col("x")).alias("k")).collect()}
    for i, x in enumerate(xs):
        bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert got[i] == (-bits if x < 0 else bits), x


def test_infinite_subnormal_mixed_and_tied_values_in_fixed_rounds(spark, monkeypatch):
    rng = random.Random(3)
    values = SPECIAL * 3 + [rng.choice([1, -1]) * 10.0 ** rng.uniform(-320, 308) for _ in range(700)] + [7.25] * 300
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    rounds = []
    plain = type(df).checkpoint
    monkeypatch.setattr(type(df), "checkpoint", lambda self, eager=True: rounds.append(1) or plain(self, eager))
    n, s = len(values), sorted(values)
    qs = [i / (n - 1) for i in range(0, n, 97)] + [1.0]
    got = exact_quantiles(df, "x", qs, small_range=0).first()
    for i, q in enumerate(qs):
        assert got[f"q{i}"] == s[round(q * (n - 1))]
    one = exact_quantiles(spark.createDataFrame([(float("-inf"),), (float("inf"),)], "x double"), "x", [0.0, 0.5, 1.0], small_range=0).first()
    assert one["q0"] == float("-inf") and one["q1"] != one["q1"] and one["q2"] == float("inf")
    assert 4 <= len(rounds) <= 10          # two searches of at most 2 tables and 3 rounds each


def test_many_groups(spark):
    df = spark.range(200_000).select((F.col("id") % 100_000).alias("g"), ((F.col("id") * 7919) % 1009).cast("double").alias("x"))
    got = exact_quantiles(df, "x", [0.0, 1.0], by=["g"])
    want = df.groupBy("g").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    assert got.join(want, "g").filter("q0 = a and q1 = b").count() == 100_000
