"""Random batches: drawn by one pass of hashes, whatever reads them, and the rows that plain Python draws."""

import hashlib

from pyspark.sql import functions as F

from tallyframe.operators import shaping as S

SCHEMA = "a long, b string, v double"
ROWS = [(i % 97 if i % 11 else None, f"k{i}" if i % 13 else None, float(i)) for i in range(1, 600)]


def _counted(spark, rows, seen):
    def tell(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return spark.createDataFrame(rows, SCHEMA).repartition(3).mapInArrow(tell, SCHEMA)


def _drawn(rows, batch, size):
    def h(r):
        return hashlib.md5("|".join([str(x) for x in r[:2] if x is not None] + ["9", str(batch)]).encode()).hexdigest()
    return sorted(h(r) for r in rows)[:size], h


def test_batches_hash_each_row_once(spark):
    seen = spark.sparkContext.accumulator(0)
    got = S.random_batches(_counted(spark, ROWS, seen), ["a", "b"], batches=6, size=4, seed=9)
    after_draw = seen.value
    assert got.count() == 24 and got.agg(F.sum("v")).first()[0] > 0
    # one pass for the number of rows, one for the draws; none when the batches are read
    assert after_draw <= 2 * len(ROWS) and seen.value == after_draw


def test_batches_are_the_smallest_hashes(spark):
    got = S.random_batches(spark.createDataFrame(ROWS, SCHEMA), ["a", "b"], batches=6, size=4, seed=9).collect()
    for batch in range(6):
        want, h = _drawn(ROWS, batch, 4)
        drawn = [r for r in got if r["batch"] == batch]
        assert sorted(hashlib.md5("|".join([str(x) for x in (r["a"], r["b"]) if x is not None] + ["9", str(batch)]).encode())
                      .hexdigest() for r in drawn) == want
        assert len({r["v"] for r in drawn}) == 4


def test_batches_of_repeated_keys_few_rows_and_none(spark):
    same = [(1, "x", float(i)) for i in range(300)]
    got = S.random_batches(spark.createDataFrame(same, SCHEMA), ["a", "b"], batches=3, size=4, seed=9).collect()
    assert sorted(r["batch"] for r in got) == [0] * 4 + [1] * 4 + [2] * 4
    few = S.random_batches(spark.createDataFrame(ROWS[:2], SCHEMA), ["a", "b"], batches=3, size=4, seed=9)
    assert few.count() == 6
    none = S.random_batches(spark.createDataFrame([], SCHEMA), ["a", "b"], batches=3, size=4, seed=9)
    assert none.count() == 0 and none.columns == ["a", "b", "v", "batch"]


def test_run_profiles_draws_its_batches_once(spark, monkeypatch):
    from tallyframe.plans import scoring_plans
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"
    rows = [(i, i * 7 % 50, i % 9, i % 5, float(i % 50), 1000.0 + i) for i in range(400)]
    seen = spark.sparkContext.accumulator(0)

    def tell(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    monkeypatch.setattr(scoring_plans, "table",
                        lambda *_: spark.createDataFrame(rows, names).mapInArrow(tell, names))
    out = scoring_plans.run_profiles(spark, "")
    assert out.select("run_id").distinct().count() == 20
    # one pass for the number of rows, one for the draws; metrics, profiles and the run table read the drawn rows
    assert seen.value <= 2 * len(rows)
