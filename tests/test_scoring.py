"""Forest scoring: the trees walked in Arrow batches predict what the fitted model predicts, and a sample is drawn once."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from tallyframe.operators import profile as P
from tallyframe.operators import scoring as M
from tallyframe.operators import shaping as S

SCHEMA = "a double, b int, c double, kind string"


def _rows(n, seed=5, gaps=0.1):
    r = random.Random(seed)
    return [(r.choice([r.uniform(-3, 3), None, float("nan")]) if r.random() < gaps else r.uniform(-3, 3),
             r.randrange(9) if r.random() >= gaps else None, r.choice([0.0, -0.0, 1.5]), r.choice("xyz")) for _ in range(n)]


def _counted(spark, rows, seen):
    def tell(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return spark.createDataFrame(rows, SCHEMA).repartition(2).mapInArrow(tell, SCHEMA)


def test_forest_reads_its_rows_once_and_scores_like_the_fitted_model(spark):
    seen = spark.sparkContext.accumulator(0)
    model, back = M.random_forest(_counted(spark, _rows(300, gaps=0), seen), ["a", "b", "c"], "kind")
    assert seen.value == 300
    df = spark.createDataFrame(_rows(500, 6), SCHEMA).withColumn("id", F.monotonically_increasing_id())
    got = M.score((model, back), df)
    assert got.columns == ["a", "b", "c", "kind", "id", "prediction"]
    want = back.transform(model.transform(df))
    assert {r["id"]: r["prediction"] for r in got.collect()} == {r["id"]: r["prediction"] for r in want.collect()}
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()


def _stump(feature, threshold, left, right):
    """A tree of one split: right child, then left child, side by side."""
    return (np.array([feature, 0, 0]), np.array([threshold, np.inf, np.inf]), np.array([2, 1, 1, 1, 2, 2]),
            np.array([[.5, .5], left, right]), 1)


def test_rows_find_their_class_by_cell_as_by_the_trees(monkeypatch):
    deep = (np.array([1, 0, 0, 0, 0]), np.array([0.0, 1.5, np.inf, np.inf, np.inf]), np.array([2, 1, 4, 3, 2, 2, 3, 3, 4, 4]),
            np.array([[.5, .5], [.5, .5], [.1, .9], [.8, .2], [.3, .7]]), 2)
    odd = [-np.inf, -2.0, -0.0, 0.0, 0.5, 1.0, 1.5, 2.0, np.inf, np.nan]
    x = np.array([(a, b, c) for a in odd for b in odd for c in (3.0, np.nan)]).T
    for trees in ([deep], [deep, _stump(0, -2.0, [1, 0], [.4, .6]), _stump(0, 2.0, [0, 1], [.9, .1])],
                  [_stump(1, np.inf, [1, 0], [0, 1])], [_stump(1, -np.inf, [1, 0], [0, 1])]):
        want = M.forest_votes(trees, x).argmax(axis=1)
        assert 0 < want.sum() < len(want)
        np.testing.assert_array_equal(M.cell_classes(M.forest_cells(trees, 3), x), want)
    # the trees are walked once a cell, however many rows there are; beyond CELLS cells there is no table
    walked, walk = [], M.forest_votes
    monkeypatch.setattr(M, "forest_votes", lambda t, x: walked.append(x.shape[1]) or walk(t, x))
    M.cell_classes(M.forest_cells([deep], 3), np.zeros((3, 100_000)))
    assert walked == [4]
    monkeypatch.setattr(M, "CELLS", 3)
    assert M.forest_cells([deep], 3) is None


def test_forest_with_too_many_cells_is_walked(spark, monkeypatch):
    model = M.random_forest(spark.createDataFrame(_rows(200, gaps=0), SCHEMA), ["a", "b", "c"], "kind")
    df = spark.createDataFrame(_rows(300, 6), SCHEMA).withColumn("id", F.monotonically_increasing_id())
    by_cell = {r["id"]: r["prediction"] for r in M.score(model, df).collect()}
    monkeypatch.setattr(M, "CELLS", 0)
    assert {r["id"]: r["prediction"] for r in M.score(model, df).collect()} == by_cell


def test_small_samples_hash_their_table_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = [(float(i), i, 0.0, "x") for i in range(2000)]
    df = _counted(spark, rows, seen)
    got = S.exact_sample(df, ["b"], size=20)
    assert got.rows.count() == 20
    assert seen.value == 2 * 2000       # counted, then hashed
    want = spark.createDataFrame(rows, SCHEMA).withColumn("h", S.row_hash(["b"], 123)).orderBy("h").limit(20)
    picked = {r["b"] for r in want.collect()}
    assert {r["b"] for r in got.rows.collect()} == picked
    assert {r["b"] for r in got.complement.collect()} == set(range(2000)) - picked
    # one key in all rows: every row is as low as the others
    same = S.exact_sample(spark.createDataFrame([(float(i), 1, 0.0, "x") for i in range(500)], SCHEMA), ["b"], size=7)
    a, b = ([r["a"] for r in part.collect()] for part in (same.rows, same.complement))
    assert len(a) == 7 and sorted(a + b) == [float(i) for i in range(500)]


def test_evenly_filled_scans_are_not_spread(spark, tmp_path):
    even, uneven = str(tmp_path / "even"), str(tmp_path / "uneven")
    spark.range(0, 3000, 1, 3).write.parquet(even)          # 3 tasks of 1,000 rows on 4 cores
    spark.range(0, 3000, 1, 1).write.parquet(uneven)
    for path, moved in ((even, False), (uneven, True)):
        df, parts = P.spread_input(spark.read.parquet(path), P.ProfileOptions())
        assert ("Exchange" in df._jdf.queryExecution().executedPlan().toString()) == moved
        assert parts == spark.sparkContext.defaultParallelism
        assert df.count() == 3000


def test_batches_are_scored_in_one_scan(spark, tmp_path):
    from __spark_entry__ import queries
    days = [dt.datetime(1995 + i % 3, 5, 1) if i % 10 else None for i in range(60)]
    rows = [(i, 5, 6, 1, float(i % 7), 0.01 * (i % 5), 0.02, "NAR"[i % 3], d) for i, d in enumerate(days)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = queries()["score_batches"](spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    want = {(str(y), c, sum(d is not None and d.year == y for d in days), dt.datetime(2024, 2, 1) - dt.timedelta(days=2001 - y))
            for y in (1995, 1996, 1997) for c in ("l_quantity", "l_discount", "l_tax", "prediction")}
    assert {(r["batch"], r["column"], r["count"], r["dataset_timestamp"]) for r in got.collect()} == want


def test_tags_of_any_type_keep_their_texts(spark):
    df = spark.createDataFrame([(0.0, None, 1), (-0.0, "x", 2), (0.0, None, 3)], "f double, s string, v int")
    got = P.profile(df, tags=["s", "f"], static_tags={"k": "c"}, options=P.ProfileOptions(sketches=False))
    assert {(tuple((t["key"], t["value"]) for t in r["tags"]), r["count"]) for r in got.collect()} == {
        ((("f", "0.0"), ("k", "c"), ("s", None)), 2), ((("f", "-0.0"), ("k", "c"), ("s", "x")), 1)}
