import os

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.profile import ProfileOptions, profile
from tallyframe.streaming import profile_stream as PS
from tallyframe.streaming.profile_store import ProfileStore, read_stores


def test_batch_writer_is_idempotent(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    w = PS.batch_profiles_writer("events", str(tmp_path / "p"))
    w(e, 7)
    w(e, 7)   # a replayed batch rewrites, not appends
    got = spark.read.parquet(str(tmp_path / "p"))
    assert got.filter(F.col("column") == "value").select("count").first()[0] == e.count()
    assert got.count() == len(e.columns)
    assert os.path.isdir(tmp_path / "p" / "batch_id=7")


def _exact(p):
    names = ["dataset_timestamp", "tags", "column", "count", "null_count", "n", "min", "max"]
    return sorted((tuple(str(x) for x in r) for r in p.select(*names).collect()))


def test_store_replays_compacts_and_bounds_its_folders(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    opts = ProfileOptions()
    store = ProfileStore(spark, str(tmp_path / "s"), compact_every=3, options=opts)
    with pytest.raises(ValueError):
        store.read()
    write = store.writer("events", "ts", "day", ["event_type"])
    parts = [e.filter(F.col("event_id") % 4 == i) for i in range(4)] + [e.filter("event_id < 0")]
    for i, part in enumerate(parts):
        write(part, i)
        assert store.folders() <= 3
        before = store.manifest()
        write(part, i)                               # a replay, before or after compaction, changes nothing
        assert store.manifest() == before
    assert store.manifest()["upto"] == 2 and store.folders() == 3
    # what a failed attempt leaves behind is not part of the store
    parts[0].write.parquet(str(tmp_path / "s" / "batches" / "9-left-over"))
    want = profile(e, "events", time_column="ts", grain="day", tags=["event_type"], options=opts)
    assert _exact(store.read()) == _exact(want)
    m2 = {(r["dataset_timestamp"], str(r["tags"]), r["column"]): r["m2"] for r in want.collect()}
    got = store.read().collect()
    assert all(r["m2"] is None or abs(r["m2"] - m2[r["dataset_timestamp"], str(r["tags"]), r["column"]]) < 1e-6 * max(1, r["m2"]) for r in got)
    # sketches survive two merges: distinct values are exact here, frequent items too
    ids = store.read().filter("`column` = 'event_id'").agg(F.sum(F.expr("theta_sketch_estimate(theta)"))).first()[0]
    assert ids == e.count() and all(r["topk"] is None for r in got if r["column"] == "value")
    store.compact()
    assert store.folders() == 1 and _exact(store.read()) == _exact(want)


def test_stores_of_two_workers_merge(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    stores = [ProfileStore(spark, str(tmp_path / str(i))) for i in range(2)]
    for i, s in enumerate(stores):
        s.writer("events", "ts", "month")(e.filter(F.col("event_id") % 2 == i), 0)
    assert _exact(read_stores(stores)) == _exact(profile(e, "events", time_column="ts", grain="month"))


def test_store_keeps_rows_without_time_and_late_rows(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-05", 1.0), (None, 2.0), ("2024-01-01", 3.0)], "t string, x double").withColumn("t", F.to_timestamp("t"))
    store = ProfileStore(spark, str(tmp_path / "s"), compact_every=2)
    for i, r in enumerate(df.collect()):
        store.writer("d", "t")(spark.createDataFrame([r], df.schema), i)
    assert sorted((str(r["dataset_timestamp"])[:10], r["max"]) for r in store.read().collect()) == [
        ("2024-01-01", 3.0), ("2024-01-05", 1.0), ("None", 2.0)]


def test_closed_windows_leave_the_state(spark, tmp_path):
    from tallyframe.plans import stream_plans
    days = [f"2024-01-{d:02d}" for d in range(1, 9)]
    rows = [(i, f"{d} 0{h}:00:00") for i, (d, h) in enumerate((d, h) for d in days for h in range(3))]
    df = spark.createDataFrame(rows, "event_id long, ts string").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "events.parquet"))
    stream = stream_plans._ordered_stream(spark, str(tmp_path))
    p, report = stream_plans._append(spark, stream)
    assert {str(r["dataset_timestamp"])[:10]: r["count"] for r in p.collect()} == {d: 3 for d in days[:6]}
    assert report["input_rows"] == 24 and report["emitted_rows"] == 18 and report["removed_windows"] == 6
    assert report["open_windows"] == 2 and report["late_partials"] == 0
