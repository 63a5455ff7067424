"""Profiles of streams (Structured Streaming).

The profile aggregates are Spark's own mergeable aggregates, so they run
unchanged in a streaming aggregation: ``withWatermark`` + ``groupBy(
window(ts, grain), tags)`` keeps one bounded state per open window, and
windows behind the watermark are evicted (append mode) or kept (complete
mode).  Micro-batch output goes through ``foreachBatch`` writers that are
idempotent per batch id, so a restarted query rewrites the same files.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.profile import (ProfileOptions, _tags_column, profile, quote,
                                          wide_plan)
from tallyframe.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Files arriving in ``path`` as a stream (``maxFilesPerTrigger`` bounds a micro-batch)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ event time is cast (UTC session)."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return df.withColumn(column, F.col(quote(column)).cast("timestamp"))
    return df


@dataclass
class StreamProfile:
    """A streaming profile aggregate and the projection of its rows to long form."""

    wide: DataFrame          # streaming DataFrame: one wide row per (window, tags)
    to_long: Column          # generator over a wide row
    name: str

    def long(self, wide_rows: DataFrame) -> DataFrame:
        return wide_rows.select(F.lit(self.name).alias("name"),
                                F.col("__window.start").alias("dataset_timestamp"),
                                F.col("__tags").alias("tags"), self.to_long)


def profile_stream(stream: DataFrame, name: str, time_column: str, grain: str = "1 day",
                   watermark: str = "1 day", tags=(), options: ProfileOptions = ProfileOptions(),
                   columns=None) -> StreamProfile:
    s = event_time(stream, time_column)
    fields = [f for f in s.schema.fields if f.name != time_column and f.name not in tags
              and (columns is None or f.name in columns)]
    plan = wide_plan(fields, options)
    wide = (plan.derive(s.withWatermark(time_column, watermark))
            .groupBy(F.window(F.col(quote(time_column)), grain).alias("__window"),
                     _tags_column({t: F.col(quote(t)) for t in tags}, None).alias("__tags"))
            .agg(*plan.aggs))
    return StreamProfile(wide, plan.to_long, name)


def run_available_now(writer_df: DataFrame, mode: str, batch_fn, checkpoint: str,
                      timeout_s: int | None = None):
    """Drain everything available in micro-batches, then stop (``availableNow``); no time limit unless given."""
    q = (writer_df.writeStream.outputMode(mode).foreachBatch(batch_fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not drain in time")
    if q.exception():
        raise q.exception()
    return q


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain_closed_windows(spark: SparkSession, sp: StreamProfile, path: str, checkpoint: str) -> dict[str, int]:
    """Drain a stream in append mode with its state in RocksDB; say from the query's progress what became of its rows.

    A window is emitted once the watermark has passed its end, and its state ends with it; rows that come later
    are dropped.  Returns the number of micro-batches with data, input rows, emitted rows, rows not emitted (of
    windows still open, or late), window states removed and left, and the late partial rows dropped: the stream drops
    them after its partial aggregation, so there is one for each input partition and late window of a micro-batch.
    """
    conf = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.streaming.numRecentProgressUpdates": "100000"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        progress = run_available_now(sp.wide, "append", profile_sink_writer(sp, path, False), checkpoint).recentProgress
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    emitted = (spark.read.parquet(path).select("dataset_timestamp", "tags", "count").distinct().agg(F.sum("count")).first()[0] or 0)
    rows = sum(p.numInputRows for p in progress)
    operators = [p.stateOperators[0] for p in progress if p.stateOperators]
    return {"micro_batches": sum(p.numInputRows > 0 for p in progress), "input_rows": rows, "emitted_rows": emitted,
            "not_emitted_rows": rows - emitted, "removed_windows": sum(o.numRowsRemoved for o in operators),
            "open_windows": operators[-1].numRowsTotal if operators else 0,
            "late_partials": sum(o.numRowsDroppedByWatermark for o in operators)}


def profile_sink_writer(sp: StreamProfile, path: str, complete: bool):
    """foreachBatch writer: complete mode rewrites the table, append mode adds
    one partition per batch id (overwritten if the batch is replayed)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = sp.long(batch)
        if complete:
            rows.write.mode("overwrite").parquet(path)
        else:
            rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                os.path.join(path, f"batch_id={batch_id}"))
    return write


def stream_profile_table(spark: SparkSession, stream: DataFrame, name: str, time_column: str,
                         grain: str = "1 day", watermark: str = "1 day", mode: str = "complete",
                         options: ProfileOptions = ProfileOptions(), tags=()) -> DataFrame:
    """Run a stream profile to the end of the available input; return the profile rows."""
    sp = profile_stream(stream, name, time_column, grain, watermark, tags, options)
    out = scratch_path(spark, "stream-profile")
    ckpt = scratch_path(spark, "stream-ckpt")
    run_available_now(sp.wide, mode, profile_sink_writer(sp, out, mode == "complete"), ckpt)
    return spark.read.parquet(out)


def batch_profiles_writer(name: str, path: str, options: ProfileOptions = ProfileOptions()):
    """foreachBatch writer profiling each micro-batch as a whole (one worker's
    profile per batch), idempotent by batch id, for a later N-way merge."""
    def write(batch: DataFrame, batch_id: int) -> None:
        p = profile(batch, name, options=options, static_tags={"batch_id": str(batch_id)})
        p.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))
    return write


def split_recent_writer(ts_column: str, ref_ts, days: int, recent_path: str, old_path: str):
    """foreachBatch writer: rows newer than ``ref_ts - days`` to the real-time
    sink, older ones and those without an event time to the batch sink (both
    idempotent by batch id)."""
    import datetime as dt
    cut = (ref_ts if isinstance(ref_ts, dt.datetime) else dt.datetime.fromisoformat(ref_ts)) \
        - dt.timedelta(days=days)

    def write(batch: DataFrame, batch_id: int) -> None:
        recent = F.coalesce(F.col(quote(ts_column)) >= F.lit(cut), F.lit(False))
        batch.filter(recent).write.mode("overwrite").parquet(
            os.path.join(recent_path, f"batch_id={batch_id}"))
        batch.filter(~recent).write.mode("overwrite").parquet(
            os.path.join(old_path, f"batch_id={batch_id}"))
    return write
