"""Streaming queries (T1-T6): events replayed as a file stream.

The events table is laid out as several files in the shared folder (data
Spark derives from the table) so that ``maxFilesPerTrigger`` yields many
micro-batches; each query drains the stream with ``availableNow`` and
returns what its sink holds.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from tallyframe.operators.merge import merge_profiles
from tallyframe.operators.summary import exact_view
from tallyframe.plans.registry import register
from tallyframe.plans.sqlgen import kinds, profile_sql
from tallyframe.session import scratch_path
from tallyframe.sources.tables import table
from tallyframe.operators.constraints import parse_constraints
from tallyframe.streaming import constraint_stream as CS
from tallyframe.streaming import profile_stream as PS
from tallyframe.streaming.profile_store import ProfileStore

FILES = 10
REF_TS = "2024-01-31 00:00:00"


def _event_files(spark, sf_dir):
    """events split into FILES parquet files, ordered by time across files."""
    e = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-files")
    e.repartitionByRange(FILES, "ts").write.parquet(path)
    return path, e.schema


def _stream(spark, sf_dir, per_trigger=1):
    path, schema = _event_files(spark, sf_dir)
    return PS.file_stream(spark, path, schema, max_files_per_trigger=per_trigger)


@register("stream_profile", sql=profile_sql(
    "events", kinds("events", exclude=("ts",)),
    keys=[("date_trunc('day', ts)", "dataset_timestamp")]))
def stream_profile(spark, sf_dir):
    """Streaming profile per day window (complete mode) equals the batch profile."""
    s = _stream(spark, sf_dir, per_trigger=5)
    p = PS.stream_profile_table(spark, s, "events", "ts", "1 day", "1 day", mode="complete")
    return exact_view(p, extra_keys=[F.col("dataset_timestamp").cast("timestamp")
                                     .alias("dataset_timestamp")])


@register("stream_profile_tags", sql=profile_sql(
    "events", kinds("events", exclude=("ts", "event_type")),
    keys=[("date_trunc('day', ts)", "dataset_timestamp"), ("'event_type=' || event_type", "segment")]))
def stream_profile_tags(spark, sf_dir):
    """T1 with tags: streaming profile per (day window, event type)."""
    from tallyframe.operators.profile import segment_label
    s = _stream(spark, sf_dir, per_trigger=5)
    p = PS.stream_profile_table(spark, s, "events", "ts", "1 day", "1 day", mode="complete",
                                tags=("event_type",))
    return exact_view(p, extra_keys=[F.col("dataset_timestamp").cast("timestamp")
                                     .alias("dataset_timestamp"), segment_label().alias("segment")])


@register("stream_drain", sql="""
SELECT date_trunc('day', ts) AS day, CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY 1""")
def stream_drain(spark, sf_dir):
    """Drain micro-batches (one file each) until empty, then stop."""
    s = _stream(spark, sf_dir, per_trigger=1)
    out = scratch_path(spark, "drain")

    def write(batch, batch_id):
        (batch.groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}")))

    PS.run_available_now(s, "append", write, scratch_path(spark, "drain-ckpt"))
    got = spark.read.parquet(out)
    return got.groupBy(F.col("day").cast("timestamp").alias("day")).agg(
        F.sum("rows").cast("bigint").alias("rows"))


@register("stream_batches", sql=f"SELECT CAST({FILES} AS BIGINT) AS micro_batches, CAST(count(*) AS BIGINT) AS rows FROM events")
def stream_batches(spark, sf_dir):
    """Number of micro-batches drained (one per file) and rows seen."""
    s = _stream(spark, sf_dir, per_trigger=1)
    out = scratch_path(spark, "drain-count")

    def write(batch, batch_id):
        batch.agg(F.count(F.lit(1)).alias("rows")).withColumn("b", F.lit(batch_id)) \
            .write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    PS.run_available_now(s, "append", write, scratch_path(spark, "drain-count-ckpt"))
    got = spark.read.parquet(out)
    return got.agg(F.count_distinct("b").cast("bigint").alias("micro_batches"),
                   F.sum("rows").cast("bigint").alias("rows"))


CLOSED = "date_trunc('day', ts) + INTERVAL 2 DAY <= (SELECT max(ts) FROM events)"


def _ordered_stream(spark, sf_dir, late_ids=0):
    """events as FILES files read one per micro-batch in event-time order.

    The file source reads files by modification time, so theirs are set in that order.  With ``late_ids``
    the rows whose event_id it divides and that are over 10 days older than the newest come in one more file, last.
    """
    e = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events-ordered")
    late = F.lit(False)
    if late_ids:
        newest = e.agg(F.max("ts")).first()[0]
        late = (F.col("event_id") % late_ids == 0) & (F.col("ts") < F.lit(newest - dt.timedelta(days=10)))
    # files are named by partition, so ranges of time come in the order of their names
    e.filter(~late).repartitionByRange(FILES, "ts").write.parquet(path)
    if late_ids:
        e.filter(late).coalesce(1).write.mode("append").parquet(path)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files = [f for f in fs.listStatus(fs_path(path)) if f.getPath().getName().endswith(".parquet")]
    # files of the second write go last; within one write the part number orders
    files.sort(key=lambda f: f.getPath().getName())
    if late_ids:
        last = max(files, key=lambda f: f.getModificationTime())
        files = [f for f in files if f is not last] + [last]
    start = max(f.getModificationTime() for f in files)
    for i, f in enumerate(files):
        fs.setTimes(f.getPath(), start + 1000 * (i - len(files)), -1)
    return PS.file_stream(spark, path, e.schema, max_files_per_trigger=1)


def _append(spark, stream, tags=()):
    sp = PS.profile_stream(stream, "events", "ts", "1 day", "1 day", tags)
    out = scratch_path(spark, "stream-closed")
    report = PS.drain_closed_windows(spark, sp, out, scratch_path(spark, "stream-ckpt"))
    return spark.read.parquet(out).drop("batch_id"), report


@register("stream_append", sql=profile_sql(
    "events", kinds("events", exclude=("ts",)),
    keys=[("date_trunc('day', ts)", "dataset_timestamp")],
    where=CLOSED))
def stream_append(spark, sf_dir):
    """T4: FILES micro-batches in event-time order; append mode emits a day, sketches included, once the
    watermark (1 day) passes its end, and drops its state.  The last two days stay open."""
    p, _ = _append(spark, _ordered_stream(spark, sf_dir))
    return exact_view(p, extra_keys=[F.col("dataset_timestamp").cast("timestamp")
                                     .alias("dataset_timestamp")])


@register("stream_append_sketches", sql=f"""
SELECT date_trunc('day', ts) AS day, CAST(count(DISTINCT user_id) AS BIGINT) AS users, TRUE AS median_within
FROM events WHERE {CLOSED} GROUP BY 1""")
def stream_append_sketches(spark, sf_dir):
    """T4: the sketches of the emitted days: distinct users (theta, exact below 4,096), and whether the KLL
    median's rank in the day's rows is within 1.33 % of the middle."""
    p, _ = _append(spark, _ordered_stream(spark, sf_dir))
    day = F.col("dataset_timestamp").cast("timestamp").alias("day")
    users = p.filter("`column` = 'user_id'").select(day, F.expr("theta_sketch_estimate(theta)").cast("bigint").alias("users"))
    median = p.filter("`column` = 'value'").select(day, F.expr("kll_sketch_get_quantile_double(kll, 0.5D)").alias("m"))
    rows = table(spark, sf_dir, "events").select(F.date_trunc("day", "ts").cast("timestamp").alias("day"), "value")
    rank = rows.join(median, "day").groupBy("day").agg(
        (F.count_if(F.col("value") <= F.col("m")) / F.count("value")).alias("upto"),
        (F.count_if(F.col("value") < F.col("m")) / F.count("value")).alias("below"))
    within = (F.col("below") <= 0.5133) & (F.col("upto") >= 0.4867)
    return users.join(rank, "day").select("day", "users", within.alias("median_within"))


@register("stream_late", sql=f"""
WITH t AS (SELECT max(ts) AS newest FROM events),
r AS (SELECT ts, event_id % 50 = 0 AND ts < newest - INTERVAL 10 DAY AS late, date_trunc('day', ts) + INTERVAL 2 DAY <= newest AS closed FROM events, t)
SELECT CAST({FILES} + 1 AS BIGINT) AS micro_batches, CAST(count(*) AS BIGINT) AS input_rows,
  CAST(count(*) FILTER (WHERE closed AND NOT late) AS BIGINT) AS emitted_rows, CAST(count(*) FILTER (WHERE late OR NOT closed) AS BIGINT) AS not_emitted_rows,
  CAST(count(DISTINCT date_trunc('day', ts)) FILTER (WHERE closed) AS BIGINT) AS removed_windows,
  CAST(count(DISTINCT date_trunc('day', ts)) FILTER (WHERE NOT closed) AS BIGINT) AS open_windows,
  CAST(count(DISTINCT date_trunc('day', ts)) FILTER (WHERE late) AS BIGINT) AS late_partials
FROM r""")
def stream_late(spark, sf_dir):
    """T4: rows that come after their day was emitted are dropped and counted; state ends with its window.

    All late rows lie in one file, so there is one late partial for each of their days (while that file is one split).
    """
    _, report = _append(spark, _ordered_stream(spark, sf_dir, late_ids=50))
    return spark.createDataFrame([tuple(report.values())], ", ".join(f"{k} bigint" for k in report))


@register("stream_store", sql=profile_sql(
    "events", kinds("events", exclude=("ts", "event_type")),
    keys=[("date_trunc('day', ts)", "dataset_timestamp"), ("'event_type=' || event_type", "segment")]))
def stream_store(spark, sf_dir):
    """Micro-batches in any order go to an incremental store as partial profiles per day and event
    type; compaction after every third batch merges them.  A replay of the whole stream changes nothing."""
    from tallyframe.operators.profile import segment_label
    stream = _stream(spark, sf_dir, per_trigger=1)
    store = ProfileStore(spark, scratch_path(spark, "stream-store"), compact_every=3)
    for _ in range(2):      # the second run replays every batch under the same ids
        PS.run_available_now(stream, "append", store.writer("events", "ts", "day", ("event_type",)), scratch_path(spark, "store-ckpt"))
    return exact_view(store.read(), extra_keys=[F.col("dataset_timestamp").cast("timestamp")
                                                .alias("dataset_timestamp"), segment_label().alias("segment")])


@register("late_split", sql=f"""
SELECT CASE WHEN ts >= TIMESTAMP '{REF_TS}' - INTERVAL 7 DAY THEN 'realtime' ELSE 'batch' END AS sink,
  date_trunc('day', ts) AS day, CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY 1, 2""")
def late_split(spark, sf_dir):
    """T5: rows within 7 days of ref_ts go to the real-time sink, older to the batch sink."""
    s = _stream(spark, sf_dir, per_trigger=4)
    recent, old = scratch_path(spark, "realtime"), scratch_path(spark, "batch")
    PS.run_available_now(s, "append", PS.split_recent_writer("ts", REF_TS, 7, recent, old),
                         scratch_path(spark, "split-ckpt"))
    parts = []
    for label, path in (("realtime", recent), ("batch", old)):
        parts.append(spark.read.parquet(path).select(F.lit(label).alias("sink"), "ts"))
    both = parts[0].unionByName(parts[1])
    return both.groupBy("sink", F.date_trunc("day", "ts").cast("timestamp").alias("day")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


@register("stream_merge", sql=profile_sql("events", kinds("events")))
def stream_merge(spark, sf_dir):
    """Each micro-batch profiled and flushed to shared storage, then merged."""
    s = _stream(spark, sf_dir, per_trigger=2)
    out = scratch_path(spark, "batch-profiles")
    PS.run_available_now(s, "append", PS.batch_profiles_writer("events", out),
                         scratch_path(spark, "merge-ckpt"))
    stored = spark.read.parquet(out)
    return exact_view(merge_profiles(stored.drop("batch_id"), by=("name", "column")))


# Limits measured on the table: values reach far beyond 100, event types are words.
EVENT_CHECKS = {"valueConstraints": {
    "value": {"constraints": [{"name": "not negative", "op": "GE", "value": 0.0}, {"name": "small", "op": "LT", "value": 100.0}]},
    "event_type": {"constraints": [{"name": "no clicks", "op": "NE", "value": "click"}, {"name": "a number", "op": "GE", "value": 0.0}]},
    "colour": {"constraints": [{"name": "not there", "op": "GE", "value": 0.0}]}}}


def _event_check_sql(name, column, op, total, failures, unknown="0"):
    return f"""SELECT '{name}' AS name, '{column}' AS "column", '{op}' AS op, CAST({FILES} AS BIGINT) AS batches, count(*) AS rows,
  CAST({total} AS BIGINT) AS total, CAST({failures} AS BIGINT) AS failures, CAST({unknown} AS BIGINT) AS not_comparable,
  {total} > 0 AND {failures} = 0 AS passed FROM events"""


@register("stream_constraints", sql=" UNION ALL ".join([
    _event_check_sql("not negative", "value", "GE", "count(value)", "count(*) FILTER (WHERE NOT value >= 0)"),
    _event_check_sql("small", "value", "LT", "count(value)", "count(*) FILTER (WHERE NOT value < 100)"),
    _event_check_sql("no clicks", "event_type", "NE", "count(event_type)", "count(*) FILTER (WHERE NOT event_type <> 'click')"),
    _event_check_sql("a number", "event_type", "GE", "count(TRY_CAST(event_type AS DOUBLE))", "count(*) FILTER (WHERE NOT TRY_CAST(event_type AS DOUBLE) >= 0)",
                     "count(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS DOUBLE) IS NULL)"),
    _event_check_sql("not there", "colour", "GE", "0", "0")]))
def stream_constraints(spark, sf_dir):
    """C1 / C7 on a stream: each micro-batch is checked by its own write; the report table, replayed once, over all batches."""
    stream = _stream(spark, sf_dir, per_trigger=1)
    out, report = scratch_path(spark, "checked"), scratch_path(spark, "check-report")
    write = CS.checked_sink_writer(parse_constraints(EVENT_CHECKS), out, report)
    for _ in range(2):      # the second run replays every batch under the same ids
        PS.run_available_now(stream, "append", write, scratch_path(spark, "check-ckpt"))
    return CS.merge_reports(spark.read.parquet(report)).drop("failed_batches", "value", "text")
