"""Constraints on streams: every micro-batch is checked by the action that writes it.

The counts are observed metrics of the batch's own write (no extra pass over the rows).
Each batch id adds one small folder to a report table, overwritten when the
batch is replayed, so the report neither loses nor repeats a batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.constraints import Constraint, observe_checks

BATCH_REPORT = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("column", T.StringType()), T.StructField("op", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("text", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("total", T.LongType()), T.StructField("failures", T.LongType()), T.StructField("not_comparable", T.LongType()),
])


def checked_sink_writer(constraints: list[Constraint], path: str, report_path: str, keys=()):
    """foreachBatch writer: the batch's rows to ``path``, the value checks of those rows to ``report_path``.

    Both are folders by batch id.  Reports have one row per value constraint (its limit in ``value`` or
    ``text``); constraints of other kinds are ignored here.  ``keys`` names columns to keep (all without it).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        checked, read = observe_checks(batch, constraints, f"constraints-{batch_id}")
        (checked.select(*keys) if keys else checked).write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))
        batch.sparkSession.createDataFrame(read(), BATCH_REPORT).coalesce(1).write.mode("overwrite").parquet(
            os.path.join(report_path, f"batch_id={batch_id}"))
    return write


def with_verdict(report: DataFrame) -> DataFrame:
    """Adds ``passed`` to report rows: some value checked and none failed; null for a batch without rows."""
    return report.withColumn("passed", F.when(F.col("rows") > 0, (F.col("total") > 0) & (F.col("failures") == 0)))


def merge_reports(report: DataFrame) -> DataFrame:
    """One row per constraint over all its batches, with the number of batches and of those that failed.

    A batch without values of the column fails nothing here as long as another batch has some.
    """
    rows = report.groupBy("name", "column", "op", "value", "text").agg(
        F.count(F.lit(1)).alias("batches"), F.count_if(F.col("failures") > 0).alias("failed_batches"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("rows", "total", "failures", "not_comparable")])
    return with_verdict(rows)
