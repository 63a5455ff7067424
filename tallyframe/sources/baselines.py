"""Named reference profiles (baselines) kept as an append-only parquet table.

A baseline is a profile registered under an alias with the dataset
timestamp in epoch milliseconds; drift and constraint checks look it up
by alias.  The table lives in the shared folder (``spark.checkpoint.dir``)
unless a path is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import scratch_path


def new_table(spark: SparkSession) -> str:
    return scratch_path(spark, "baselines")


def register(profile_rows: DataFrame, alias: str, dataset_epoch_ms: int, path: str) -> None:
    (profile_rows.select(F.lit(alias).alias("alias"),
                         F.lit(dataset_epoch_ms).cast("bigint").alias("dataset_epoch_ms"), "*")
     .write.mode("append").partitionBy("alias").parquet(path))


def lookup(spark: SparkSession, path: str, alias: str) -> DataFrame:
    """Profile rows of one alias (partition pruning on ``alias``); latest registration wins."""
    rows = spark.read.parquet(path).filter(F.col("alias") == alias)
    latest = rows.agg(F.max("dataset_epoch_ms").alias("m"))
    return rows.join(latest, rows["dataset_epoch_ms"] == latest["m"]).drop("m") \
        .select("alias", "dataset_epoch_ms", *[c for c in rows.columns
                                               if c not in ("alias", "dataset_epoch_ms")])
