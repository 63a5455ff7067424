"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

import tallyframe
from tallyframe.session import scratch_path


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if they have no path of their own."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(tallyframe.__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage: later jobs, and tasks that run again after an executor is
    lost, read files that every executor can see.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
