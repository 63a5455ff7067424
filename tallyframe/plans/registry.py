"""Registry of named queries and their SQL twins.

Each query is a function ``(spark, sf_dir) -> DataFrame`` over the driver
tables; its twin is ANSI SQL over the same tables (DuckDB dialect) that
returns the same columns.  Queries whose result is a sketch estimate or a
model output register no twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Results are compared as naive UTC wall-clock values.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            # Sketch aggregates run in ObjectHashAggregate: keep hashing past
            # 128 keys per task before falling back to sort-based aggregation.
            spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


def load_all() -> None:
    """Import every plan module so that its queries register."""
    from tallyframe.plans import (  # noqa: F401
        constraint_plans,
        drift_plans,
        feature_plans,
        io_plans,
        profile_plans,
        scoring_plans,
        series_plans,
        shape_plans,
        sketch_plans,
        stream_plans,
    )
