"""A run table: logged runs of experiments and the profiles of their batches, as two parquet tables.

Both are partitioned by experiment and run id and written by dynamic partition overwrite, so
logging a run again replaces exactly that run.  Profiles go first and runs last: a run is
seen only when its profiles are there, and profiles without a run (a failed attempt) are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("experiment", "run_id")


class RunTable:
    """Runs under ``path``, any folder that Spark's file systems reach."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def log(self, runs: DataFrame, profiles: DataFrame) -> None:
        """Append runs (``KEYS`` and any other columns) and profile rows that carry the same keys.

        Keys must be texts without nulls.  A run that is logged again replaces its former rows; one without profile rows keeps the
        profiles it has.
        """
        for rows, name in ((profiles, "profiles"), (runs, "runs")):
            # one file a run from each task that holds it; rows of one run lie together
            (rows.repartition(*KEYS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*KEYS).parquet(f"{self.path}/{name}"))

    def _read(self, spark: SparkSession, name: str, experiment: str | None) -> DataFrame:
        rows = spark.read.option("mergeSchema", True).parquet(f"{self.path}/{name}")
        rows = rows.withColumns({k: F.col(k).cast("string") for k in KEYS})   # partition values may look like numbers
        return rows.filter(F.col("experiment") == experiment) if experiment is not None else rows

    def runs(self, spark: SparkSession, experiment: str | None = None) -> DataFrame:
        """Logged runs; an experiment prunes the scan to its folders."""
        return self._read(spark, "runs", experiment)

    def profiles(self, spark: SparkSession, experiment: str | None = None) -> DataFrame:
        """Profile rows of logged runs."""
        return self._read(spark, "profiles", experiment).join(self.runs(spark, experiment).select(*KEYS), list(KEYS), "left_semi")
