"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours wants; a cluster's own spark-defaults win
# because ``getOrCreate`` keeps an existing session untouched.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sketch aggregates run in ObjectHashAggregate; the default fallback to
    # sort-based aggregation after 128 keys per task is too eager for
    # profiles grouped by (time, tags).
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def get_session(master: str | None = None, app: str = "tallyframe",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    active = SparkSession.getActiveSession()
    known = dict(active.sparkContext.getConf().getAll()) if active else {}
    for k, v in conf.items():
        if k not in known or k in (extra or {}):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the
    cluster (a shared file system path); without it a cluster run fails
    here, since executors cannot read each other's local folders.  Only a
    local master, where all tasks share one machine, gets a folder of ours.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tallyframe-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")
