"""Profile writers: full profiles, flat summaries, templated paths.

A writer configuration mirrors the examples' YAML: several writers, each
with formats and a path / file-name template using ``$name`` and
``$dataset_timestamp``.  Profiles are written once per format from a
single persisted DataFrame (fan-out without recomputation).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.summary import flat_summary

# Template variables and flat file names of the examples.
TEMPLATE_VARS = ("$name", "$dataset_timestamp")
FLAT_FILES = {"summary": "summary_summary.csv", "hist": "summary_histogram.json",
              "frequent_strings": "summary_strings.json"}


def expand(template: str, name: str, dataset_timestamp: str = "") -> str:
    return template.replace("$name", name).replace("$dataset_timestamp", dataset_timestamp)


@dataclass
class WriterConfig:
    output_path: str
    formats: list[str] = field(default_factory=lambda: ["parquet"])
    path_template: str = "$name"
    filename_template: str = "dataset_profile"


def write_profile(profiles: DataFrame, path: str, mode: str = "overwrite",
                  partition_by=("name",)) -> None:
    """Full profile table as parquet, partitioned (dynamic overwrite keeps other partitions).

    ``name`` also stays inside the files (its folder key is ``profile_name``), so
    that a recursive read of many stores keeps it.
    """
    out = profiles.withColumn("profile_name", F.col("name")) if "name" in partition_by else profiles
    keys = ["profile_name" if c == "name" else c for c in partition_by]
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_flat(profiles: DataFrame, folder: str) -> dict[str, str]:
    """Summary as CSV, histograms and frequent strings as JSON lines, all with name, timestamp and tags."""
    from tallyframe.sources.files import flat_schema
    flat = flat_summary(profiles)
    out = {}
    s = flat["summary"]
    for c in ("session_id", "most_common"):
        if c not in s.columns:
            s = s.withColumn(c, F.lit(None).cast("string"))
    s = s.withColumn("tags", F.to_json("tags"))
    if dict(s.dtypes)["most_common"] != "string":
        s = s.withColumn("most_common", F.to_json("most_common"))
    p = os.path.join(folder, FLAT_FILES["summary"])
    s.select(*flat_schema().fieldNames()).write.mode("overwrite").option("header", True).option("escape", '"').csv(p)
    out["summary"] = p
    for key in ("hist", "frequent_strings"):
        p = os.path.join(folder, FLAT_FILES[key])
        flat[key].write.mode("overwrite").json(p)
        out[key] = p
    return out


def write_all(profiles: DataFrame, writers: list[WriterConfig], name: str,
              dataset_timestamp: str = "") -> list[str]:
    """Every writer and format from one persisted profile DataFrame."""
    profiles = profiles.persist(StorageLevel.MEMORY_AND_DISK)
    written = []
    try:
        for w in writers:
            base = os.path.join(w.output_path, expand(w.path_template, name, dataset_timestamp))
            for fmt in w.formats:
                target = os.path.join(base, fmt, expand(w.filename_template, name,
                                                        dataset_timestamp))
                if fmt == "flat":
                    write_flat(profiles, target)
                elif fmt == "json":
                    profiles.drop("kll", "theta", "topk").write.mode("overwrite").json(target)
                elif fmt == "parquet":
                    profiles.write.mode("overwrite").parquet(target)
                else:
                    raise ValueError(f"unknown format {fmt!r}; expected parquet, json or flat")
                written.append(target)
    finally:
        profiles.unpersist()
    return written


def write_by_bucket(profiles: DataFrame, path: str, bucket: str = "year") -> None:
    """One output per time bucket (any grain of ``date_trunc``); a rewrite replaces only its own bucket.

    Years are folder values as numbers, other grains as the bucket's first day.
    """
    ts = F.col("dataset_timestamp")
    value = F.year(ts) if bucket == "year" else F.date_format(F.date_trunc(bucket, ts), "yyyy-MM-dd'T'HH-mm-ss") \
        if bucket in ("hour", "minute", "second") else F.date_format(F.date_trunc(bucket, ts), "yyyy-MM-dd")
    profiles.withColumn(bucket, value).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(bucket).parquet(path)
