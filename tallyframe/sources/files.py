"""File sources: CSV variants, batch folders, stored profiles and flat summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, *, header: bool = True, infer: bool = True,
             sep: str = ",", null_value: str | None = None, schema=None,
             date_format: str | None = None, names=None) -> DataFrame:
    """CSV with the options the examples use.

    * header + inferred types (``inferSchema``) or all strings (``infer=False``);
    * custom separator (``sep=';'``); empty string as null (``null_value=''``);
    * explicit schema with ``DateType`` columns and ``date_format``;
    * headerless files: ``header=False`` + ``names`` (no first row is lost).
    At scale prefer an explicit schema: inference reads the data twice.
    """
    r = spark.read.option("header", header).option("sep", sep)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if date_format:
        r = r.option("dateFormat", date_format)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    if names:
        df = df.toDF(*names)
    return df


def read_batches(spark: SparkSession, path_glob: str, pattern: str = r"_(\d+)\.csv$",
                 **kw) -> DataFrame:
    """Many batch files in one scan; the batch number comes from the file name."""
    df = read_csv(spark, path_glob, **kw)
    return df.withColumn("batch", F.regexp_extract(F.col("_metadata.file_name"), pattern, 1)
                         .cast("int"))


def read_profiles(spark: SparkSession, path: str, name: str | None = None,
                  recursive: bool = False) -> DataFrame:
    """Stored profile rows; ``name`` filters (partition pruning without ``recursive``).

    ``recursive`` reads every profile file below ``path``, whatever the folders.
    """
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", True)
    df = r.parquet(path)
    if name and "profile_name" in df.columns:
        df = df.filter(F.col("profile_name") == name)
    df = df.drop("profile_name")
    return df.filter(F.col("name") == name) if name else df


def latest(profiles: DataFrame, by=("name", "column"), order: str = "dataset_timestamp") -> DataFrame:
    """Most recent stored profile row per ``by`` (``max_by`` on the timestamp)."""
    fields = [c for c in profiles.columns if c not in by]
    return profiles.groupBy(*by).agg(F.max_by(F.struct(*fields), order).alias("p")) \
        .select(*by, "p.*")


def flat_schema() -> T.StructType:
    """Column types of the flat summary CSV that ``writers.write_flat`` writes."""
    from tallyframe.operators.summary import SUMMARY_QUANTILES
    text = ("name", "session_id", "tags", "column", "inferred_dtype", "min_value", "max_value", "most_common")
    counts = ("count", "null_count", "type_null_count", "type_integral_count", "type_fractional_count",
              "type_boolean_count", "type_string_count", "type_unknown_count", "nunique_str")
    order = ["name", "session_id", "dataset_timestamp", "tags", "column", *counts[:8], "inferred_dtype",
             "dtype_fraction", "min", "max", "min_value", "max_value", "mean", "stddev", "nunique_str", "nunique_str_lower",
             "nunique_str_upper", *[f"quantile_{q:g}".replace(".", "_") for q in SUMMARY_QUANTILES], "most_common"]
    kind = lambda c: (T.StringType() if c in text else T.LongType() if c in counts
                      else T.TimestampType() if c == "dataset_timestamp" else T.DoubleType())
    return T.StructType([T.StructField(c, kind(c)) for c in order])


def read_flat_summary(spark: SparkSession, path: str) -> DataFrame:
    """Every summary column, with name, timestamp and tags (as JSON text)."""
    return spark.read.option("header", True).option("escape", '"').schema(flat_schema()).csv(path)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Spark's image source: struct<origin, height, width, nChannels, mode, data> (BGR bytes).

    Files that cannot be decoded are left out; ``invalid_images`` lists them.
    """
    return spark.read.format("image").option("dropInvalid", True).load(path)


def invalid_images(spark: SparkSession, path: str) -> DataFrame:
    """(origin) of the files that ``read_images`` leaves out."""
    every = spark.read.format("image").option("dropInvalid", False).load(path)
    return every.filter(F.col("image.height") < 0).select("image.origin")
