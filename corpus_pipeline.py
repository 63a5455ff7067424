"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Order: quality classifier (rejected documents go), SimHash near-duplicates (one
of each group stays), benchmark decontamination, personal-data surrogates,
packing.  All stages but the last return the columns of their input.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, packing, pii, quality, simhash
from tallyframe.llm.common import materialise, read_table, share_package
from tallyframe.llm.queries import tokenizer_paths


USED = ("doc_id", "text", "n_chars")


def keeping_columns(stage):
    """Stage over (doc_id, text, n_chars) whose other columns, whatever their names, come back untouched."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        safe = [c if c in USED else f"other_{i}_column" for i, c in enumerate(names)]
        return stage(spark, docs.toDF(*safe), sf_dir).select(*safe).toDF(*names)
    return run


@keeping_columns
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; its labels are joined by doc_id to fit it."""
    share_package(spark)
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model).where("predicted = 1").select(*docs.columns)


@keeping_columns
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each SimHash component."""
    share_package(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=3)


@keeping_columns
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage.  Decisions follow the text, so rows need no unique doc_id."""
    share_package(spark)
    key = F.xxhash64("text")
    leaks = decontaminate.find_leaks(docs.select(key.alias("k"), "text"), read_table(spark, sf_dir, "benchmark"), id_col="k")
    leaks = materialise(leaks.select("k").distinct(), "leaks")
    return docs.withColumn("_leak", key).join(leaks, F.col("_leak") == F.col("k"), "left_anti").select(*docs.columns)


@keeping_columns
def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; n_chars follows where the text changed its length."""
    out = pii.replace_personal_data(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences in Hilbert order."""
    share_package(spark)
    return packing.pack(docs, tokenizer_paths())


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: No stage but the joins between them can be stated in SQL; tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
