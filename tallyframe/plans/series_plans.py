"""Time-series views (V1-V4, V6) over daily / hourly profiles of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import series as V
from tallyframe.operators.profile import ProfileOptions, profile
from tallyframe.plans.registry import register
from tallyframe.plans.sqlgen import kinds, profile_sql
from tallyframe.sources.tables import table

EXACT = ProfileOptions(sketches=False)
Q_SQL = ", ".join(f"round(quantile_cont(value, {q}), 6) AS {n}"
                  for q, n in zip(V.SERIES_QUANTILES, V.quantile_names()))


def _ts(c="dataset_timestamp"):
    return F.col(c).cast("timestamp").alias("dataset_timestamp")


@register("series_distribution", sql=f"""
SELECT date_trunc('day', ts) AS dataset_timestamp, 'value' AS "column", {Q_SQL}
FROM events GROUP BY 1""")
def series_distribution(spark, sf_dir):
    """V1: distribution over time (exact twin of the KLL quantile view)."""
    e = table(spark, sf_dir, "events")
    d = V.distribution_exact(e, time_expr=F.date_trunc("day", "ts"), column="value")
    names = V.quantile_names()
    return d.select(_ts(), "column", *[F.round(n, 6).alias(n) for n in names])


@register("series_types", sql=f"""
SELECT dataset_timestamp, "column", type_integral, type_fractional, type_boolean, type_string,
  type_unknown, null_count AS type_null FROM (
{profile_sql("events", kinds("events", exclude=("ts",)), keys=[("date_trunc('day', ts)", "dataset_timestamp")])}) p""")
def series_types(spark, sf_dir):
    """V2: type counts over time."""
    e = table(spark, sf_dir, "events")
    p = profile(e, "events", time_column="ts", grain="day", options=EXACT)
    return V.types(p).withColumn("dataset_timestamp", _ts())


@register("series_unique", sql="""
SELECT date_trunc('day', ts) AS dataset_timestamp, c AS "column", CAST(count(DISTINCT v) AS BIGINT) AS unique_count,
  round(count(DISTINCT v) / count(*), 9) AS unique_ratio
FROM (SELECT ts, 'user_id' AS c, CAST(user_id AS VARCHAR) AS v FROM events
      UNION ALL SELECT ts, 'event_type', event_type FROM events
      UNION ALL SELECT ts, 'value', CAST(value AS VARCHAR) FROM events) GROUP BY 1, 2""")
def series_unique(spark, sf_dir):
    """V3: uniqueness over time from the theta sketches (exact below 4096 values)."""
    e = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    p = profile(e, "events", time_column="ts", grain="day")
    return V.uniqueness(p).select(_ts(), "column", "unique_count",
                                  F.round("unique_ratio", 9).alias("unique_ratio"))


@register("series_missing", sql="""
SELECT date_trunc('day', ts) AS dataset_timestamp, c AS "column", CAST(count_if(v IS NULL) AS BIGINT) AS null_count,
  CAST(count(*) AS BIGINT) AS "count", round(count_if(v IS NULL) / count(*), 9) AS missing_ratio
FROM (SELECT ts, 'event_type' AS c, nullif(event_type, 'error') AS v FROM events
      UNION ALL SELECT ts, 'props', CASE WHEN user_id > 140 THEN NULL ELSE props END FROM events) GROUP BY 1, 2""")
def series_missing(spark, sf_dir):
    """V4: missing values over time (nulls made with stated predicates)."""
    e = table(spark, sf_dir, "events").select(
        "ts", F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("user_id") <= 140, F.col("props")).alias("props"))
    p = profile(e, "events", time_column="ts", grain="day", options=EXACT)
    return V.missing(p).select(_ts(), "column", "null_count", "count",
                               F.round("missing_ratio", 9).alias("missing_ratio"))


@register("series_labels", sql="""
SELECT DISTINCT date_trunc('hour', ts) AS dataset_timestamp,
  strftime(date_trunc('hour', ts), '%H:%M:%S') AS label FROM events""")
def series_labels(spark, sf_dir):
    """V6: timestamp labels in HH:mm:ss for hourly profiles."""
    e = table(spark, sf_dir, "events").select("ts", "value")
    p = profile(e, "events", time_column="ts", grain="hour", options=EXACT)
    return V.labels(p).select(_ts(), "label")
