"""Kafka codec queries (S8, K8, A19) on rows built from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.plans.registry import register
from tallyframe.sources import kafka
from tallyframe.sources.tables import table

TOPIC = "events-stream"
PARTS = 4


def _records(spark, sf_dir):
    """events as Kafka records: partition = event_id mod 4, offset = event_id div 4."""
    e = table(spark, sf_dir, "events")
    cols = [F.lit(TOPIC).alias("topic"),
            F.pmod("event_id", F.lit(PARTS)).cast("int").alias("partition"),
            F.floor(F.col("event_id") / PARTS).cast("bigint").alias("offset"),
            F.col("event_id").cast("string").alias("key"),
            F.to_json(F.struct(*[F.col(c) for c in e.columns]), kafka.JSON_OPTIONS).alias("value")]
    return e.select(*cols), e.schema


@register("kafka_decode", sql=f"""
SELECT '{TOPIC}' AS topic, CAST(event_id % {PARTS} AS INTEGER) AS "partition", CAST(event_id // {PARTS} AS BIGINT) AS "offset",
  event_id, ts, user_id, event_type, value, props FROM events""")
def kafka_decode(spark, sf_dir):
    """JSON message values decoded with a declared schema."""
    records, schema = _records(spark, sf_dir)
    return kafka.decode(records, schema)


@register("kafka_encode", sql="""
SELECT CAST(event_id AS VARCHAR) AS "key", event_type, user_id, value, props FROM events""")
def kafka_encode(spark, sf_dir):
    """K8: rows encoded as JSON values; fields read back from the text."""
    enc = kafka.encode(table(spark, sf_dir, "events"), key="event_id")
    v = F.col("value")
    return enc.select("key",
                      F.get_json_object(v, "$.event_type").alias("event_type"),
                      F.get_json_object(v, "$.user_id").cast("bigint").alias("user_id"),
                      F.get_json_object(v, "$.value").cast("double").alias("value"),
                      F.get_json_object(v, "$.props").alias("props"))


@register("poll_counts", sql=f"""
SELECT '{TOPIC}' AS topic, CAST(event_id % {PARTS} AS INTEGER) AS "partition", count(*) AS records,
  CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM events GROUP BY 2""")
def poll_counts(spark, sf_dir):
    """Records per topic partition and the total."""
    records, _ = _records(spark, sf_dir)
    return kafka.poll_counts(records).withColumn("total", F.col("total").cast("bigint"))


@register("csv_roundtrip", sql="""
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS customers,
  CAST(count(nullif(o_orderpriority, '1-URGENT')) AS BIGINT) AS not_urgent FROM orders GROUP BY o_orderstatus""")
def csv_roundtrip(spark, sf_dir):
    """Orders written as a ``;`` separated CSV, read with header, types and a null marker."""
    from pyspark.sql import functions as F
    from tallyframe.session import scratch_path
    from tallyframe.sources import files
    path = scratch_path(spark, "orders-csv")
    table(spark, sf_dir, "orders").write.option("header", True).option("sep", ";").csv(path)
    back = files.read_csv(spark, path, sep=";", null_value="1-URGENT")
    return back.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum("o_custkey").cast("bigint").alias("customers"),
        F.count("o_orderpriority").alias("not_urgent"))


def _yearly(spark, sf_dir):
    from tallyframe.operators.profile import ProfileOptions, profile
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderstatus", "o_totalprice")
    return profile(o, "orders", time_column="o_orderdate", grain="year", tags=["o_orderstatus"],
                   options=ProfileOptions(top_k_items=32))


_YEARLY_SQL = """
SELECT {cols} o_orderstatus AS status, count(*) AS "count", min(o_totalprice) AS min, max(o_totalprice) AS max
FROM orders GROUP BY ALL"""


@register("flat_roundtrip", sql=_YEARLY_SQL.format(cols="'orders' AS name, CAST(year(o_orderdate) AS INTEGER) AS year,"))
def flat_roundtrip(spark, sf_dir):
    """The flat summary CSV keeps name, time and tags; written, then read back."""
    from pyspark.sql import functions as F
    from tallyframe.session import scratch_path
    from tallyframe.sources import files, writers
    out = writers.write_flat(_yearly(spark, sf_dir), scratch_path(spark, "flat"))
    return files.read_flat_summary(spark, out["summary"]).select(
        "name", F.year("dataset_timestamp").alias("year"), F.get_json_object("tags", "$[0].value").alias("status"),
        "count", "min", "max")


@register("write_buckets", sql=_YEARLY_SQL.format(cols="CAST(date_trunc('month', o_orderdate) AS VARCHAR)[1:10] AS month,"))
def write_buckets(spark, sf_dir):
    """One output per month, read back with its folder key."""
    from pyspark.sql import functions as F
    from tallyframe.operators.profile import ProfileOptions, profile
    from tallyframe.session import scratch_path
    from tallyframe.sources import writers
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderstatus", "o_totalprice")
    p = profile(o, "orders", time_column="o_orderdate", grain="month", tags=["o_orderstatus"],
                options=ProfileOptions(sketches=False))
    path = scratch_path(spark, "buckets")
    writers.write_by_bucket(p, path, "month")
    return spark.read.parquet(path).select(F.col("month").cast("string").alias("month"),
                                           F.col("tags")[0]["value"].alias("status"), "count", "min", "max")


@register("profile_recursive", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS status, count(*) AS "count" FROM orders GROUP BY ALL""")
def profile_recursive(spark, sf_dir):
    """Every profile of one dataset name below a folder of several stores."""
    from pyspark.sql import functions as F
    from tallyframe.operators.profile import ProfileOptions, profile
    from tallyframe.session import scratch_path
    from tallyframe.sources import files, writers
    root = scratch_path(spark, "stores")
    writers.write_profile(_yearly(spark, sf_dir), f"{root}/orders")
    nation = profile(table(spark, sf_dir, "nation"), "nation", options=ProfileOptions(sketches=False))
    writers.write_profile(nation, f"{root}/nation")
    return files.read_profiles(spark, root, name="orders", recursive=True).select(
        F.year("dataset_timestamp").alias("year"), F.col("tags")[0]["value"].alias("status"), "count")
