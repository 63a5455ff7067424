"""Kafka codec: rows <-> JSON message values.

The read and write themselves are Spark's ``kafka`` source and sink
(``readStream.format("kafka")`` with ``assign`` + ``startingOffsets``;
``write.format("kafka")``); the connector jar is not installed here, so
only the codec below is exercised by the tests and queries.  The decoder
works on any DataFrame with Kafka's columns (topic, partition, offset,
key, value).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Full microsecond precision for timestamps (Spark's JSON default keeps millis).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as Kafka records: ``value`` = JSON object of the row, ``key`` optional."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def decode(records: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Parse JSON values with a declared schema; keep topic/partition/offset."""
    meta = [c for c in ("topic", "partition", "offset") if c in records.columns]
    parsed = F.from_json(F.col("value").cast("string"), schema, JSON_OPTIONS)
    return records.select(*meta, parsed.alias("r")).select(*meta, "r.*")


def poll_counts(records: DataFrame) -> DataFrame:
    """Records per (topic, partition) and the poll total."""
    from pyspark.sql.window import Window
    per = records.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("records"))
    # One row per topic partition: a small window.
    return per.withColumn("total", F.sum("records").over(Window.partitionBy(F.lit(0))))


def read_stream(spark: SparkSession, servers: str, topic: str, partitions=None,
                max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka stream from the beginning; explicit partition assignment when given."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("startingOffsets", "earliest")
    if partitions is not None:
        r = r.option("assign", json.dumps({topic: list(partitions)}))
    else:
        r = r.option("subscribe", topic)
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load()


def write(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    encode(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("topic", topic).save()
