"""Feature transform queries (F2-F5) on the embeddings table (array twin of pixels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import features as X
from tallyframe.plans.registry import register
from tallyframe.sources.tables import table


@register("feature_avg", sql="""
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) / len(embedding), 5)
  + CAST(0 AS DOUBLE) AS "AvgValue"
FROM embeddings""")
def feature_avg(spark, sf_dir):
    """AvgValue, the mean over all values of each item."""
    e = table(spark, sf_dir, "embeddings")
    out = X.apply_features(e, "embedding", [X.AvgValue], keep=["vec_id"])
    # "+ 0.0" turns a rounded -0.0 into 0.0 (same in the SQL twin).
    return out.withColumn("AvgValue", F.round("AvgValue", 5) + F.lit(0.0))


@register("feature_channel", sql="""
SELECT vec_id, list_slice(embedding, 1, len(embedding), 3) AS "MyBlue" FROM embeddings""")
def feature_channel(spark, sf_dir):
    """MyBlue, the values of channel 0 of interleaved triples."""
    e = table(spark, sf_dir, "embeddings")
    return X.apply_features(e, "embedding", [X.MyBlue], keep=["vec_id"])


@register("feature_compose", sql="""
SELECT vec_id, label, round(list_sum(list_transform(list_slice(embedding, 1, len(embedding), 3),
  lambda x: CAST(x AS DOUBLE))) / len(list_slice(embedding, 1, len(embedding), 3)), 5)
  + CAST(0 AS DOUBLE) AS "AvgValue"
FROM embeddings""")
def feature_compose(spark, sf_dir):
    """transforms composed in order: AvgValue(MyBlue(x))."""
    e = table(spark, sf_dir, "embeddings")
    out = X.apply_features(e, "embedding", [X.compose(X.MyBlue, X.AvgValue)],
                           keep=["vec_id", "label"])
    # "+ 0.0" turns a rounded -0.0 into 0.0 (same in the SQL twin).
    return out.withColumn("AvgValue", F.round("AvgValue", 5) + F.lit(0.0))


# Images of WIDTH x HEIGHT three-channel pixels whose bytes come from the first components of an embedding.
WIDTH, HEIGHT = 7, 3
N_BYTES = WIDTH * HEIGHT * 3


def _images(spark, sf_dir):
    """Rows of the image source's schema, tagged with the embedding's label."""
    e = table(spark, sf_dir, "embeddings")
    byte = F.transform(F.slice("embedding", 1, N_BYTES), lambda x: F.lpad(F.hex(F.floor(F.abs(x.cast("double")) * 1000) % 256), 2, "0"))
    image = F.struct(F.concat(F.lit("vec:"), F.col("vec_id").cast("string")).alias("origin"), F.lit(HEIGHT).alias("height"), F.lit(WIDTH).alias("width"),
                     F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), F.unhex(F.array_join(byte, "")).alias("data"))
    return e.select(F.col("label").cast("string").alias("label"), image.alias("image"))


_IMAGE_CELLS = f"""
px AS (SELECT label, vec_id, list_transform(list_slice(embedding, 1, {N_BYTES}), lambda x: CAST(floor(abs(CAST(x AS DOUBLE)) * 1000) AS BIGINT) % 256) AS b FROM embeddings),
p AS (SELECT label, vec_id, b[3 * i + 1] AS blue, b[3 * i + 2] AS green, b[3 * i + 3] AS red FROM px, range({WIDTH * HEIGHT}) r(i)),
v AS (SELECT label, 'brightness' AS "column", CAST(greatest(blue, green, red) AS DOUBLE) AS x FROM p
  UNION ALL SELECT label, 'saturation', CAST((greatest(blue, green, red) - least(blue, green, red)) * 255 // greatest(greatest(blue, green, red), 1) AS DOUBLE) FROM p
  UNION ALL SELECT label, 'MyBlue', CAST(blue AS DOUBLE) FROM p
  UNION ALL SELECT label, 'BlueSum', CAST(sum(blue) AS DOUBLE) FROM p GROUP BY label, vec_id
  UNION ALL SELECT label, 'width', {WIDTH} FROM embeddings UNION ALL SELECT label, 'height', {HEIGHT} FROM embeddings
  UNION ALL SELECT label, 'channels', 3 FROM embeddings UNION ALL SELECT label, 'pixels', {WIDTH * HEIGHT} FROM embeddings)"""


def _blue(px):
    return px[:, :, :1]


def _sum(px):
    return px.sum(keepdims=True, dtype="int64")


@register("profile_images", sql=f"""WITH {_IMAGE_CELLS}
SELECT 'label=' || label AS segment, "column", CAST(count(*) AS BIGINT) AS "count", CAST(count(x) AS BIGINT) AS n, min(x) AS min, max(x) AS max,
  round(sum(x), 2) AS total, round(stddev_samp(x), 4) AS stddev, CAST(count(DISTINCT x) AS BIGINT) AS distinct_values FROM v GROUP BY 1, 2""")
def profile_images(spark, sf_dir):
    """F1 / F2: image features (two built in, two user transforms, one of them a chain) and metadata as profile rows by label.

    Profiled in two halves and merged.
    """
    from tallyframe.functions import images as I
    from tallyframe.operators.merge import merge_profiles
    from tallyframe.operators.profile import segment_label
    from tallyframe.operators.summary import stddev_col
    features = {**{f: I.IMAGE_FEATURES[f] for f in ("saturation", "brightness")}, "MyBlue": _blue, "BlueSum": I.chain(_blue, _sum)}
    rows = _images(spark, sf_dir)
    half = F.pmod(F.xxhash64("image.origin"), F.lit(2))
    p = merge_profiles(I.profile_images(rows.filter(half == 0), features=features, tags=["label"]).unionByName(
        I.profile_images(rows.filter(half == 1), features=features, tags=["label"])))
    return p.select(segment_label().alias("segment"), "column", "count", "n", "min", "max", F.round(F.col("mean") * F.col("n"), 2).alias("total"),
                    F.round(stddev_col(), 4).alias("stddev"), F.expr("theta_sketch_estimate(theta)").cast("bigint").alias("distinct_values"))
