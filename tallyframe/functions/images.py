"""Image features (default image profile): pixel saturation and brightness.

Spark's image source decodes files on the executors (bytes in BGR order).
One Arrow-batched pandas UDF turns each image into 256-cell counts per
feature; the counts are summed in Spark, which gives an exact, mergeable
histogram over any number of images.  HSV formulas (own choice):
brightness V = max(R, G, B), saturation S = (V - min) / V scaled to 0-255.

``profile_images`` turns features into ordinary profile rows: one Arrow pass computes all
features of an image and hands their values on in slices of bounded size, one
column per feature, to the profile's own partial aggregation.  So image
profiles merge, and are read by summaries, drift and series, like any other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.profile import profile, quote

CELLS = 256
SLICE = 1 << 16        # values of a feature handed to Spark at once
IMAGES_PER_BATCH = 16  # images unpacked at once


def _hsv_counts(data: bytes, n_channels: int) -> tuple[list[int], list[int]]:
    px = np.frombuffer(data, dtype=np.uint8)
    if n_channels < 3:
        v = px.astype(np.int64)
        s = np.zeros_like(v)
    else:
        px = px.reshape(-1, n_channels)[:, :3].astype(np.int64)   # B, G, R
        v = px.max(axis=1)
        mn = px.min(axis=1)
        s = np.where(v > 0, ((v - mn) * 255) // np.maximum(v, 1), 0)
    return (np.bincount(s, minlength=CELLS).tolist(), np.bincount(v, minlength=CELLS).tolist())


@F.pandas_udf(T.StructType([T.StructField("saturation", T.ArrayType(T.LongType())),
                            T.StructField("brightness", T.ArrayType(T.LongType()))]))
def hsv_histograms(data: pd.Series, n_channels: pd.Series) -> pd.DataFrame:
    sat, bri = [], []
    for d, c in zip(data, n_channels):
        s, v = _hsv_counts(bytes(d), int(c))
        sat.append(s)
        bri.append(v)
    return pd.DataFrame({"saturation": sat, "brightness": bri})


def image_metadata(images: DataFrame) -> DataFrame:
    """Per-image width, height, channels and pixel count."""
    i = F.col("image")
    return images.select(i["origin"].alias("origin"), i["width"].alias("width"),
                         i["height"].alias("height"), i["nChannels"].alias("channels"),
                         (i["width"] * i["height"]).cast("bigint").alias("pixels"))


def image_histograms(images: DataFrame) -> DataFrame:
    """(feature, value, count) summed over all images: exact pixel histograms."""
    h = images.select(hsv_histograms(F.col("image.data"), F.col("image.nChannels")).alias("h"))
    parts = []
    for feat in ("saturation", "brightness"):
        parts.append(h.select(F.lit(feat).alias("feature"),
                              F.posexplode(F.col("h")[feat]).alias("value", "count")))
    return parts[0].unionByName(parts[1]).groupBy("feature", "value") \
        .agg(F.sum("count").cast("bigint").alias("count"))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _channel_values(data: pd.Series, n_channels: pd.Series, offset: pd.Series) -> pd.Series:
    return pd.Series([np.frombuffer(bytes(d), dtype=np.uint8)[int(o)::int(c)].astype(np.int32)
                      .tolist() for d, c, o in zip(data, n_channels, offset)])


def pixel_channel(images: DataFrame, offset: int = 0) -> DataFrame:
    """Values of one channel of every image (offset 0 = blue in BGR bytes)."""
    i = F.col("image")
    return images.select(i["origin"].alias("origin"),
                         _channel_values(i["data"], i["nChannels"], F.lit(offset)).alias("values"))


# Image features by name: a function of the pixels (height, width, channels; blue first) giving any number of values.
IMAGE_FEATURES: dict[str, Callable[[np.ndarray], np.ndarray]] = {}


def register_image_feature(name: str, fn: Callable[[np.ndarray], np.ndarray]) -> None:
    IMAGE_FEATURES[name] = fn


def _brightness(px: np.ndarray) -> np.ndarray:
    return px[:, :, :3].max(axis=2)


def _saturation(px: np.ndarray) -> np.ndarray:
    if px.shape[2] < 3:
        return np.zeros(px.shape[:2], dtype=np.int64)
    colours = px[:, :, :3].astype(np.int64)
    v = colours.max(axis=2)
    return (v - colours.min(axis=2)) * 255 // np.maximum(v, 1)


register_image_feature("saturation", _saturation)
register_image_feature("brightness", _brightness)


def chain(*fns: Callable[[np.ndarray], np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
    """Transforms applied one after the other; all but the last give pixels again."""
    def run(px):
        for fn in fns:
            px = fn(px)
        return px
    return run


def _pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)


def feature_rows(images: DataFrame, features: dict[str, Callable], keep=()) -> DataFrame:
    """One column per feature, one row per value (features of fewer values end in nulls), beside the image's ``keep`` columns.

    Images without pixels (null or undecoded, size below 0) give no rows.
    """
    i = F.col("image")
    kept = [F.col(quote(c)) for c in keep]
    src = images.filter(i.isNotNull() & i["data"].isNotNull() & (i["height"] > 0) & (i["width"] > 0)).select(
        *kept, i["data"].alias("__data"), i["height"].alias("__height"), i["width"].alias("__width"), i["nChannels"].alias("__channels"))
    schema = T.StructType([images.schema[c] for c in keep] + [T.StructField(f, T.DoubleType()) for f in features])
    names, n_keep = schema.fieldNames(), len(keep)

    def run(batches):
        for whole in batches:
            for b in (whole.slice(at, IMAGES_PER_BATCH) for at in range(0, whole.num_rows, IMAGES_PER_BATCH)):
                shape = [b.column(n_keep + j).to_pylist() for j in range(4)]
                for row, image in enumerate(zip(*shape)):
                    px = _pixels(*image)
                    values = [np.asarray(fn(px), dtype=np.float64).ravel() for fn in features.values()]
                    longest = max(map(len, values))
                    for at in range(0, longest, SLICE):
                        n = min(SLICE, longest - at)
                        cols = [pa.array([b.column(j)[row].as_py()] * n, b.column(j).type) for j in range(n_keep)]
                        for v in values:
                            part = v[at:at + SLICE]
                            cols.append(pa.array(np.pad(part, (0, n - len(part))), mask=np.arange(n) >= len(part)))
                        yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, schema)


def profile_images(images: DataFrame, name: str = "images", features=("saturation", "brightness"), *,
                   metadata: bool = True, tags=(), time_column: str | None = None, **options) -> DataFrame:
    """Profile rows of image features, and of width, height, channels and pixels if ``metadata``.

    ``features`` are registered names, or a dict of names and functions of the pixels.  ``count`` of a
    feature is its number of values (not of images); NaN is no value.  ``tags`` and ``time_column`` are columns beside ``image``;
    other options are those of ``profile``.
    """
    if not isinstance(features, dict):
        features = {f: IMAGE_FEATURES[f] for f in features}
    keep = [*tags, *([time_column] if time_column else [])]
    clash = set(features) & {*keep, "width", "height", "channels", "pixels"}
    if clash or not features:
        raise ValueError(f"feature names missing or taken: {sorted(clash)}")
    p = profile(feature_rows(images, features, keep), name, tags=list(tags), time_column=time_column, **options)
    # a shorter feature's padding is no missing value
    p = p.withColumn("count", F.col("count") - F.col("null_count")).withColumn("null_count", F.lit(0).cast("bigint"))
    if not metadata:
        return p
    i = F.col("image")
    meta = images.select(*[F.col(quote(c)) for c in keep], i["width"].alias("width"), i["height"].alias("height"),
                         i["nChannels"].alias("channels"), (i["width"] * i["height"]).cast("bigint").alias("pixels"))
    return p.unionByName(profile(meta, name, tags=list(tags), time_column=time_column, **options))
