"""Image source and pixel features on PNGs built in the test (zlib + struct)."""

import struct
import zlib

from pyspark.sql import functions as F

from tallyframe.functions import images as I


def _png(path, w, h, rgb):
    raw = b"".join(b"\x00" + bytes(rgb) * w for _ in range(h))

    def chunk(t, d):
        c = struct.pack(">I", len(d)) + t + d
        return c + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)
    data = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    path.write_bytes(data)


def test_image_features(spark, tmp_path):
    _png(tmp_path / "a.png", 4, 3, (200, 100, 50))   # R, G, B
    _png(tmp_path / "b.png", 2, 2, (0, 0, 255))
    from tallyframe.sources.files import read_images
    imgs = read_images(spark, str(tmp_path))
    meta = {r["width"]: r for r in I.image_metadata(imgs).collect()}
    assert meta[4]["pixels"] == 12 and meta[2]["pixels"] == 4 and meta[4]["channels"] == 3
    hist = {(r["feature"], r["value"]): r["count"] for r in I.image_histograms(imgs).collect()}
    # brightness = max channel: 200 for a (12 px), 255 for b (4 px)
    assert hist[("brightness", 200)] == 12 and hist[("brightness", 255)] == 4
    # saturation = (max - min) * 255 // max
    assert hist[("saturation", (200 - 50) * 255 // 200)] == 12
    assert hist[("saturation", 255)] == 4
    blue = {r["origin"].split("/")[-1]: r["values"] for r in I.pixel_channel(imgs, 0).collect()}
    assert blue["a.png"] == [50] * 12 and blue["b.png"] == [255] * 4   # BGR order


def test_image_profiles_merge_and_are_read_like_others(spark, tmp_path):
    from tallyframe.operators import drift as D
    from tallyframe.operators import series
    from tallyframe.operators.merge import merge_profiles
    from tallyframe.operators.summary import flat_summary
    from tallyframe.sources.files import read_images
    _png(tmp_path / "a.png", 400, 300, (200, 100, 50))      # more pixels than one slice
    _png(tmp_path / "b.png", 2, 2, (0, 0, 255))
    imgs = read_images(spark, str(tmp_path)).withColumn("which", F.substring_index("image.origin", "/", -1))
    features = {**{f: I.IMAGE_FEATURES[f] for f in ("saturation", "brightness")}, "mean": lambda px: px.mean(), "none": lambda px: px[:0],
                "red": I.chain(lambda px: px[:, :, 2:], lambda px: px[::2])}
    whole = I.profile_images(imgs, features=features)
    got = {r["column"]: r for r in whole.collect()}
    assert got["brightness"]["count"] == got["saturation"]["n"] == 400 * 300 + 4 and got["brightness"]["null_count"] == 0
    assert (got["brightness"]["min"], got["brightness"]["max"], got["saturation"]["min"]) == (200, 255, 191)
    assert got["mean"]["n"] == got["width"]["n"] == 2 and got["none"]["count"] == 0 and got["red"]["n"] == 400 * 150 + 2
    assert abs(got["mean"]["max"] - 350 / 3) < 1e-9 and got["pixels"]["max"] == 120000
    tagged = I.profile_images(imgs, features=features, tags=["which"])
    merged = {r["column"]: r for r in merge_profiles(tagged, by=("name", "column")).collect()}
    assert {c: (r["count"], r["min"], r["max"]) for c, r in merged.items()} == {c: (r["count"], r["min"], r["max"]) for c, r in got.items()}
    assert abs(merged["red"]["m2"] - got["red"]["m2"]) < 1e-6 * got["red"]["m2"]
    hist = {r["column"]: r for r in flat_summary(whole, bins=5)["hist"].collect()}
    assert sum(hist["brightness"]["counts"]) == 120004 and "none" not in hist
    a, b = (I.profile_images(imgs.filter(F.col("which") == w)) for w in ("a.png", "b.png"))
    assert D.compare(a, b, "brightness", 5)[1].first()["intersection"] == 0
    assert series.distribution(whole, "brightness").first()["q50"] == 200
    # no images, and rows without pixels
    nothing = {r["column"]: r["count"] for r in I.profile_images(imgs.limit(0)).collect()}
    assert nothing == {c: 0 for c in ("saturation", "brightness", "width", "height", "channels", "pixels")}
    bare = imgs.select(F.when(F.lit(False), F.col("image")).alias("image"))
    assert {r["column"]: r["n"] for r in I.profile_images(bare).collect()}["brightness"] == 0
