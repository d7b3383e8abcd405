"""Image header facts and payloads from the ``image`` and
``binaryFile`` sources (no decoding library in Python)."""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.operators.parsing import IMAGE_MIME, file_extension

# OpenCV type codes used by Spark's image source -> channel layout name.
MODE_NAMES = {0: "L", 16: "RGB", 24: "RGBA"}


def image_facts(spark: SparkSession, root: str) -> DataFrame:
    """``path, format, mode, width, height, n_channels, size_bytes,
    mime_type, base64``: header facts from the image source joined on path
    with the byte length and base64 payload from ``binaryFile``."""
    img = spark.read.format("image").option("recursiveFileLookup", "true").load(root) \
               .select(F.col("image.origin").alias("path"), F.col("image.width").alias("width"),
                       F.col("image.height").alias("height"), F.col("image.nChannels").alias("n_channels"),
                       F.col("image.mode").alias("cv_mode"))
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root) \
               .select("path", F.col("length").alias("size_bytes"), "content")
    # the two sources spell local URIs differently (file:/// vs file:/)
    norm = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    j = img.withColumn("path", norm(F.col("path"))).join(raw.withColumn("path", norm(F.col("path"))), "path")
    ext = file_extension(F.col("path"))
    mime = F.element_at(F.create_map(*[x for k, v in IMAGE_MIME.items() for x in (F.lit(k), F.lit(v))]), ext)
    mode = F.element_at(F.create_map(*[x for k, v in MODE_NAMES.items() for x in (F.lit(k), F.lit(v))]),
                        F.col("cv_mode"))
    return j.select("path", F.upper(ext).alias("format"), F.coalesce(mode, F.lit("other")).alias("mode"),
                    "width", "height", "n_channels", "size_bytes", mime.alias("mime_type"),
                    F.base64("content").alias("base64"))


def _png(width: int, height: int, rgb: tuple[int, int, int]) -> bytes:
    """A solid-colour 8-bit RGB PNG (used to land test images)."""
    row = b"\x00" + bytes(rgb) * width
    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(row * height)) + chunk(b"IEND", b""))


def _solid_png_batch(w: pd.Series, h: pd.Series, r: pd.Series, g: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_png(int(a), int(c), (int(x) % 256, int(y) % 256, int(z) % 256))
                      for a, c, x, y, z in zip(w, h, r, g, b)])


def solid_png(w, h, r, g, b):
    """Column of PNG bytes (Arrow batch UDF, built on the driver when used)."""
    return F.pandas_udf(_solid_png_batch, "binary")(w, h, r, g, b)
