"""Object folders, listed with :mod:`listing` and read from the tasks.

A folder (local, HDFS, object store) plays the bucket; keys are paths
relative to it. Listing reads no bodies. Reading deals the listed keys out to
tasks by the bytes there are to read, so neither the driver's listing nor the number
of tasks grows with the number of objects, as they do with ``binaryFile``.
"""

from __future__ import annotations

import posixpath

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.session import scratch_path
from corpusflow.sources.listing import fs_uri, listing

# Bytes of bodies that fall to a reading task, about (there are 4 a core at least).
TASK_BYTES = 64 * 1024 * 1024
# Bytes of bodies that a reading task hands on at a time (one object at least).
READ_BYTES = 16 * 1024 * 1024
# Objects that a reading task has open at a time.
READ_AHEAD = 8

# Content type by extension.
CONTENT_TYPES = {
    "pdf": "application/pdf",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "txt": "text/plain",
    "md": "text/markdown",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xls": "application/vnd.ms-excel",
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
}


def land_objects(df: DataFrame, root: str, key_col: str = "key", data_col: str = "data") -> int:
    """Write each row's bytes (or text) to ``root/<key>``, in parallel from the
    tasks through ``pyarrow.fs`` (local, HDFS or S3 URIs). Returns the number
    of objects written."""
    base_uri = fs_uri(root)

    def run(batches):
        from pyarrow import fs as pafs
        fs, base = pafs.FileSystem.from_uri(base_uri)
        made = set()
        for pdf in batches:
            for key, data in zip(pdf["key"], pdf["data"]):
                path = posixpath.join(base, key)
                d = posixpath.dirname(path)
                if d not in made:
                    fs.create_dir(d, recursive=True)
                    made.add(d)
                payload = data.encode("utf-8") if isinstance(data, str) else bytes(data or b"")
                with fs.open_output_stream(path) as out:
                    out.write(payload)
            yield pd.DataFrame({"n": [len(pdf)]})

    out = df.select(F.col(key_col).alias("key"), F.col(data_col).alias("data")) \
            .mapInPandas(run, "n long").agg(F.sum("n")).first()[0]
    return int(out or 0)


def _must_exist(uri: str) -> None:
    from pyarrow import fs as pafs
    fs, base = pafs.FileSystem.from_uri(uri)
    if fs.get_file_info(base).type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)


def _bodies(root_uri: str):
    """Listed objects -> the same with their bodies, a bounded batch at a time."""
    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        from pyarrow import fs as pafs
        fs, base = pafs.FileSystem.from_uri(root_uri)

        def body(key):
            with fs.open_input_stream(posixpath.join(base, key)) as f:
                return f.read()

        with ThreadPoolExecutor(READ_AHEAD) as pool:
            for batch in batches:
                keys, sizes = batch.column("key").to_pylist(), batch.column("size").to_pylist()
                start = 0
                while start < len(keys):
                    end, total = start, 0
                    while end < len(keys) and (end == start or total + sizes[end] <= READ_BYTES):
                        total += sizes[end]
                        end += 1
                    data = pa.array(pool.map(body, keys[start:end]), pa.binary())
                    part = batch.slice(start, end - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, data], [*part.schema.names, "content"])
                    start = end
    return run


def list_objects(spark: SparkSession, root: str, prefix: str = "", suffix: str | None = None,
                 max_keys: int | None = None) -> DataFrame:
    """``key, size, last_modified, etag, bucket`` under ``prefix``.
    Zero-length objects are listed like others; ``prefix`` may end within a name.

    ``max_keys`` caps the listing in key order *before* the suffix test (as
    an object-store page does); by default everything is listed. ``etag`` needs the
    body and is left null here (see :func:`read_objects`)."""
    bucket = posixpath.basename(root.rstrip("/"))
    d = listing(spark, root, prefix).select("key", "size", "last_modified")
    if max_keys is not None:
        d = d.orderBy("key").limit(max_keys)
    if suffix:
        d = d.where(F.col("key").endswith(suffix))
    return d.withColumn("etag", F.lit(None).cast("string")).withColumn("bucket", F.lit(bucket))


def listed_objects(spark: SparkSession, root: str, prefix: str = "", suffix: str | None = None,
                   extensions: list[str] | None = None) -> DataFrame:
    """``document_id, key, size, last_modified`` of the objects that :func:`read_objects` reads, as they are
    now: the listing is written to the scratch folder, so that all passes over it see the same objects."""
    _must_exist(posixpath.join(fs_uri(root).rstrip("/"), posixpath.dirname(prefix)).rstrip("/"))
    bucket = posixpath.basename(root.rstrip("/"))
    d = listing(spark, root, prefix).select(F.sha2(_uri(bucket), 256).alias("document_id"), "key", "size", "last_modified")
    if suffix:
        d = d.where(F.col("key").endswith(suffix))
    if extensions:
        cond = F.lit(False)
        for e in extensions:
            cond = cond | F.col("key").endswith(e)
        d = d.where(cond)
    path = scratch_path(spark, "listing")
    d.write.parquet(path)
    return spark.read.schema(d.schema).parquet(path)


def _uri(bucket: str) -> Column:
    return F.concat(F.lit(f"s3://{bucket}/"), F.col("key"))


def read_objects(spark: SparkSession, root: str, prefix: str = "", suffix: str | None = None,
                 extensions: list[str] | None = None, listed: DataFrame | None = None) -> DataFrame:
    """Objects as envelopes ``document_id, content (binary), metadata``.

    ``suffix`` keeps keys ending with it; ``extensions`` keeps keys ending
    with any of them (case-sensitive); ``listed``, rows of :func:`listed_objects`, takes the
    place of all three. Metadata: source_type, source_uri,
    bucket, key, size, content_type, etag (md5 of the body), last_modified,
    ingestion_ts. An empty object has an empty body."""
    bucket = posixpath.basename(root.rstrip("/"))
    if listed is None:
        listed = listed_objects(spark, root, prefix, suffix, extensions)
    total = listed.agg(F.sum("size")).first()[0] or 0
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    d = listed.repartition(tasks, "key").mapInArrow(
        _bodies(fs_uri(root).rstrip("/")),
        "document_id string, key string, size bigint, last_modified timestamp, content binary")
    ext = F.lower(F.element_at(F.split("key", r"\.", -1), -1))
    ctype = F.coalesce(F.element_at(F.create_map(*[x for k, v in CONTENT_TYPES.items()
                                                   for x in (F.lit(k), F.lit(v))]), ext),
                       F.lit("application/octet-stream"))
    meta = F.struct(F.lit("s3").alias("source_type"), _uri(bucket).alias("source_uri"), F.lit(bucket).alias("bucket"),
                    F.col("key"), F.col("size"), ctype.alias("content_type"),
                    F.md5("content").alias("etag"), F.col("last_modified"),
                    F.current_timestamp().alias("ingestion_ts"))
    return d.select("document_id", "content", meta.alias("metadata"))


def ingest_folder(spark: SparkSession, root: str, prefix: str = "",
                  file_extensions: list[str] | None = None) -> DataFrame:
    """S3: read a folder keeping the given extensions (default .pdf .docx .txt)."""
    return read_objects(spark, root, prefix, extensions=file_extensions or [".pdf", ".docx", ".txt"])
