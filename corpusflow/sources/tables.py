"""Parquet table access for the given input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# (application id, path, size, mtime) -> path of the spread copy
_SPREAD_COPIES: dict[tuple, str] = {}
# Files smaller than this are cheap enough for one task; spreading them would
# cost more (an extra write) than it saves.
SPREAD_MIN_BYTES = 8 * 1024 * 1024


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-split DataFrame over the cluster's cores.

    A file with one row group is read by one task, which would then run all
    per-row CPU work (tokenising, chunking, masking) alone. When the plan has
    fewer partitions than the default parallelism, rows are redistributed
    round-robin; a large input that already has enough splits is untouched,
    so at scale this adds no shuffle.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def file_stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    st = fs.getContentSummary(p)
    return int(st.getLength()), int(fs.getFileStatus(p).getModificationTime())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` as a DataFrame.

    If the table is under-split (fewer scan partitions than the default
    parallelism, e.g. a single row group) and at least ``SPREAD_MIN_BYTES``
    large, it is rewritten once per session
    as a spread Parquet copy in the shared checkpoint folder and read from
    there, so every later scan runs in parallel and keeps column pruning and
    filter pushdown. Tables with enough splits are read directly.
    """
    from corpusflow.session import scratch_path
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    target = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    size, mtime = file_stamp(spark, path)
    if size < SPREAD_MIN_BYTES:
        return df
    key = (spark.sparkContext.applicationId, path, size, mtime)
    if key not in _SPREAD_COPIES:
        out = scratch_path(spark, f"spread-{name}")
        df.repartition(target).write.parquet(out)
        _SPREAD_COPIES[key] = out
    return spark.read.parquet(_SPREAD_COPIES[key])
