"""Running streams to completion with checkpoints in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusflow.session import scratch_path


def run_available(stream: DataFrame, name: str, out_path: str | None = None,
                  fmt: str = "parquet", foreach_batch: Callable | None = None,
                  output_mode: str = "append", checkpoint: str | None = None) -> str:
    """Process everything currently available (``availableNow``) and stop.

    With ``checkpoint``, a path that the caller keeps, a later run resumes
    after the last committed batch; without one, every run starts afresh in a
    new folder of the shared scratch area. Returns the output path (or the
    checkpoint path when ``foreach_batch`` is used)."""
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, f"{name}-ckpt")
    w = stream.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True) \
              .outputMode(output_mode)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
        target = ckpt
    else:
        out_path = out_path or scratch_path(spark, name)
        q = w.format(fmt).option("path", out_path).start()
        target = out_path
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return target


def read_back(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
