"""Ingest lifecycles as Spark jobs.

E1 (objects): read -> route -> decode -> quarantine -> mask -> chunk ->
upsert -> lineage and run statistics; one lazy plan, actions only at writes.
Whole documents are masked, so that no value is cut by a chunk edge and missed.
E2 (messages): the same per micro-batch of a stream, through ``foreachBatch``;
the store notes finished batches by (stream, batch), so replays are no-ops and
a later run on the same store goes on where the last one ended. E3 (search) is :func:`corpusflow.operators.retrieval.hybrid_search`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import record_text
from corpusflow.operators import governance as gv
from corpusflow.operators.chunking import get_chunker
from corpusflow.operators.document_log import DocumentLog
from corpusflow.operators.masking import mask_documents
from corpusflow.operators.parsing import decode_utf8, route_documents
from corpusflow.sources.files import listed_objects, read_objects
from corpusflow.sources.messages import decode_messages, iot_readings


@dataclass
class IngestResult:
    chunks: DataFrame          # what the run produced (masked chunks with ids)
    quarantine: DataFrame      # items that failed, with an error text
    lineage: DataFrame         # one row per ingested document
    stats: DataFrame           # total / successful / failed / total_chunks
    version: int | None = None  # snapshot version written, if a store was given


def _finish(chunks: DataFrame, run_id: str, batch_id: int) -> DataFrame:
    return chunks.withColumns({
        "chunk_id": F.concat_ws("-", F.col("document_id").cast("string"), F.col("chunk_index").cast("string")),
        "run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long"),
        "ingest_ts": F.current_timestamp()})


def ingest_objects(spark: SparkSession, root: str, prefix: str = "", extensions: list[str] | None = None,
                   chunker: Callable[[DataFrame], DataFrame] | None = None, mask: bool = True,
                   store: gv.SnapshotTable | DocumentLog | None = None, run_id: str = "run",
                   batch_id: int = 0, empty_objects: bool = False) -> IngestResult:
    """E1 over an object folder. Text objects are decoded (strict UTF-8) and
    chunked; objects of routes without a decoder here (pdf, workbook, image)
    and undecodable ones go to quarantine with their reason. ``chunker``
    defaults to fixed 1000/200 windows keyed by ``document_id``; any of ``get_chunker`` with that
    ``id_col`` will do. A ``DocumentLog`` as store replaces the ingested documents whole, so that a shorter revision
    leaves no old chunks; a snapshot table is upserted by chunk. With ``empty_objects``, objects without a body are
    counted too (a text one is a document without chunks, others go to quarantine); else they are left out."""
    listed = listed_objects(spark, root, prefix, extensions=extensions)
    if not empty_objects:
        listed = listed.where(F.col("size") > 0)
    objs = read_objects(spark, root, listed=listed)
    routed = route_documents(objs.withColumn("filename", F.col("metadata.key")))
    decoded = decode_utf8(routed, "content", "text")
    ok = (F.col("route") == "text") & (F.col("decode_status") == "ok")
    reason = F.when(F.col("route") != "text", F.concat(F.lit("no parser for route "), F.col("route"))) \
              .otherwise(F.col("decode_status"))
    good, bad = gv.split_quarantine(decoded, ok, reason)
    docs = good.select("document_id", "text", "metadata")
    if mask:
        docs = mask_documents(docs, "text")
    chunk = chunker or get_chunker("fixed", chunk_size=1000, chunk_overlap=200, id_col="document_id")
    chunks = _finish(chunk(docs), run_id, batch_id)
    version = None
    if store is not None:
        version = store.replace(chunks, docs) if isinstance(store, DocumentLog) else gv.upsert_snapshot(store, chunks, "chunk_id")
        chunks = store.read().where(F.col("run_id") == run_id)
    flat = chunks.select("document_id", F.col("metadata.source_type").alias("source_type"),
                         F.col("metadata.source_uri").alias("source_uri"), "chunking_method",
                         F.col("ingest_ts").alias("ingestion_ts"))
    lineage = gv.lineage(flat, run_id)
    counts = chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("chunk_count"))
    status = listed.select("document_id").join(counts, "document_id", "left") \
        .join(bad.select("document_id", F.lit(1).alias("__bad")), "document_id", "left") \
        .select(F.when(F.col("__bad").isNotNull(), "failed").otherwise("ok").alias("status"),
                F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"))
    quarantine = bad.select("document_id", F.col("metadata.key").alias("key"), "error")
    return IngestResult(chunks, quarantine, lineage, gv.run_stats(status), version)


# The sensor message fields in their JSON order.
SENSOR_FIELDS = ["sensor_id", "sensor_type", "value", "location"]


def ingest_messages_batch(batch: DataFrame, batch_id: int, store: gv.SnapshotTable,
                          sensor_types: list[str] | None = None, mask: bool = True,
                          run_id: str = "stream", stream: str = "stream") -> None:
    """E2 step for one micro-batch: sensor messages -> one ``key: value`` chunk each
    (the sensor fields, then all others by name) -> mask -> upsert. What isn't a JSON object goes to the store's quarantine;
    lineage and counts of the batch are written beside it."""
    if store.committed(stream, batch_id):
        return
    batch = batch.persist()
    ok, bad = iot_readings(decode_messages(batch), sensor_types)
    more = F.array_sort(F.map_entries(F.map_filter("payload", lambda k, v: ~k.isin(*SENSOR_FIELDS))))
    text = F.concat_ws("\n", record_text(SENSOR_FIELDS, [F.col(c) for c in SENSOR_FIELDS]), F.transform(
        more, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None")))))
    docs = ok.select(F.col("metadata.source_uri").alias("document_id"), "metadata",
                     text.alias("content"), F.lit(0).alias("chunk_index"), F.lit(1).alias("total_chunks"),
                     F.lit("single").alias("chunking_method"))
    if mask:
        docs = mask_documents(docs, "content")
    chunks = _finish(docs.withColumn("chunk_size", F.length("content")), run_id, batch_id)
    part = f"stream={stream}/batch={batch_id}"
    bad = bad.select(F.col("metadata.source_uri").alias("document_id"), "raw_value", "error")
    bad.write.mode("overwrite").parquet(f"{store.side('quarantine')}/{part}")
    flat = chunks.select("document_id", F.col("metadata.source_type").alias("source_type"),
                         F.col("metadata.source_uri").alias("source_uri"), "chunking_method",
                         F.col("ingest_ts").alias("ingestion_ts"))
    gv.lineage(flat, run_id).write.mode("overwrite").parquet(f"{store.side('lineage')}/{part}")
    status = docs.select(F.lit("ok").alias("status"), F.lit(1).alias("chunk_count")) \
        .unionByName(bad.select(F.lit("failed").alias("status"), F.lit(0).alias("chunk_count")))
    gv.run_stats(status).write.mode("overwrite").parquet(f"{store.side('run_stats')}/{part}")
    gv.upsert_snapshot(store, chunks, "chunk_id")
    store.commit(stream, batch_id)
    batch.unpersist()


def ingest_message_stream(stream: DataFrame, store: gv.SnapshotTable, sensor_types: list[str] | None = None,
                          mask: bool = True, run_id: str = "stream", name: str = "ingest-stream"):
    """Run a message stream to completion (``availableNow``) with each
    micro-batch ingested by :func:`ingest_messages_batch`. The checkpoint is
    kept with the store, one for each ``name``, so that a second run takes only
    what is new. Returns the store's current snapshot."""
    from corpusflow.streaming.runner import run_available
    run_available(stream, name, checkpoint=store.side(f"checkpoints/{name}"), foreach_batch=lambda b, i: ingest_messages_batch(
        b, i, store, sensor_types, mask, run_id, name))
    return store.read()
