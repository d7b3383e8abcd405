"""Ingest lifecycles of database records and API documents.

The source is read once: one map-only pass turns records into text, masks,
chunks and writes them with their outcome as the run's stage table, and the
run's counters are observed in that pass. Quarantine, lineage and what goes to
the store are read from the stage table, so none of them reads the source or
cuts a text again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusflow.functions.text import record_text
from corpusflow.operators.chunking import recursive_chunks
from corpusflow.operators.document_log import DocumentLog
from corpusflow.operators.masking import mask_documents
from corpusflow.operators.sizing import split_repeated
from corpusflow.session import scratch_path

NO_ID = "no document id"


@dataclass
class RecordRun:
    chunks: DataFrame       # document_id, chunk_id, chunk_index, total_chunks, content, source_type, source_uri, run_id
    quarantine: DataFrame   # document_id, content, error
    lineage: DataFrame      # run_id, document_id, source_type, source_uri, chunking_method, chunk_count, ingestion_ts
    stats: dict[str, int]   # total, successful, failed, total_chunks: every record counts
    version: int | None


def _greatest(good: DataFrame) -> DataFrame:
    """One record an id: the greatest text hash; the texts of equal ones are equal, so any of them."""
    others = [c for c in good.columns if c != "document_id"]
    return good.groupBy("document_id").agg(F.max_by(F.struct(*others), "text_sha").alias("r")).select("document_id", *[f"r.{c}" for c in others])


def _run(records: DataFrame, chunks: Callable[[Column], Column], method: str, store: DocumentLog | None,
         run_id: str, mask: bool) -> RecordRun:
    spark = records.sparkSession
    if mask:
        records = mask_documents(records, "text")
    error = F.coalesce("error", F.when(F.col("document_id").isNull(), F.lit(NO_ID)))
    outcome = records.withColumn("error", error).withColumn(
        "parts", F.when(F.col("error").isNull(), chunks(F.coalesce("text", F.lit("")))).otherwise(F.array().cast("array<string>")))
    outcome = outcome.select("document_id", "source_type", "source_uri", "error", "parts",
                             F.size("parts").alias("chunk_count"), F.sha2("text", 256).alias("text_sha"),
                             F.when(F.col("error").isNotNull(), F.col("text")).alias("failed_text"),
                             F.current_timestamp().alias("ingestion_ts"))
    seen = Observation()
    path = scratch_path(spark, "record-run")
    # no shuffle before the write: a task that is run again is counted once
    outcome.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(F.col("error").isNull()).alias("successful"),
                    F.count_if(F.col("error").isNotNull()).alias("failed"),
                    F.coalesce(F.sum("chunk_count"), F.lit(0)).alias("total_chunks")).write.parquet(path)
    stats = {k: int(v or 0) for k, v in seen.get.items()}
    stage = spark.read.schema(outcome.schema).parquet(path)

    good = stage.where(F.col("error").isNull())
    # of records that repeat an id, those of the greatest text hash stay, and of equal ones one: only ids whose
    # hash repeats are grouped, all others pass with their parts where they were read
    lone, repeated = split_repeated(good.where(F.col("text_sha").isNotNull()), ["document_id"], scratch_path(spark, "record-ids"))
    rows = lone if repeated is None else lone.unionByName(_greatest(repeated))
    rows = rows.select(
        "document_id", "source_type", "source_uri", F.col("chunk_count").alias("total_chunks"), "ingestion_ts",
        F.posexplode_outer("parts").alias("chunk_index", "content")).where(F.col("content").isNotNull())
    rows = rows.withColumn("chunk_id", F.concat_ws("-", "document_id", F.col("chunk_index").cast("string"))).withColumn("run_id", F.lit(run_id))
    version = None if store is None else store.replace(rows, good.select("document_id"))
    if store is not None:
        rows = store.read(version).where(F.col("run_id") == run_id)
    traced = good.groupBy("document_id", "source_type", "source_uri").agg(
        F.max_by("chunk_count", "text_sha").alias("chunk_count"), F.max("ingestion_ts").alias("ingestion_ts")) \
        .withColumns({"chunking_method": F.lit(method), "run_id": F.lit(run_id)})
    bad = stage.where(F.col("error").isNotNull()).select("document_id", F.col("failed_text").alias("content"), "error")
    return RecordRun(rows, bad, traced, stats, version)


def ingest_records(envelopes: DataFrame, id_field: str, store: DocumentLog | None = None, run_id: str = "records",
                   chunk_size: int = 1000, chunk_overlap: int = 200, mask: bool = True) -> RecordRun:
    """Database records (``content`` struct and ``metadata`` as the sources of
    :mod:`database` give them): ``name: value`` text, recursive chunks, one
    document a record, named ``<source_uri>/<id_field's value>``.

    A record without an id goes to quarantine; null fields read ``None``; of
    records that repeat an id the one with the greatest SHA-256 of its text is
    kept (all are counted). With a store, a document's chunks replace its
    former ones whole."""
    names = envelopes.schema["content"].dataType.names
    records = envelopes.select(
        F.concat("metadata.source_uri", F.lit("/"), F.col("content")[id_field].cast("string")).alias("document_id"),
        F.col("metadata.source_type").alias("source_type"), F.col("metadata.source_uri").alias("source_uri"),
        record_text(names, [F.col("content")[n] for n in names]).alias("text"), F.lit(None).cast("string").alias("error"))
    return _run(records, lambda t: recursive_chunks(t, chunk_size, chunk_overlap), "recursive", store, run_id, mask)


def ingest_api(documents: DataFrame, malformed: DataFrame | None = None, store: DocumentLog | None = None,
               run_id: str = "api", mask: bool = True) -> RecordRun:
    """API documents (``content`` variant and ``metadata`` as the sources of
    :mod:`api` give them): ``name: value`` lines by name, one chunk a document,
    named by its ``source_uri``. A content that is no object is its own text;
    numbers read without trailing zeros (73.0 as 73), as variants keep none.
    ``malformed`` (``value, error``) joins the quarantine and the counts."""
    fields = F.array_sort(F.map_entries(F.try_variant_get("content", "$", "map<string,string>")))
    lines = F.array_join(F.transform(fields, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("None")))), "\n")
    records = documents.select(
        F.col("metadata.source_uri").alias("document_id"), F.col("metadata.source_type").alias("source_type"),
        F.col("metadata.source_uri").alias("source_uri"),
        F.coalesce(lines, F.try_variant_get("content", "$", "string")).alias("text"), F.lit(None).cast("string").alias("error"))
    if malformed is not None:
        none = F.lit(None).cast("string")
        records = records.unionByName(malformed.select(
            none.alias("document_id"), F.lit("api").alias("source_type"), none.alias("source_uri"),
            F.col("value").alias("text"), "error"))
    return _run(records, F.array, "single", store, run_id, mask)
