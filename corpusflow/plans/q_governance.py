"""Registered governance queries (G1-G4, G6-G9) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import governance as gv
from corpusflow.operators.chunking import chunk_fixed
from corpusflow.operators.parsing import decode_utf8
from corpusflow.plans import fixtures as fx
from corpusflow.plans.registry import register
from corpusflow.session import scratch_path
from corpusflow.sources import messages as msg
from corpusflow.sources.tables import read_table
from corpusflow.plans.sqlparts import CORPUS


def _windows_sql(src: str, extra: str = "") -> str:
    return (f"SELECT doc_id, s // 800 AS chunk_index, substr(text, s + 1, 1000) AS content{extra} "
            f"FROM (SELECT *, unnest(range(0, length(text), 800)) AS s FROM {src})")


SQL_UPSERT = f"""WITH d2 AS (SELECT doc_id, text || ' [rev 2]' AS text FROM documents WHERE lang = 'en'),
u AS ({_windows_sql('documents', ', 1 AS batch_id')} UNION ALL {_windows_sql('d2', ', 2 AS batch_id')})
SELECT doc_id::VARCHAR || '-' || chunk_index::VARCHAR AS chunk_id, doc_id, chunk_index::BIGINT AS chunk_index,
       batch_id::BIGINT AS batch_id, sha256(content) AS content_sha
FROM u QUALIFY row_number() OVER (PARTITION BY doc_id, chunk_index ORDER BY batch_id DESC) = 1"""


@register("index_upsert", SQL_UPSERT)
def q_index_upsert(spark, sf_dir):
    """G1: chunk index snapshot v0 from all documents, then an upsert of the
    revised English documents as snapshot v1 (read back from Parquet)."""
    d = read_table(spark, sf_dir, "documents")

    def batch(df, bid, ts):
        c = chunk_fixed(df.select("doc_id", "text"), 1000, 200)
        return c.withColumns({"batch_id": F.lit(bid).cast("long"), "ingest_ts": F.lit(ts).cast("timestamp")})

    store = gv.SnapshotTable(spark, scratch_path(spark, "chunk-index"))
    gv.upsert_snapshot(store, batch(d, 1, "2024-01-01"))
    rev = d.where(F.col("lang") == "en").withColumn("text", F.concat("text", F.lit(" [rev 2]")))
    gv.upsert_snapshot(store, batch(rev, 2, "2024-02-01"))
    r = store.read()
    return r.select("chunk_id", "doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "batch_id",
                    F.sha2("content", 256).alias("content_sha"))


SQL_REVISIONS = f"""WITH cut AS (SELECT doc_id, substr(text, 1, length(text) // 3) AS text FROM documents WHERE lang = 'fr'),
more AS (SELECT doc_id, text || ' ' || text AS text FROM documents WHERE lang = 'de'),
u AS ({_windows_sql("(SELECT doc_id, text FROM documents WHERE lang = 'en')", ', 0 AS revision')}
      UNION ALL {_windows_sql('cut', ', 1 AS revision')} UNION ALL {_windows_sql('more', ', 2 AS revision')})
SELECT doc_id, chunk_index::BIGINT AS chunk_index, revision::BIGINT AS revision, sha256(content) AS content_sha FROM u"""


@register("index_revisions", SQL_REVISIONS)
def q_index_revisions(spark, sf_dir):
    """G1: the chunk index as a log: all documents; French ones cut to a third (their old tail
    chunks go); German ones doubled; Spanish ones deleted; then compacted."""
    from corpusflow.operators.document_log import DocumentLog
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    log = DocumentLog(spark, scratch_path(spark, "chunk-log"), key="doc_id")

    def chunks(rows, revision):
        return chunk_fixed(rows.drop("lang"), 1000, 200).withColumn("revision", F.lit(revision).cast("long"))

    def of(lang):
        return d.where(F.col("lang") == lang)

    log.replace(chunks(d, 0), d)
    fr = of("fr").withColumn("text", F.substring("text", F.lit(1), F.floor(F.length("text") / 3).cast("int")))
    log.replace(chunks(fr, 1), fr)
    de = of("de").withColumn("text", F.concat("text", F.lit(" "), "text"))
    log.replace(chunks(de, 2), de)
    log.delete(of("es"))
    log.compact()
    return log.read().select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "revision",
                             F.sha2("content", 256).alias("content_sha"))


def _corpus_chunks(spark, sf_dir):
    docs = fx.corpus_docs(spark, sf_dir)
    return docs, chunk_fixed(docs.select("doc_id", "text", "source_type", "doc_date"), 1000, 200)


SQL_LINEAGE = f"""WITH {CORPUS},
c AS ({_windows_sql('corpus', ', source_type, doc_date')})
SELECT 'run-1' AS run_id, doc_id AS document_id, source_type, 's3://corpus/' || doc_id::VARCHAR AS source_uri,
       'fixed' AS chunking_method, count(*)::BIGINT AS chunk_count, max(doc_date)::VARCHAR AS ingestion_ts
FROM c GROUP BY ALL"""


@register("lineage", SQL_LINEAGE)
def q_lineage(spark, sf_dir):
    """Lineage rows (document, source, chunk count) of one run."""
    _, ch = _corpus_chunks(spark, sf_dir)
    ch = ch.withColumns({"document_id": F.col("doc_id"),
                         "source_uri": F.concat(F.lit("s3://corpus/"), F.col("doc_id").cast("string")),
                         "ingestion_ts": F.col("doc_date")})
    r = gv.lineage(ch, "run-1")
    return r.select("run_id", "document_id", "source_type", "source_uri", "chunking_method",
                    F.col("chunk_count").cast("long").alias("chunk_count"),
                    F.col("ingestion_ts").cast("string").alias("ingestion_ts"))


SQL_PAGE_STATUS = """b AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN encode(html) || '\\xFF'::BLOB ELSE encode(html) END AS content
      FROM pages),
st AS (SELECT page_id, CASE WHEN try(decode(content)) IS NULL THEN 'invalid_utf8' ELSE 'ok' END AS status,
              coalesce(len(range(0, length(try(decode(content))), 800)), 0) AS chunk_count FROM b)"""


def _page_status(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    raw = F.encode("html", "UTF-8")
    content = F.when(F.pmod("page_id", F.lit(7)) == 0, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw)
    d = decode_utf8(p.select("page_id", content.alias("content")))
    good, bad = gv.split_quarantine(d, F.col("decode_status") == "ok", F.col("decode_status"))
    counts = chunk_fixed(good.select(F.col("page_id").alias("doc_id"), "text"), 1000, 200) \
        .groupBy(F.col("doc_id").alias("page_id")).agg(F.count(F.lit(1)).alias("chunk_count"))
    ok_rows = good.select("page_id", F.lit("ok").alias("status")).join(counts, "page_id", "left") \
                  .fillna({"chunk_count": 0})
    bad_rows = bad.select("page_id", F.col("decode_status").alias("status"), F.lit(0).cast("long").alias("chunk_count"))
    return ok_rows.unionByName(bad_rows), bad


@register("run_stats", f"""WITH {SQL_PAGE_STATUS}
SELECT count(*)::BIGINT AS total, count(*) FILTER (WHERE status = 'ok')::BIGINT AS successful,
       count(*) FILTER (WHERE status <> 'ok')::BIGINT AS failed,
       coalesce(sum(chunk_count) FILTER (WHERE status = 'ok'), 0)::BIGINT AS total_chunks FROM st""")
def q_run_stats(spark, sf_dir):
    """Run counters over page ingestion (decode, chunk)."""
    status, _ = _page_status(spark, sf_dir)
    r = gv.run_stats(status)
    return r.select(*[F.col(c).cast("long").alias(c) for c in ("total", "successful", "failed", "total_chunks")])


@register("quarantine", f"""WITH {SQL_PAGE_STATUS}
SELECT 'pages' AS source, page_id::VARCHAR AS record_id, status AS error FROM st WHERE status <> 'ok'
UNION ALL
SELECT 'messages', (event_id % 4)::VARCHAR || '/' || (event_id // 4)::VARCHAR,
       'not a JSON object: ' || CASE WHEN event_id % 97 = 0 THEN 'text' ELSE 'array' END
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0""")
def q_quarantine(spark, sf_dir):
    """Quarantined items of two ingests: pages that are not UTF-8 and
    messages that are not JSON objects."""
    _, bad_pages = _page_status(spark, sf_dir)
    _, bad_msgs = msg.iot_readings(msg.decode_messages(fx.messages(spark, sf_dir)))
    p = bad_pages.select(F.lit("pages").alias("source"), F.col("page_id").cast("string").alias("record_id"), "error")
    m = bad_msgs.select(F.lit("messages").alias("source"),
                        F.concat(F.col("metadata.partition").cast("string"), F.lit("/"),
                                 F.col("metadata.offset").cast("string")).alias("record_id"), "error")
    return p.unionByName(m)


SQL_CHUNK_COUNTS = f"""{CORPUS},
cc AS (SELECT doc_id, count(*) AS chunk_count FROM ({_windows_sql('documents')}) GROUP BY doc_id),
j AS (SELECT c.*, coalesce(cc.chunk_count, 0) AS chunk_count FROM corpus c LEFT JOIN cc USING (doc_id))"""


def _counts(spark, sf_dir):
    docs, ch = _corpus_chunks(spark, sf_dir)
    return docs, ch.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunk_count"))


@register("corpus_stats", f"""WITH {SQL_CHUNK_COUNTS}
SELECT CASE GROUPING(source_type, document_type) WHEN 1 THEN 'source_type' WHEN 2 THEN 'document_type' ELSE 'total' END AS grouping,
       CASE GROUPING(source_type, document_type) WHEN 1 THEN source_type WHEN 2 THEN document_type END AS key,
       count(DISTINCT doc_id)::BIGINT AS documents, sum(chunk_count)::BIGINT AS chunks, max(doc_date)::VARCHAR AS last_updated
FROM j GROUP BY GROUPING SETS ((source_type), (document_type), ())""")
def q_corpus_stats(spark, sf_dir):
    """Corpus statistics per source type, per document type and overall
    in one grouping-sets pass."""
    docs, counts = _counts(spark, sf_dir)
    r = gv.corpus_stats(docs, counts)
    return r.select("grouping", "key", F.col("documents").cast("long").alias("documents"),
                    F.col("chunks").cast("long").alias("chunks"),
                    F.col("last_updated").cast("string").alias("last_updated"))


@register("document_summary", f"""WITH {SQL_CHUNK_COUNTS}
SELECT doc_id, source_type, document_type, security_clearance, chunk_count::BIGINT AS chunk_count,
       CASE WHEN chunk_count > 0 THEN 'indexed' ELSE 'pending' END AS status FROM j""")
def q_document_summary(spark, sf_dir):
    """Every document with its chunk count and indexed status."""
    docs, counts = _counts(spark, sf_dir)
    r = gv.document_summary(docs, counts)
    return r.select("doc_id", "source_type", "document_type", "security_clearance",
                    F.col("chunk_count").cast("long").alias("chunk_count"), "status")


@register("job_status", f"""WITH cc AS (SELECT doc_id, count(*) AS chunk_count FROM ({_windows_sql('documents')}) GROUP BY doc_id),
st AS (SELECT 'job-' || d.source AS job_id, CASE WHEN length(d.text) > 0 THEN 'ok' ELSE 'empty' END AS status,
              coalesce(cc.chunk_count, 0) AS chunk_count FROM documents d LEFT JOIN cc USING (doc_id))
SELECT job_id, count(*)::BIGINT AS total, count(*) FILTER (WHERE status = 'ok')::BIGINT AS successful,
       count(*) FILTER (WHERE status <> 'ok')::BIGINT AS failed,
       coalesce(sum(chunk_count) FILTER (WHERE status = 'ok'), 0)::BIGINT AS total_chunks,
       CASE WHEN count(*) FILTER (WHERE status <> 'ok') > 0 THEN 'completed_with_errors' ELSE 'completed' END AS state
FROM st GROUP BY job_id""")
def q_job_status(spark, sf_dir):
    """One ingestion job per document source with its counters."""
    d = read_table(spark, sf_dir, "documents")
    counts = chunk_fixed(d.select("doc_id", "text"), 1000, 200).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunk_count"))
    st = d.select("doc_id", F.concat(F.lit("job-"), "source").alias("job_id"),
                  F.when(F.length("text") > 0, "ok").otherwise("empty").alias("status")) \
          .join(counts, "doc_id", "left").fillna({"chunk_count": 0})
    runs = gv.run_stats(st, ["job_id"])
    r = gv.job_status(runs)
    return r.select("job_id", *[F.col(c).cast("long").alias(c) for c in ("total", "successful", "failed", "total_chunks")],
                    "state")


SQL_VERSIONS = """WITH a AS (SELECT doc_id, text, TIMESTAMP '2024-01-01' AS ingest_ts FROM documents),
b AS (SELECT doc_id, CASE WHEN lang = 'de' THEN text || ' (rev)' ELSE text END AS text, TIMESTAMP '2024-02-01' AS ingest_ts FROM documents),
c AS (SELECT doc_id, CASE WHEN lang = 'de' THEN text || ' (rev)' ELSE text END
                     || CASE WHEN lang = 'fr' THEN ' (fr rev)' ELSE '' END AS text, TIMESTAMP '2024-03-01' AS ingest_ts FROM documents),
v AS (SELECT *, sha256(text) AS content_sha FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)),
ch AS (SELECT * FROM v QUALIFY lag(content_sha) OVER (PARTITION BY doc_id ORDER BY ingest_ts) IS NULL
                          OR lag(content_sha) OVER (PARTITION BY doc_id ORDER BY ingest_ts) <> content_sha)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ingest_ts)::BIGINT AS version,
       ingest_ts::VARCHAR AS valid_from, (lead(ingest_ts) OVER (PARTITION BY doc_id ORDER BY ingest_ts))::VARCHAR AS valid_to,
       lead(ingest_ts) OVER (PARTITION BY doc_id ORDER BY ingest_ts) IS NULL AS is_current, content_sha
FROM ch"""


@register("versioned_index", SQL_VERSIONS)
def q_versioned_index(spark, sf_dir):
    """Three ingests of the corpus (German documents revised in the
    second, French ones in the third) folded into a version history."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    b_text = F.when(F.col("lang") == "de", F.concat("text", F.lit(" (rev)"))).otherwise(F.col("text"))
    c_text = F.concat(b_text, F.when(F.col("lang") == "fr", F.lit(" (fr rev)")).otherwise(F.lit("")))
    ingests = [d.select("doc_id", F.col("text").alias("content"), F.lit("2024-01-01").cast("timestamp").alias("ingest_ts")),
               d.select("doc_id", b_text.alias("content"), F.lit("2024-02-01").cast("timestamp").alias("ingest_ts")),
               d.select("doc_id", c_text.alias("content"), F.lit("2024-03-01").cast("timestamp").alias("ingest_ts"))]
    allv = ingests[0].unionByName(ingests[1]).unionByName(ingests[2])
    r = gv.versioned_index(allv)
    return r.select("doc_id", F.col("version").cast("long").alias("version"),
                    F.col("valid_from").cast("string").alias("valid_from"),
                    F.col("valid_to").cast("string").alias("valid_to"), "is_current", "content_sha")


# ----------------------------------------------------------------- E1 / E2
INGEST_EXTS = [".txt", ".md", ".pdf"]


def _sql_ingest_objects() -> str:
    from corpusflow.plans.q_masking import sql_mask_chain
    chain, last = sql_mask_chain("obj")
    return f"""WITH src AS (
  SELECT doc_id, lang || '/doc_' || doc_id::VARCHAR || ['.txt', '.pdf', '.docx', '.md'][(doc_id % 4) + 1] AS key, text
  FROM documents WHERE doc_id % 4 IN (0, 1, 3)),
obj AS (SELECT doc_id, text FROM src WHERE doc_id % 4 <> 1),
{chain}
SELECT key, (s // 800)::BIGINT AS chunk_index, substr(t, s + 1, 1000) AS content, n AS pii_entities_count, NULL AS error
FROM (SELECT src.key, m.t, len(m.found)::BIGINT AS n, unnest(range(0, length(m.t), 800)) AS s
      FROM src JOIN {last} m ON m.doc_id = src.doc_id)
UNION ALL SELECT key, NULL, NULL, NULL, 'no parser for route pdf' FROM src WHERE doc_id % 4 = 1"""


@register("ingest_objects", _sql_ingest_objects())
def q_ingest_objects(spark, sf_dir):
    """Landed document objects (.txt .md .pdf) routed, decoded, masked,
    chunked (1000/200) and upserted into a snapshot store; PDFs are
    quarantined (no decoder) and returned with their reason."""
    return _ingest_landed(spark, sf_dir, INGEST_EXTS, "e1")


def _ingest_landed(spark, sf_dir, extensions, run_id):
    from corpusflow.operators.ingest import ingest_objects
    root = fx.land_document_objects(spark, sf_dir)
    store = gv.SnapshotTable(spark, scratch_path(spark, "ingest-store"))
    r = ingest_objects(spark, root, extensions=extensions, store=store, run_id=run_id)
    chunks = r.chunks.select(F.col("metadata.key").alias("key"), F.col("chunk_index").cast("long").alias("chunk_index"),
                             "content", F.col("pii_entities_count").cast("long").alias("pii_entities_count"))
    return chunks.unionByName(r.quarantine.select("key", "error"), allowMissingColumns=True)


def _sql_ingest_all_objects() -> str:
    from corpusflow.plans.q_masking import sql_mask_chain
    chain, last = sql_mask_chain("obj")
    return f"""WITH src AS (
  SELECT doc_id, lang || '/doc_' || doc_id::VARCHAR || ['.txt', '.pdf', '.docx', '.md'][(doc_id % 4) + 1] AS key, text
  FROM documents),
obj AS (SELECT doc_id, text FROM src WHERE doc_id % 4 <> 1),
{chain}
SELECT key, (s // 800)::BIGINT AS chunk_index, substr(t, s + 1, 1000) AS content, n AS pii_entities_count, NULL AS error
FROM (SELECT src.key, m.t, len(m.found)::BIGINT AS n, unnest(range(0, length(m.t), 800)) AS s
      FROM src JOIN {last} m ON m.doc_id = src.doc_id)
UNION ALL SELECT key, NULL, NULL, NULL, 'no parser for route pdf' FROM src WHERE doc_id % 4 = 1"""


@register("ingest_all_objects", _sql_ingest_all_objects())
def q_ingest_all_objects(spark, sf_dir):
    """E1 over every landed object, whatever its extension (``ingest_objects``
    is the run with an extension list): each appears as its chunks or with its
    quarantine reason. Extensions without a route of their own (.docx) are text
    if they are valid UTF-8, as the landed ones are, else quarantined."""
    return _ingest_landed(spark, sf_dir, None, "e1-all")


def _sql_ingest_stream() -> str:
    from corpusflow.plans.q_masking import sql_mask_chain
    chain, last = sql_mask_chain("ev")
    return f"""WITH ev AS (
  SELECT event_id AS doc_id, 'sensor_id: ' || user_id::VARCHAR || chr(10) || 'sensor_type: ' || event_type || chr(10)
         || 'value: ' || value::VARCHAR || chr(10) || 'location: zone-' || (user_id % 10)::VARCHAR AS text
  FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0),
{chain}
SELECT 'kafka://iot-sensors/' || (doc_id % 4)::VARCHAR || '/' || (doc_id // 4)::VARCHAR || '-0' AS chunk_id,
       t AS content, len(found)::BIGINT AS pii_entities_count
FROM {last}"""


@register("ingest_stream", _sql_ingest_stream())
def q_ingest_stream(spark, sf_dir):
    """Sensor messages landed in two halves, each ingested by a run of the
    stream on the same store; the second run goes on where the first ended."""
    return _ingested(spark, sf_dir).read().select(
        "chunk_id", "content", F.col("pii_entities_count").cast("long").alias("pii_entities_count"))


def _ingested(spark, sf_dir):
    from corpusflow.operators.ingest import ingest_message_stream
    path = scratch_path(spark, "messages")
    store = gv.SnapshotTable(spark, scratch_path(spark, "stream-store"))
    for half in (0, 1):
        fx.land_messages(spark, sf_dir, path=path, part=(half, 2))
        ingest_message_stream(msg.read_messages(spark, path, files_per_trigger=100), store)
    return store


@register("stream_quarantine", """SELECT 'kafka://iot-sensors/' || (event_id % 4)::VARCHAR || '/' || (event_id // 4)::VARCHAR AS document_id
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0""")
def q_stream_quarantine(spark, sf_dir):
    """G4 of a stream: the messages that aren't JSON objects, from both runs."""
    return spark.read.parquet(_ingested(spark, sf_dir).side("quarantine")).select("document_id")


@register("stream_run_stats", """SELECT count(*)::BIGINT AS total, count(*) FILTER (WHERE event_id % 97 <> 0 AND event_id % 89 <> 0)::BIGINT AS successful,
       count(*) FILTER (WHERE event_id % 97 = 0 OR event_id % 89 = 0)::BIGINT AS failed FROM events""")
def q_stream_run_stats(spark, sf_dir):
    """G3 of a stream: counters summed over all batches of both runs."""
    stats = spark.read.parquet(_ingested(spark, sf_dir).side("run_stats"))
    return stats.agg(*[F.sum(c).cast("long").alias(c) for c in ("total", "successful", "failed")])
