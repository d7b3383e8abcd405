"""Ingest of records and API documents: counters, quarantine, revisions."""
from pyspark.sql import functions as F

from corpusflow.operators.document_log import DocumentLog
from corpusflow.operators.record_ingest import NO_ID, ingest_api, ingest_records
from corpusflow.session import scratch_path


def _envelopes(spark, rows):
    df = spark.createDataFrame(rows, "id long, note string")
    return df.select(F.struct("id", "note").alias("content"), F.struct(
        F.lit("database").alias("source_type"), F.lit("db://t").alias("source_uri")).alias("metadata"))


def _stored(run):
    out = {}
    for r in sorted(run.chunks.collect(), key=lambda r: r.chunk_index):
        out.setdefault(r.document_id, []).append(r.content)
    return out


def test_counts_quarantine_and_lineage(spark):
    rows = [(1, "short"), (2, "a b c d " * 10), (None, "lost"), (3, None), (4, "x"), (4, "y"), (4, "y")]
    run = ingest_records(_envelopes(spark, rows), "id", chunk_size=30, chunk_overlap=5, mask=False)
    chunks = _stored(run)
    assert run.stats["total"] == 7 and run.stats["successful"] == 6 and run.stats["failed"] == 1
    assert chunks["db://t/1"] == ["id: 1\nnote: short"] and chunks["db://t/3"] == ["id: 3\nnote: None"]
    assert len(chunks["db://t/2"]) > 2 and len(chunks["db://t/4"]) == 1
    assert [(r.document_id, r.content, r.error) for r in run.quarantine.collect()] == [(None, "id: None\nnote: lost", NO_ID)]
    assert {r.document_id: r.chunk_count for r in run.lineage.collect()} == {d: len(c) for d, c in chunks.items()}


def test_shorter_revision_and_empty_run(spark):
    log = DocumentLog(spark, scratch_path(spark, "test-record-log"))
    first = ingest_records(_envelopes(spark, [(1, "a b c d " * 20), (2, "kept")]), "id", log, "r1", 30, 5)
    assert len(_stored(first)["db://t/1"]) > 3
    second = ingest_records(_envelopes(spark, [(1, "cut")]), "id", log, "r2", 30, 5)
    assert _stored(second) == {"db://t/1": ["id: 1\nnote: cut"]}
    assert {r.document_id: r.content for r in log.read().collect()} == {
        "db://t/1": "id: 1\nnote: cut", "db://t/2": "id: 2\nnote: kept"}
    none = ingest_records(_envelopes(spark, []), "id", log, "r3")
    assert none.stats.get("total", 0) == 0 and none.chunks.count() == 0 and log.read().count() == 2


def test_masking_is_on_by_default(spark):
    run = ingest_records(_envelopes(spark, [(1, "call 555-123-4567")]), "id")
    assert "555-123" not in _stored(run)["db://t/1"][0]


def test_api_documents_and_malformed_responses(spark):
    docs = spark.createDataFrame([("api://a/1", '{"b": 2, "a": {"c": [1]}, "n": null}'), ("api://a/2", '"plain"')],
                                 "uri string, js string").select(
        F.parse_json("js").alias("content"), F.struct(F.lit("api").alias("source_type"), F.col("uri").alias("source_uri")).alias("metadata"))
    bad = spark.createDataFrame([("{oops", "malformed response")], "value string, error string")
    run = ingest_api(docs, bad, mask=False)
    assert _stored(run) == {"api://a/1": ['a: {"c":[1]}\nb: 2\nn: None'], "api://a/2": ["plain"]}
    assert run.stats == {"total": 3, "successful": 2, "failed": 1, "total_chunks": 2}
    assert [(r.content, r.error) for r in run.quarantine.collect()] == [("{oops", "malformed response")]


def test_source_is_read_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def touch(it):
        for b in it:
            reads.add(len(b))
            yield b
    env = _envelopes(spark, [(i, "note") for i in range(50)]).mapInPandas(touch, "content struct<id:long,note:string>, "
                                                                           "metadata struct<source_type:string,source_uri:string>")
    run = ingest_records(env, "id", DocumentLog(spark, scratch_path(spark, "test-once")))
    assert run.chunks.count() == 50 and run.lineage.count() == 50 and run.quarantine.count() == 0
    assert reads.value == 50
