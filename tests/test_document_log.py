"""The index log: revisions replace whole documents, old files stay as they are, a crash changes nothing."""

import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from corpusflow.operators.chunking import chunk_fixed
from corpusflow.operators.document_log import DocumentLog
from corpusflow.session import scratch_path


def _chunks(spark, texts, size=10):
    docs = spark.createDataFrame(list(texts.items()), "document_id string, text string")
    return chunk_fixed(docs, size, 0, id_col="document_id"), docs


def _content(log, version=None):
    out = {}
    for r in log.read(version).orderBy("document_id", "chunk_index").collect():
        out[r.document_id] = out.get(r.document_id, "") + r.content
    return out


def _files(log):
    root = urlparse(log.base).path
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names}


@pytest.fixture()
def log(spark):
    log = DocumentLog(spark, scratch_path(spark, "test-log"), buckets=4)
    assert log.read() is None and log.current_version() is None and log.compact() is None
    assert log.replace(*_chunks(spark, {f"d{i}": f"text of document {i} " * 3 for i in range(20)})) == 0
    return log


def test_shorter_and_longer_revisions_leave_nothing_behind(spark, log):
    before = _files(log)
    assert log.replace(*_chunks(spark, {"d1": "short", "d2": "a longer text " * 20, "new": "new one"})) == 1
    after = _files(log)
    assert before.items() <= after.items()  # no earlier file was touched
    now = _content(log)
    assert now["d1"] == "short" and now["d2"] == "a longer text " * 20 and now["new"] == "new one" and len(now) == 21
    assert now["d3"] == "text of document 3 " * 3
    assert _content(log, 0)["d1"] == "text of document 1 " * 3  # the old version can still be read


def test_a_document_without_chunks_is_gone(spark, log):
    log.replace(*_chunks(spark, {"d1": "", "d2": "kept"}))
    assert "d1" not in _content(log) and _content(log)["d2"] == "kept"
    log.delete(spark.createDataFrame([("d2",), ("unknown",)], "document_id string"))
    assert "d2" not in _content(log) and len(_content(log)) == 18
    log.replace(*_chunks(spark, {"d1": "back"}))
    assert _content(log)["d1"] == "back"


def test_compaction_keeps_the_rows_in_one_layer(spark, log):
    log.replace(*_chunks(spark, {"d1": "short"}))
    log.delete(spark.createDataFrame([("d5",)], "document_id string"))
    want = _content(log)
    assert log.compact() == 3 and len(log.layers()) == 1 and _content(log) == want
    log.replace(*_chunks(spark, {"d5": "again"}))
    assert _content(log) == want | {"d5": "again"}


def test_a_crash_before_the_manifest_leaves_the_old_version(spark, log, monkeypatch):
    want = _content(log)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(log, "_publish", crash)
        with pytest.raises(RuntimeError):
            log.replace(*_chunks(spark, {"d1": "half"}))
    assert log.current_version() == 0 and _content(log) == want
    assert log.replace(*_chunks(spark, {"d1": "whole"})) == 1
    assert _content(log) == want | {"d1": "whole"}


def test_two_writers_of_one_version(spark, log):
    with pytest.raises(RuntimeError):
        log._publish(0, [])
    assert len(_content(log)) == 20


def test_lookup_reads_the_documents_buckets(spark, log):
    log.replace(*_chunks(spark, {"d1": "short"}))
    got = log.read(documents=["d1", "d7"])
    assert {(r.document_id, r.content) for r in got.where(F.col("chunk_index") == 0).collect()} == {("d1", "short"), ("d7", "text of do")}
    assert "bucket" in got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters", 1)[1][:60]


def test_new_columns_and_reserved_names(spark, log):
    rows, docs = _chunks(spark, {"d1": "short"})
    log.replace(rows.withColumn("extra", F.lit(1)), docs)
    assert {r.extra for r in log.read().where("document_id = 'd2'").collect()} == {None}
    with pytest.raises(ValueError):
        log.replace(rows.withColumn("bucket", F.lit(1)), docs)
    with pytest.raises(ValueError):
        log.layers(9)
