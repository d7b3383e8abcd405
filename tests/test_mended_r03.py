"""Sections in linear time, every chunker in ingest, revisions without stale chunks."""

import time

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import chunking as ch
from corpusflow.operators.document_log import DocumentLog
from corpusflow.operators.ingest import ingest_objects
from corpusflow.session import scratch_path
from corpusflow.sources.files import land_objects

TEXT = "Intro line one. And two.\n# First\n" + "Some body text here. " * 40 + "\n\nNext paragraph.\n# Second\nshort\n"


def _land(spark, root, texts):
    land_objects(spark.createDataFrame([(k, t.encode()) for k, t in texts.items()], "key string, data binary"), root)


@pytest.mark.parametrize("name", sorted(ch.STRATEGIES))
def test_every_chunker_runs_in_ingest(spark, name):
    root = scratch_path(spark, "test-objects")
    _land(spark, root, {"a.txt": TEXT, "b.txt": "tiny"})
    result = ingest_objects(spark, root, chunker=ch.get_chunker(name, id_col="document_id"), mask=False)
    rows = result.chunks.orderBy("document_id", "chunk_index").collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.document_id, []).append(r)
    assert len(by_doc) == 2
    for doc, chunks in by_doc.items():
        assert [c.chunk_index for c in chunks] == list(range(len(chunks)))
        assert [c.chunk_id for c in chunks] == [f"{doc}-{i}" for i in range(len(chunks))]
        assert all(c.content for c in chunks)
    assert result.stats.first().total_chunks == len(rows)


def test_ingest_of_a_shorter_revision_leaves_no_old_chunks(spark):
    log = DocumentLog(spark, scratch_path(spark, "test-ingest-log"))
    chunker = ch.get_chunker("fixed", chunk_size=10, chunk_overlap=0, id_col="document_id")
    first = scratch_path(spark, "test-objects")
    _land(spark, first, {"a.txt": "x" * 35, "b.txt": "y" * 25})
    ingest_objects(spark, first, chunker=chunker, store=log, run_id="one", mask=False)
    keys = lambda: sorted((r.key, r.chunk_index, r.content) for r in log.read().select(F.col("metadata.key").alias("key"), "chunk_index", "content").collect())
    assert len(keys()) == 7
    _land(spark, first, {"a.txt": "z" * 12})  # the same object, shorter
    ingest_objects(spark, first, chunker=chunker, store=log, run_id="two", mask=False)
    assert keys() == [("a.txt", 0, "z" * 10), ("a.txt", 1, "zz"), ("b.txt", 0, "y" * 10), ("b.txt", 1, "y" * 10), ("b.txt", 2, "y" * 5)]


def test_sections_take_linear_time(spark):
    def seconds(n):
        text = "\n".join(f"# Title {i}\nbody of {i}" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        t0 = time.time()
        assert ch.sections_table(df).count() == n
        return time.time() - t0
    seconds(200)
    small, large = seconds(4000), seconds(16000)
    assert large < 6 * max(small, 0.5)
