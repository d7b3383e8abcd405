"""Objects are read by as many tasks as their bytes ask for, whatever their number; keyword scores are
added up where the documents lie."""
import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import term_index as ti
from corpusflow.operators.index import build_text_index
from corpusflow.operators.ingest import ingest_objects
from corpusflow.operators.retrieval import bm25_search, query_terms
from corpusflow.session import scratch_path
from corpusflow.sources import files


def _land(tmp_path, n):
    for i in range(n):
        os.makedirs(tmp_path / f"bucket/f{i % 3}", exist_ok=True)
        (tmp_path / f"bucket/f{i % 3}/{i}.txt").write_bytes(b"x" * (i % 5))
    return str(tmp_path / "bucket")


def test_tasks_do_not_grow_with_the_number_of_objects(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "READ_BYTES", 7)  # several batches a task, some objects in a batch of their own
    root = _land(tmp_path, 1000)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # one file a split
    try:
        d = files.read_objects(spark, root)
        assert d.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = d.select("metadata.key", "metadata.size", "content").collect()
    assert sorted((r.key, r.size, bytes(r.content)) for r in got) == \
        sorted((f"f{i % 3}/{i}.txt", i % 5, b"x" * (i % 5)) for i in range(1000))
    monkeypatch.setattr(files, "TASK_BYTES", 10)  # many bytes are dealt to more tasks
    assert files.read_objects(spark, root).rdd.getNumPartitions() == 200


def test_a_run_sees_the_objects_of_its_listing(spark, tmp_path):
    root = _land(tmp_path, 10)
    r = ingest_objects(spark, root, mask=False)
    (tmp_path / "bucket/f0/late.txt").write_bytes(b"late")
    assert r.stats.first().total == 8 and r.chunks.count() == 8  # two are empty
    with pytest.raises(FileNotFoundError):
        files.read_objects(spark, str(tmp_path / "absent"))


def test_names_that_sparks_readers_take_are_read(spark, tmp_path):
    keys = {"_k=v/a.txt", "_metadata.txt", "b.txt"}
    for key in keys | {"_no/c.txt", ".d.txt", "e.txt._COPYING_"}:
        os.makedirs((tmp_path / "bucket" / key).parent, exist_ok=True)
        (tmp_path / "bucket" / key).write_bytes(b"1")
    d = files.read_objects(spark, str(tmp_path / "bucket"))
    assert {r.key for r in d.select(F.col("metadata.key")).collect()} == keys


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"the w{i % 7} " * (1 + i % 3), None if i % 5 == 4 else ["public", "internal"][i % 2]) for i in range(200)]
    rows += [(7, "the w7 again", "public")]  # an id that comes twice
    return spark.createDataFrame(rows, "doc_id long, text string, security_clearance string")


@pytest.fixture(scope="module")
def index(spark, docs):
    return ti.build_term_index(docs, scratch_path(spark, "test-term-index"), buckets=8)


def _queries(spark):
    return spark.createDataFrame([(1, "the w1", "viewer"), (2, "w2 w3 the again", None)],
                                 "query_id long, query_text string, user_role string")


def test_pairs_of_query_and_document_are_not_shuffled(spark, index):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        ti.term_index_scores(index, query_terms(_queries(spark)), 5, small=True).explain()
    assert "hashpartitioning(doc_id" in buf.getvalue()
    assert not re.search(r"hashpartitioning\(query_id#\d+L?, doc_id", buf.getvalue())


def test_filter_values_are_stored_once_and_nulls_kept(spark, docs, index):
    assert sorted(str(r.security_clearance) for r in index.metas.collect()) == ["None", "internal", "public"]
    assert "security_clearance" not in index.blocks.schema["postings"].dataType.elementType.names
    key = lambda df: sorted((r.query_id, r.bm25_rank, r.doc_id, round(r.bm25_raw, 9)) for r in df.collect())
    for unrestricted in (False, True):
        want = bm25_search(build_text_index(docs), _queries(spark), 300, docs=docs, unrestricted=unrestricted)
        assert key(bm25_search(index, _queries(spark), 300, docs=docs, unrestricted=unrestricted)) == key(want)


def test_terms_of_a_bucket_lie_together(spark, index):
    terms = index.terms.select("term", "bucket", "df", F.xxhash64("term").alias("h")).orderBy("h").collect()
    assert [t.bucket for t in terms] == sorted(t.bucket for t in terms) and all(0 <= t.bucket < 8 for t in terms)
    assert {t.term: t.df for t in terms}["the"] == 201
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != str(2 ** 31 - 1)  # put back
