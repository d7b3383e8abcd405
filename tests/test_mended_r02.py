"""Findings of the second review on the reference's operators."""
from corpusflow.session import scratch_path
from corpusflow.sources import files
from tests.conftest import SF001


def test_every_landed_object_is_ingested(spark):
    import __spark_entry__ as E
    keys = {r.key for r in E.queries()["ingest_all_objects"](spark, SF001).select("key").distinct().collect()}
    ids = {r.doc_id for r in spark.read.parquet(f"{SF001}/documents.parquet").where("length(text) > 0").select("doc_id").collect()}
    assert {int(k.rsplit("_", 1)[1].split(".")[0]) for k in keys} == ids
    assert {k.rsplit(".", 1)[1] for k in keys} == {"txt", "pdf", "docx", "md"}


def test_binary_docx_is_quarantined(spark):
    from corpusflow.operators.ingest import ingest_objects
    root = scratch_path(spark, "test-docx") + "/landing"
    files.land_objects(spark.createDataFrame([("a/1.docx", bytearray(b"PK\x03\x04\xff\xfe")), ("a/2.docx", bytearray(b"plain"))], "key string, data binary"), root)
    r = ingest_objects(spark, root, run_id="docx")
    assert [(x.key, x.error) for x in r.quarantine.collect()] == [("a/1.docx", "invalid_utf8")]
    assert [x.content for x in r.chunks.collect()] == ["plain"]
