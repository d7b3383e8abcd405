"""Object listing: empty objects, prefixes, folders of any depth."""
import os

from pyspark.sql import functions as F

from corpusflow.operators.ingest import ingest_objects
from corpusflow.sources import files
from corpusflow.sources.listing import listing

BODIES = {"a/one.txt": b"one", "a/none.txt": b"", "a/b/c/deep.md": b"deep", "a/b/c/void.pdf": b"", "top.txt": b"",
          "ab/other.txt": b"other"}


def _land(tmp_path):
    root = tmp_path / "bucket"
    for key, body in {**BODIES, "_hidden/x.txt": b"x", "a/.part": b"y"}.items():
        os.makedirs(os.path.dirname(root / key), exist_ok=True)
        (root / key).write_bytes(body)
    return str(root)


def test_every_object_is_listed_once(spark, tmp_path):
    root = _land(tmp_path)
    for folders in (1, 2, 3, 256):  # however many levels the driver opens
        rows = listing(spark, root, folders=folders).collect()
        assert sorted((r.key, r.size) for r in rows) == sorted((k, len(v)) for k, v in BODIES.items())
    assert all(r.last_modified is not None for r in rows)
    assert {r.key for r in files.list_objects(spark, root, suffix=".txt").collect()} == {k for k in BODIES if k.endswith(".txt")}
    for prefix in ("a", "a/", "a/b", "a/b/c/v", "nothing/"):
        want = {k for k in BODIES if k.startswith(prefix)}
        assert {r.key for r in files.list_objects(spark, root, prefix).collect()} == want
        if want - {k for k, v in BODIES.items() if not v}:
            assert {r.key for r in files.read_objects(spark, root, prefix).select("metadata.key").collect()} == want


def test_bodies_of_empty_objects(spark, tmp_path):
    root = _land(tmp_path)
    got = {r.key: bytes(r.content) for r in files.read_objects(spark, root).select("metadata.key", "content").collect()}
    assert got == BODIES
    assert listing(spark, str(tmp_path / "absent")).count() == 0


def test_empty_objects_are_ingested(spark, tmp_path):
    r = ingest_objects(spark, _land(tmp_path), empty_objects=True)
    assert {x.key for x in r.quarantine.collect()} == {"a/b/c/void.pdf"}
    s = r.stats.first()
    assert (s.total, s.successful, s.failed, s.total_chunks) == (6, 5, 1, 3)
    assert r.chunks.select(F.count_distinct("document_id")).first()[0] == 3
