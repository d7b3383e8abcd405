from pyspark.sql import functions as F

from corpusflow.operators import governance as gv
from corpusflow.plans import fixtures as fx
from corpusflow.session import scratch_path
from corpusflow.sources import api, files
from corpusflow.sources import messages as msg
from corpusflow.streaming.runner import read_back, run_available
from tests.conftest import SF001


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_equals_batch(spark):
    path = fx.land_messages(spark, SF001, 100)
    cols = ["metadata.partition", "metadata.offset", "sensor_id", "sensor_type", "value"]
    ok_b, bad_b = msg.iot_readings(msg.decode_messages(msg.read_messages(spark, path, streaming=False)),
                                   ["view", "click"])
    ok_s, _ = msg.iot_readings(msg.decode_messages(msg.read_messages(spark, path, files_per_trigger=3)),
                               ["view", "click"])
    out = run_available(ok_s.select(*cols), "test-iot")
    assert _rows(read_back(spark, out), ["partition", "offset", "sensor_id", "sensor_type", "value"]) == \
        _rows(ok_b, cols)
    # non-object messages are quarantined, not lost
    total = msg.read_messages(spark, path, streaming=False).count()
    kinds = msg.decode_messages(msg.read_messages(spark, path, streaming=False)).groupBy("content_kind").count()
    assert sum(r["count"] for r in kinds.collect()) == total
    assert bad_b.count() == sum(r["count"] for r in kinds.collect() if r.content_kind != "object")


def test_object_listing_cap_before_suffix(spark):
    root = scratch_path(spark, "test-objs") + "/landing"
    df = spark.createDataFrame([("a/1.txt", "x"), ("a/2.pdf", "yy"), ("b/3.txt", "zzz")], "key string, data string")
    assert files.land_objects(df, root) == 3
    assert sorted(r.key for r in files.list_objects(spark, root, suffix=".txt", max_keys=None).collect()) == \
        ["a/1.txt", "b/3.txt"]
    # max_keys counts objects before the suffix test
    assert [r.key for r in files.list_objects(spark, root, suffix=".txt", max_keys=2).collect()] == ["a/1.txt"]
    env = files.read_objects(spark, root, prefix="b").collect()
    assert env[0].metadata.key == "b/3.txt" and env[0].metadata.source_uri == "s3://landing/b/3.txt"


def test_custom_api_shapes(spark):
    resp = spark.createDataFrame([
        (1, '{"data": {"items": [{"id": "a"}, {"id": "b"}]}}'),
        (2, '{"data": {"items": {"id": "c"}}}'),
        (3, '{"other": 1}'),
        (4, '[1, 2]'),
    ], "response_id long, value string")
    got = sorted((r.response_id, r.item_index, r.metadata.source_uri)
                 for r in api.custom_api(resp, "x", "t", "data.items", "id").collect())
    assert got == [(1, 0, "api://x/a"), (1, 1, "api://x/b"), (2, 0, "api://x/c"),
                   (3, 0, "api://x/unknown"), (4, 0, "api://x/unknown")]


def test_custom_api_malformed_responses_are_set_aside(spark):
    resp = spark.createDataFrame([('{"id": "a"}',), ("<html>502</html>",), (None,), ('{"id": "a"}',)], "value string")
    got = api.custom_api(resp, "x", "t", id_field="id").collect()
    assert [r.document_id for r in got] == ["a", "a"] and len({r.response_id for r in got}) == 1
    assert [r.value for r in api.malformed_responses(resp).collect()] == ["<html>502</html>", None]


def test_api_documents_keep_all_fields(spark):
    path = scratch_path(spark, "test-fields")
    api.land_json(spark.createDataFrame([('{"ports": [{"port_code": "P1", "berths": 7}]}',)], "json string"), path)
    r = api.port_congestion(api.read_responses(spark, path, api.PORTS_SCHEMA))
    assert r.select(F.try_variant_get("content", "$.berths", "int").alias("n")).first().n == 7
    path = scratch_path(spark, "test-routes")
    api.land_json(spark.createDataFrame([('{"routes": [{"origin": "A", "destination": "B", "days": 3}]}',)], "json string"), path)
    r = api.shipping_rates(api.read_responses(spark, path, api.ROUTES_SCHEMA))
    assert r.select("origin", F.try_variant_get("content", "$.days", "int").alias("n")).collect() == [("A", 3)]


def test_upsert_idempotent(spark):
    store = gv.SnapshotTable(spark, scratch_path(spark, "test-upsert"))
    b1 = spark.createDataFrame([("1-0", "a", 1), ("1-1", "b", 1)], "chunk_id string, content string, batch_id int") \
        .withColumn("ingest_ts", F.lit("2024-01-01").cast("timestamp"))
    b2 = spark.createDataFrame([("1-1", "B", 2)], "chunk_id string, content string, batch_id int") \
        .withColumn("ingest_ts", F.lit("2024-02-01").cast("timestamp"))
    gv.upsert_snapshot(store, b1)
    v = gv.upsert_snapshot(store, b2)
    first = sorted((r.chunk_id, r.content) for r in store.read().collect())
    assert first == [("1-0", "a"), ("1-1", "B")]
    # re-running the same version is a no-op; re-applying b2 changes nothing
    assert not store.committed("s", 0)
    store.commit("s", 0)
    assert store.committed("s", 0) and not store.committed("s", 1) and not store.committed("t", 0)
    assert store.current_version() == v
    gv.upsert_snapshot(store, b2)
    assert sorted((r.chunk_id, r.content) for r in store.read().collect()) == first


def test_poll_numbering(spark):
    path = scratch_path(spark, "test-polls")
    spark.createDataFrame([("e", "2024-01-02", '{"a":1}'), ("e", "2024-01-01", "oops"), ("e", "2024-01-03", '{"a":2}')],
                          "endpoint string, poll_time string, value string").coalesce(1).write.json(path)
    polls = spark.readStream.schema("endpoint string, poll_time string, value string").json(path)
    numbered, _ = api.poll_endpoint(polls)
    out = read_back(spark, run_available(numbered, "test-polls"))
    assert sorted((r.poll_number, r.poll_time) for r in out.collect()) == [(1, "2024-01-02"), (2, "2024-01-03")]


def test_ingest_objects_quarantine_and_stats(spark):
    from corpusflow.operators.ingest import ingest_objects
    root = scratch_path(spark, "test-ingest") + "/landing"
    df = spark.createDataFrame([("a/1.txt", bytearray(b"call 555-123-4567 now")), ("a/2.pdf", bytearray(b"%PDF")),
                                ("a/3.txt", bytearray(b"\xff\xfe bad")), ("a/4.md", bytearray(b""))],
                               "key string, data binary")
    files.land_objects(df, root)
    store = gv.SnapshotTable(spark, scratch_path(spark, "test-ingest-store"))
    r = ingest_objects(spark, root, store=store, extensions=[".txt", ".md", ".pdf"], run_id="t")
    q = sorted((x.key, x.error) for x in r.quarantine.collect())
    assert q == [("a/2.pdf", "no parser for route pdf"), ("a/3.txt", "invalid_utf8")]
    s = r.stats.first()
    # zero-length objects yield no file splits, so file sources never see them
    assert (s.total, s.successful, s.failed, s.total_chunks) == (3, 1, 2, 1)
    c = r.chunks.collect()
    assert [x.content for x in c] == ["call ******4567 now"] and c[0].pii_entities_count == 1
    assert r.lineage.first().chunk_count == 1 and r.version == 0


def test_consume_messages_cap(spark):
    path = fx.land_messages(spark, SF001, 100)
    got = msg.consume_messages(spark, path, max_messages=7).collect()
    assert len(got) == 7
    assert sorted((r.metadata.partition, r.metadata.offset) for r in got) == [(0, i) for i in range(7)]


def test_landed_responses_quarantine(spark):
    path = scratch_path(spark, "test-resp")
    spark.createDataFrame([('{"ports": [{"port_code": "P1", "country": "X"}]}',), ("<html>502</html>",)], "value string") \
        .write.text(path)
    good, bad = api.read_responses_checked(spark, path, api.PORTS_SCHEMA)
    assert [r.metadata.port_code for r in api.port_congestion(good).collect()] == ["P1"]
    assert [r.raw_response for r in bad.collect()] == ["<html>502</html>"]


def test_versioned_index_hot_document(spark):
    # one document with a long history split over many slices, plus a cold one
    rows = [(1, f"v{i // 3}", i) for i in range(300)] + [(2, "a", 0), (2, "a", 1), (2, "b", 2), (2, "a", 3)]
    df = spark.createDataFrame(rows, "doc_id long, content string, t long") \
        .withColumn("ingest_ts", F.timestamp_seconds("t")).drop("t")
    got = gv.versioned_index(df, slices=16).orderBy("doc_id", "version").collect()
    hot = [r for r in got if r.doc_id == 1]
    assert [r.version for r in hot] == list(range(1, 101))
    assert [r.content for r in hot] == [f"v{i}" for i in range(100)]
    assert all(a.valid_to == b.valid_from for a, b in zip(hot, hot[1:])) and hot[-1].is_current
    cold = [(r.version, r.content, r.is_current) for r in got if r.doc_id == 2]
    assert cold == [(1, "a", False), (2, "b", False), (3, "a", True)]
