"""Findings of the first review: slices, replays, access control, masking before chunking."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusflow.operators import governance as gv
from corpusflow.operators.ingest import ingest_messages_batch
from corpusflow.operators.retrieval import _active_filters, filter_predicate, similar_documents, vector_search
from corpusflow.session import scratch_path


def test_versions_without_exchange_reuse(spark):
    v = spark.range(60000).select((F.col("id") % 200).alias("doc_id"), (F.col("id") / 200).cast("long").alias("t"))
    v = v.select("doc_id", F.timestamp_seconds("t").alias("ingest_ts"), F.concat("doc_id", F.lit("-"), F.floor(F.col("t") / 3)).alias("content"))
    w = Window.partitionBy("doc_id").orderBy("ingest_ts")
    want = v.withColumn("p", F.lag("content").over(w)).where("p IS NULL OR p <> content").withColumn("version", F.row_number().over(w))
    want = sorted(map(tuple, want.select("doc_id", "ingest_ts", "version").collect()))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = gv.versioned_index(v, slices=16)
        assert sorted(map(tuple, got.select("doc_id", "ingest_ts", "version").collect())) == want
        assert got.where("is_current").count() == 200
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_ties_at_one_time_count_once(spark):
    v = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 5, "b"), (1, 6, "c")], "doc_id int, t long, content string")
    got = gv.versioned_index(v.withColumn("ingest_ts", F.timestamp_seconds("t"))).orderBy("version").collect()
    assert [r.version for r in got] == [1, 2] and got[1].content == "c"


def test_filters_on_missing_columns_are_errors(spark):
    q = spark.createDataFrame([(1, ["public"])], "query_id int, allowed_clearance array<string>")
    with pytest.raises(ValueError):
        _active_filters(q, spark.createDataFrame([(1,)], "doc_id int"))
    with pytest.raises(ValueError):
        _active_filters(q, None)


def test_empty_clearance_allows_nothing(spark):
    rows = spark.createDataFrame([(1, [], "public"), (2, ["public"], "public"), (3, ["public"], "restricted"), (4, None, "restricted")],
                                 "q int, allowed_clearance array<string>, security_clearance string")
    kept = rows.where(filter_predicate([("allowed_clearance", "security_clearance", "clear")]))
    assert sorted(r.q for r in kept.collect()) == [2, 4]


def test_vector_search_by_string_ids_without_a_role_reads_public_only(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0], "public"), ("b", [1.0, 0.1], "restricted"), ("c", [0.0, 1.0], "public")],
                              "doc_id string, embedding array<double>, security_clearance string")
    q = spark.createDataFrame([("q1", [1.0, 0.0])], "query_id string, qvec array<double>")
    assert [r.doc_id for r in vector_search(q, v, k=3).orderBy("sem_rank").collect()] == ["a", "c"]
    assert [r.doc_id for r in vector_search(q, v, k=3, unrestricted=True).orderBy("sem_rank").collect()] == ["a", "b", "c"]
    got = similar_documents(v, k=1, queries=spark.createDataFrame([("c", "viewer"), ("a", "admin")], "query_id string, user_role string"))
    assert {(r.query_id, r.doc_id) for r in got.collect()} == {("c", "a"), ("a", "b")}


def test_sensor_messages_keep_all_fields(spark):
    value = '{"sensor_id": "s1", "sensor_type": "t", "value": 1.5, "location": "x", "battery": 7, "tags": {"k": null}, "none": null}'
    m = spark.createDataFrame([("k", value, "iot", 0, 3)], "key string, value string, topic string, partition int, offset long")
    store = gv.SnapshotTable(spark, scratch_path(spark, "fields"))
    ingest_messages_batch(m.withColumn("timestamp", F.current_timestamp()), 0, store, mask=False)
    lines = store.read().first().content.split("\n")
    assert lines[:4] == ["sensor_id: s1", "sensor_type: t", "value: 1.5", "location: x"]
    assert lines[4:] == ["battery: 7", "none: None", 'tags: {"k":null}']
