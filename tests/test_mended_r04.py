"""Faults of the third round's findings: landed message files, upserts as layers, keyword scores."""
import glob

from pyspark.sql import functions as F

from corpusflow.operators import governance as gv
from corpusflow.plans import fixtures as fx
from corpusflow.session import scratch_path
from tests.conftest import SF001


def test_landed_batches_are_whole_in_fewer_files(spark):
    path = fx.land_messages(spark, SF001, 10)
    files = spark.read.schema("partition int, offset long").json(path).select(
        "partition", F.floor(F.col("offset") / 10).alias("b"), F.col("_metadata.file_name").alias("f"))
    assert files.select("partition", "b").distinct().count() == files.distinct().count() == 100
    assert files.select("f").distinct().count() <= spark.sparkContext.defaultParallelism


def _rows(spark, rows):
    return spark.createDataFrame(rows, "chunk_id string, content string, batch_id int, ingest_ts timestamp_ntz")


def test_an_upsert_writes_its_own_rows_alone(spark):
    import datetime as dt
    day = lambda n: dt.datetime(2024, 1, n)
    store = gv.SnapshotTable(spark, scratch_path(spark, "layers"))
    gv.upsert_snapshot(store, _rows(spark, [("a", "1", 1, day(1)), ("b", "1", 1, day(1)), ("b", "0", 0, day(1)), ("c", "1", 1, day(9)), (None, "n", 1, day(1))]))
    gv.upsert_snapshot(store, _rows(spark, [("b", "2", 2, day(2)), ("c", "old", 2, day(2)), ("d", "2", 2, None), (None, "m", 2, day(2))]))
    gv.upsert_snapshot(store, _rows(spark, [("d", "3", 3, day(3))]))
    assert sum(spark.read.parquet(f).count() for f in glob.glob(store.base.replace("file:", "") + "/__layer=*")) == 10
    want = {("a", "1"), ("b", "2"), ("c", "1"), ("d", "3"), (None, "n"), (None, "m")}
    rows = store.read().collect()
    assert {(r.chunk_id, r.content) for r in rows} == want and len(rows) == len(want)
    assert store.compact() == 3 and store.current_version() == 3
    gv.upsert_snapshot(store, _rows(spark, [("a", "4", 4, day(4))]))
    assert {(r.chunk_id, r.content) for r in store.read().collect()} == (want - {("a", "1")}) | {("a", "4")}


def test_many_repeated_keys_are_joined_by_hash(spark, monkeypatch):
    monkeypatch.setattr(gv, "BROADCAST_MAX_ROWS", 3)
    store = gv.SnapshotTable(spark, scratch_path(spark, "layers"))
    old = spark.range(50).select(F.col("id").cast("string").alias("chunk_id"), F.lit("x").alias("content"), F.lit(1).alias("batch_id"),
                                 F.lit("2024-01-01").cast("timestamp").alias("ingest_ts"))
    gv.upsert_snapshot(store, old.unionByName(old))
    gv.upsert_snapshot(store, old.where("chunk_id < '3'").withColumn("batch_id", F.lit(2)))
    rows = store.read().collect()
    assert len(rows) == len({r.chunk_id for r in rows}) == 50
    assert all((r.batch_id == 2) == (r.chunk_id < "3") for r in rows)


def test_records_whose_id_is_theirs_alone_are_not_grouped(spark):
    from corpusflow.operators.sizing import split_repeated
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 1)], "document_id string, n int")
    lone, repeated = split_repeated(df, ["document_id"], scratch_path(spark, "ids"))
    assert sorted((r.document_id or "", r.n) for r in lone.collect()) == [("", 1), ("a", 1)]
    assert sorted((r.document_id, r.n) for r in repeated.collect()) == [("b", 1), ("b", 2)]
    assert split_repeated(df.where("n = 1"), ["document_id"], scratch_path(spark, "ids"))[1] is None
