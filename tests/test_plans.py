"""Plan-shape regression tests for the scale properties the design relies on."""
import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as E
from corpusflow.operators import chunking as ch
from corpusflow.operators.index import build_text_index
from corpusflow.operators.masking import mask_text_df
from corpusflow.operators.retrieval import bm25_search
from corpusflow.session import scratch_path
from tests.conftest import SF001


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")


def test_per_document_operators_do_not_shuffle(spark):
    d = _docs(spark)
    for df in (ch.chunk_fixed(d), ch.chunk_semantic(d), ch.chunk_sentences(d), mask_text_df(d),
               ch.chunk_context_aware(d.withColumn("text", ch.sectioned_text(F.col("text"))))):
        plan = _plan(df)
        assert "Exchange" not in plan, plan
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_bm25_plan_broadcasts_terms_and_limits_before_shuffle(spark):
    q = spark.read.parquet(f"{SF001}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    # lazy index: query-term postings are checkpointed, the top-k is limited per
    # task before the exchange
    plan = _plan(bm25_search(build_text_index(_docs(spark)), q, 10, unrestricted=True))
    assert "BroadcastHashJoin" in plan
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # materialised index: the term semi-join is a broadcast join on the postings scan
    idx = build_text_index(_docs(spark), path=scratch_path(spark, "test-plan-index"))
    plan = _plan(bm25_search(idx, q, 10, unrestricted=True))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_scan_pruning_and_pushdown(spark):
    plan = _plan(E.queries()["table_scan"](spark, SF001))
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double,c_mktsegment:string>" in plan
    plan = _plan(E.queries()["shipment_logs"](spark, SF001))
    assert "GreaterThanOrEqual(o_orderdate" in plan
