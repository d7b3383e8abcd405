"""The index by term: blocks, searches against the plain index, skipping, pruning, edge cases."""

import contextlib
import io
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import term_index as ti
from corpusflow.operators.index import build_text_index
from corpusflow.operators.retrieval import bm25_search, query_terms
from corpusflow.session import scratch_path

CLEARANCE = ["public", "internal", "confidential", "restricted"]


def _rows(n=500):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (1 + i) for i in range(60)]
    rows = [(i, "the " * rng.randrange(1, 9) + " ".join(rng.choices(words, weights, k=rng.randrange(40))), CLEARANCE[i % 4]) for i in range(n)]
    return rows + [(n, None, "public"), (n + 1, "", "public"), (n + 2, "?!", "public"), (n + 3, "rare " * 5000, "public")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), "doc_id long, text string, security_clearance string").repartition(4).cache()


@pytest.fixture(scope="module")
def index(spark, docs):
    return ti.build_term_index(docs, scratch_path(spark, "test-term-index"), buckets=8)


def _queries(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "query_id long, query_text string")


def test_blocks_hold_every_posting_once_by_falling_impact(spark, index):
    want = Counter()
    for i, text, _ in _rows():
        toks = [t for t in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]
        for term, tf in Counter(toks).items():
            want[(term, i, tf, len(toks))] += 1
    blocks = index.blocks.collect()
    got = Counter((b.term, p.doc_id, p.tf, p.dl) for b in blocks for p in b.postings)
    assert got == want
    assert all(0 < len(b.postings) <= ti.BLOCK for b in blocks)
    assert sum(b.term == "the" for b in blocks) > 1
    assert index.n == 504 and math.isclose(index.avg_dl, sum(d for (_, d) in {(i, d) for (_, i, _, d) in want}) / 504)
    weight = lambda p: p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / index.avg_dl))
    for b in blocks:
        impacts = [weight(p) for p in b.postings]
        assert math.isclose(b.bound, impacts[0]) and all(x >= y - 1e-12 for x, y in zip(impacts, impacts[1:]))
    terms = {t.term: (t.df, t.best) for t in index.terms.collect()}
    assert terms["the"][0] == 500 and math.isclose(terms["rare"][1], max(b.bound for b in blocks if b.term == "rare"))


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_same_results_as_the_plain_index(spark, docs, index, k):
    q = _queries(spark, ["the w1 w2", "w50 the", "nothing here", "", None, "rare the w0", "w0 w0 w1 w3 w7 w9 the"])
    plain = bm25_search(build_text_index(docs), q, k, docs=docs, unrestricted=True)
    got = bm25_search(index, q, k, docs=docs, unrestricted=True)
    key = lambda df: sorted((r.query_id, r.bm25_rank, r.doc_id, round(r.bm25_raw, 9), round(r.bm25_score, 9)) for r in df.collect())
    assert key(got) == key(plain)


def test_filters_on_the_postings_hold_before_ranking(spark, docs, index):
    q = _queries(spark, ["the w1", "w2 the"]).withColumn("user_role", F.when(F.col("query_id") == 0, "viewer"))
    got = bm25_search(index, q, 20, docs=docs).collect()
    assert got and all(r.doc_id % 4 == 0 or r.doc_id >= 500 for r in got)
    key = lambda df: sorted((r.query_id, r.bm25_rank, r.doc_id, round(r.bm25_raw, 9)) for r in df.collect())
    assert key(bm25_search(index, q, 20, docs=docs)) == key(bm25_search(build_text_index(docs), q, 20, docs=docs))


def test_blocks_below_the_kth_score_are_skipped(spark, index):
    q = query_terms(_queries(spark, ["the"]))
    skips = {r.block: r.skip for r in ti.term_index_scores(index, q, 1, skipped=True).collect()}
    assert skips == {0: False, 1: True}
    # with as many results as postings nothing can be skipped
    assert not any(r.skip for r in ti.term_index_scores(index, q, 500, skipped=True).collect())


def test_the_plan_reads_the_terms_buckets_alone(spark, index):
    q = query_terms(_queries(spark, ["w1"]))
    blocks, terms, wanted = ti.matching_blocks(index, q)
    assert len(wanted) == 1
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        blocks.explain("formatted")
    assert "PartitionFilters: [" in buf.getvalue() and f"(bucket" in buf.getvalue()
    assert {r.bucket for r in blocks.select("bucket").distinct().collect()} == set(wanted)


def test_empty_index_and_queries(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    index = ti.build_term_index(empty, scratch_path(spark, "test-term-index"))
    q = _queries(spark, ["the"])
    assert bm25_search(index, q, 3, unrestricted=True).collect() == []
    index = ti.build_term_index(spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string"), scratch_path(spark, "test-term-index"))
    assert bm25_search(index, q.limit(0), 3, unrestricted=True).collect() == []


def test_null_clearance_never_opens_documents(spark, docs, index):
    q = _queries(spark, ["the w1"]).withColumns({"user_role": F.lit("viewer"), "allowed_clearance": F.lit(None).cast("array<string>")})
    for ix in (index, build_text_index(docs)):
        got = bm25_search(ix, q, 50, docs=docs).collect()
        assert got and all(r.doc_id % 4 == 0 or r.doc_id >= 500 for r in got)
        none = bm25_search(ix, q.drop("user_role"), 50, docs=docs).collect()
        assert none and all(r.doc_id % 4 == 0 or r.doc_id >= 500 for r in none)
