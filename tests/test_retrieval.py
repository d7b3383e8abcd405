import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import retrieval as rt
from corpusflow.operators.index import build_text_index, load_text_index, save_text_index
from corpusflow.operators.sizing import minmax_normalize
from corpusflow.session import scratch_path


def test_fusion_golden(spark):
    # two ranked lists sharing one document (weights .7/.3)
    sem = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.8)], "query_id long, doc_id long, s double")
    bm = spark.createDataFrame([(1, 2, 0.85), (1, 3, 0.75)], "query_id long, doc_id long, s double")
    sem = minmax_normalize(sem, "s", "sem_score")
    bm = minmax_normalize(bm, "s", "bm25_score")
    got = {r.doc_id: round(r.combined_score, 9) for r in rt.fuse(sem, bm).collect()}
    assert got == {1: 0.7, 2: 0.3, 3: 0.0}


def test_normalize_single_and_equal(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (2, 1, 3.0), (2, 2, 3.0)], "query_id long, doc_id long, s double")
    got = sorted((r.query_id, r.doc_id, r.n) for r in minmax_normalize(df, "s", "n").collect())
    assert got == [(1, 1, 1.0), (2, 1, 1.0), (2, 2, 1.0)]


def test_weights():
    assert rt.normalize_weights(0.7, 0.3) == pytest.approx((0.7, 0.3))
    assert rt.normalize_weights(1, 1) == (0.5, 0.5)
    with pytest.raises(ValueError):
        rt.normalize_weights(0, 0)


def test_role_clearance(spark):
    df = spark.createDataFrame([("admin",), ("viewer",), ("stranger",), (None,)], "r string")
    got = [r.a for r in df.select(rt.clearance_for_role(F.col("r")).alias("a")).collect()]
    assert got[0] == ["public", "internal", "confidential", "restricted"]
    assert got[1] == ["public"] and got[2] == ["public"] and got[3] is None


DOCS = [(1, "Port congestion in Singapore delayed shipments."),
        (2, "Weather delays in the Pacific; port congestion again."),
        (3, "Quarterly report: shipment volumes grew."),
        (4, ""),
        (5, "Singapore singapore SINGAPORE port")]


def _bm25_python(docs, query, k1=1.2, b=0.75):
    tok = lambda s: [t for t in re.split(r"[^\w]+|_", s.lower()) if t]
    toks = {d: tok(t) for d, t in docs}
    n = len(docs)
    avgdl = sum(len(v) for v in toks.values()) / n
    out = {}
    for term in set(tok(query)):
        df = sum(1 for v in toks.values() if term in v)
        if df == 0:
            continue
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        for d, v in toks.items():
            tf = v.count(term)
            if tf:
                out[d] = out.get(d, 0.0) + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(v) / avgdl))
    return out


def test_bm25_matches_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    q = spark.createDataFrame([(7, "singapore port congestion")], "query_id long, query_text string")
    idx = build_text_index(docs)
    got = {r.doc_id: r.score for r in rt.bm25_scores(idx, q).collect()}
    want = _bm25_python(DOCS, "singapore port congestion")
    assert set(got) == set(want)
    for d in want:
        assert got[d] == pytest.approx(want[d], rel=1e-12)


def test_materialized_index_same_scores(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    q = spark.createDataFrame([(7, "singapore port congestion")], "query_id long, query_text string")
    path = scratch_path(spark, "test-index")
    idx = build_text_index(docs, path=path)
    lazy = {r.doc_id: r.score for r in rt.bm25_scores(build_text_index(docs), q).collect()}
    mat = {r.doc_id: r.score for r in rt.bm25_scores(load_text_index(spark, path), q).collect()}
    assert lazy == pytest.approx(mat)
    assert idx.docs.count() == 5  # the empty document is indexed with dl = 0


def _vectors(n=40, d=8, seed=3):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, d))


@pytest.mark.parametrize("blocked", [False, True])
def test_knn_matches_numpy(spark, monkeypatch, blocked):
    m = _vectors()
    if blocked:  # force the block/cogroup path
        monkeypatch.setattr(rt, "QUERY_BROADCAST_BYTES", 1)
        monkeypatch.setattr(rt, "BLOCK_ROWS", 7)
    vecs = spark.createDataFrame([(i, m[i].tolist()) for i in range(len(m))], "doc_id long, embedding array<double>")
    got = rt.similar_documents(vecs, k=3, unrestricted=True).collect()
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -np.inf)
    for i in range(len(m)):
        want = sorted(range(len(m)), key=lambda j: (-round(s[i, j], 6), j))[:3]
        mine = [r.doc_id for r in sorted((r for r in got if r.query_id == i), key=lambda r: r["rank"])]
        assert mine == want


def test_vector_search_respects_filters(spark):
    m = _vectors(12, 4)
    vecs = spark.createDataFrame([(i, m[i].tolist()) for i in range(12)], "doc_id long, embedding array<double>")
    docs = spark.createDataFrame([(i, ["public", "internal", "confidential", "restricted"][i % 4]) for i in range(12)],
                                 "doc_id long, security_clearance string")
    q = spark.createDataFrame([(1, m[0].tolist(), "viewer"), (2, m[0].tolist(), "admin")],
                              "query_id long, qvec array<double>, user_role string")
    res = rt.vector_search(q, vecs, k=12, docs=docs).collect()
    viewer = {r.doc_id for r in res if r.query_id == 1}
    admin = {r.doc_id for r in res if r.query_id == 2}
    assert viewer == {i for i in range(12) if i % 4 == 0}
    assert admin == set(range(12))


def test_hybrid_default_k(spark):
    docs = spark.createDataFrame([(i, t) for i, t in DOCS], "doc_id long, text string")
    m = _vectors(5, 4)
    vecs = spark.createDataFrame([(i + 1, m[i].tolist()) for i in range(5)], "doc_id long, embedding array<double>")
    corpus = rt.HybridCorpus(build_text_index(docs), vecs, docs)
    q = spark.createDataFrame([(1, "singapore port", m[0].tolist())], "query_id long, query_text string, qvec array<double>")
    with pytest.raises(ValueError):  # no role and no clearance column: nothing may be read
        rt.hybrid_search(corpus, q, top_k_=0)
    res = rt.hybrid_search(corpus, q, top_k_=0, unrestricted=True).collect()
    assert len(res) == 5
    assert sorted(r["rank"] for r in res) == [1, 2, 3, 4, 5]
    resp = rt.query_response(rt.hybrid_search(corpus, q, 3, unrestricted=True), q).collect()[0]
    assert resp.sources_count == 3 and [s["rank"] for s in resp.sources] == [1, 2, 3]


def test_empty_role_is_unrestricted(spark):
    df = spark.createDataFrame([("",)], "r string")
    assert df.select(rt.clearance_for_role(F.col("r")).alias("a")).first().a is None


def test_vector_index_carries_filters(spark):
    from corpusflow.operators.index import build_vector_index
    m = _vectors(12, 4)
    vecs = spark.createDataFrame([(i, m[i].tolist()) for i in range(12)], "doc_id long, embedding array<double>")
    docs = spark.createDataFrame([(i, ["public", "internal", "confidential", "restricted"][i % 4]) for i in range(12)],
                                 "doc_id long, security_clearance string")
    vidx = build_vector_index(vecs, docs, path=scratch_path(spark, "test-vidx"))
    assert "security_clearance" in vidx.columns
    q = spark.createDataFrame([(1, m[0].tolist(), "viewer")], "query_id long, qvec array<double>, user_role string")
    got = {r.doc_id for r in rt.vector_search(q, vidx, k=12).collect()}
    assert got == {i for i in range(12) if i % 4 == 0}


def test_similar_documents_unknown_id(spark):
    m = _vectors(6, 4)
    vecs = spark.createDataFrame([(i, m[i].tolist()) for i in range(6)], "doc_id long, embedding array<double>")
    q = spark.createDataFrame([(99,), (2,)], "query_id long")
    res = rt.similar_documents(vecs, k=2, queries=q, unrestricted=True).collect()
    assert {r.query_id for r in res} == {2} and all(r.doc_id != 2 for r in res)


def test_hybrid_fail_closed_without_role(spark):
    docs = spark.createDataFrame([(i, t, ["public", "internal"][i % 2]) for i, t in DOCS],
                                 "doc_id long, text string, security_clearance string")
    m = _vectors(5, 4)
    vecs = spark.createDataFrame([(i + 1, m[i].tolist()) for i in range(5)], "doc_id long, embedding array<double>")
    corpus = rt.HybridCorpus(build_text_index(docs), vecs, docs)
    q = spark.createDataFrame([(1, "singapore port", m[0].tolist())], "query_id long, query_text string, qvec array<double>")
    closed = {r.doc_id for r in rt.hybrid_search(corpus, q, 5).collect()}
    opened = {r.doc_id for r in rt.hybrid_search(corpus, q, 5, unrestricted=True).collect()}
    assert closed == {2, 4} and opened == {1, 2, 3, 4, 5}
