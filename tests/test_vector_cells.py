"""Exact nearest neighbours by cells, against all pairs in numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import retrieval as rt
from corpusflow.operators.vector_cells import cell_candidates

K = 4


def _clustered(n=1200, d=16, centres=30, seed=1):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, d))
    return c[rng.integers(0, centres, n)] + 0.05 * rng.normal(size=(n, d))


def _df(spark, m):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "doc_id long, embedding array<double>")


def _all_pairs(m, k, ok=None):
    n = np.linalg.norm(m, axis=1, keepdims=True)
    u = m / np.where(n == 0, 1, n)
    s = np.round(u @ u.T, 6) + 0.0
    np.fill_diagonal(s, -np.inf)
    return {i: [int(j) for j in np.lexsort((np.arange(len(m)), -s[i])) if np.isfinite(s[i, j]) and (ok is None or ok[j])][:k]
            for i in range(len(m))}


def _ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append(r.doc_id)
    return out


def _candidates(vecs, k, rows):
    q = vecs.select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("qvec"))
    return cell_candidates(q, vecs, k, [], None, True, rows)


def test_clustered_vectors_are_pruned_and_exact(spark):
    m = _clustered()
    found, seen = _candidates(_df(spark, m), K, 40)
    pairs = seen.select(F.sum(F.col("queries") * F.col("documents"))).first()[0]
    assert pairs < 0.25 * len(m) ** 2
    assert _ranked(rt.top_k(found, K, "cosine", digits=6)) == _all_pairs(m, K)


def test_a_third_of_all_rows_are_copies(spark):
    m = _clustered(600)
    m[::3] = m[0]
    found, seen = _candidates(_df(spark, m), K, 40)
    assert _ranked(rt.top_k(found, K, "cosine", digits=6)) == _all_pairs(m, K)
    # copies are compared once: 401 different vectors, not 600
    assert seen.select(F.sum("documents")).first()[0] <= 401
    assert seen.select(F.max("documents")).first()[0] <= 80


@pytest.mark.parametrize("shape", ["one pivot distance", "zero vectors", "fewer than k"])
def test_degenerate_vectors(spark, shape):
    m = np.eye(20) if shape == "one pivot distance" else _clustered(30, 4, 3)
    if shape == "zero vectors":
        m[5:9] = 0.0
    if shape == "fewer than k":
        m = m[:3]
    found, _ = _candidates(_df(spark, m), K, 8)
    assert _ranked(rt.top_k(found, K, "cosine", digits=6)) == _all_pairs(m, K)


def test_filters_and_clearance(spark):
    m = _clustered(200, 8, 5)
    levels = ["public", "internal", "confidential", "restricted"]
    vecs = _df(spark, m).withColumn("security_clearance", F.element_at(
        F.array(*map(F.lit, levels)), (F.col("doc_id") % 4 + 1).cast("int")))
    assert _ranked(rt.similar_documents(vecs, K)) == _all_pairs(m, K, [i % 4 == 0 for i in range(200)])
    assert _ranked(rt.similar_documents(vecs, K, unrestricted=True)) == _all_pairs(m, K)


def test_nulls_repeats_and_empty_tables(spark):
    m = _clustered(40, 4, 3)
    vecs = _df(spark, m)
    noisy = vecs.unionByName(vecs).unionByName(spark.createDataFrame([(99, None)], vecs.schema))
    found, _ = _candidates(noisy, K, 8)
    assert _ranked(rt.top_k(found.distinct(), K, "cosine", digits=6)) == _all_pairs(m, K)
    none, seen = _candidates(vecs.limit(0), K, 8)
    assert none.count() == 0 and seen.count() == 0 and none.columns == ["query_id", "doc_id", "cosine"]
    named = vecs.select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 3, "0")).alias("doc_id"), "embedding")
    assert rt.similar_documents(named, K, unrestricted=True).count() == 40 * K
