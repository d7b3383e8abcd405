"""Registered retrieval queries (R1-R12) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators.index import build_text_index
from corpusflow.operators.retrieval import (HybridCorpus, bm25_search, hybrid_search,
                                            query_response, similar_documents, vector_search)
from corpusflow.plans import fixtures as fx
from corpusflow.plans.registry import register
from corpusflow.plans.sqlparts import (CORPUS, QUERY_ROLE, ROLE_ALLOWED, W_BM, W_SEM,
                                       bm25_ctes, filter_pred, minmax, toks)
from corpusflow.sources.tables import read_table


def r6(c):
    return F.round(F.col(c), 6).alias(c)


# ------------------------------------------------------------ bm25_topk
BM25_K = 10
SQL_BM25 = f"""WITH qry AS (SELECT item_id AS query_id, text AS query_text FROM benchmark),
{bm25_ctes('qry')},
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
        FROM bm_all QUALIFY rank <= {BM25_K})
SELECT query_id, doc_id, rank::BIGINT AS rank, round(score, 6) AS bm25_raw,
       round({minmax('score')}, 6) AS bm25_score
FROM top"""


@register("bm25_topk", SQL_BM25)
def q_bm25_topk(spark, sf_dir):
    """R12 index over all documents, R1 top-10 for every benchmark item, R3."""
    index = fx.term_index(spark, sf_dir)
    res = bm25_search(index, fx.text_queries(spark, sf_dir), k=BM25_K, unrestricted=True)
    return res.select("query_id", "doc_id", F.col("bm25_rank").cast("long").alias("rank"),
                      F.round("bm25_raw", 6).alias("bm25_raw"), r6("bm25_score"))


# ---------------------------------------------------------- vector_topk
VEC_K = 10
SQL_VECTOR = f"""WITH q AS (SELECT b.item_id AS query_id, e.embedding AS qvec
           FROM benchmark b JOIN embeddings e ON e.vec_id = b.item_id),
s AS (SELECT q.query_id, e.vec_id AS doc_id,
             list_cosine_similarity(q.qvec::DOUBLE[], e.embedding::DOUBLE[]) AS cosine
      FROM q, embeddings e),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 6) DESC, doc_id) AS rank
        FROM s QUALIFY rank <= {VEC_K})
SELECT query_id, doc_id, rank::BIGINT AS rank, round(cosine, 6) AS cosine,
       round({minmax('cosine')}, 6) AS sem_score
FROM top"""


@register("vector_topk", SQL_VECTOR)
def q_vector_topk(spark, sf_dir):
    """R2 + R3: exact cosine top-10 over all embeddings for every benchmark
    item's vector (vec_id = item_id)."""
    q = fx.hybrid_queries(spark, sf_dir, with_roles=False)
    res = vector_search(q, fx.all_vectors(spark, sf_dir), k=VEC_K, unrestricted=True)
    return res.select("query_id", "doc_id", F.col("sem_rank").cast("long").alias("rank"),
                      r6("cosine"), r6("sem_score"))


# ----------------------------------------------------- similar_documents
SIM_K = 5
SQL_SIMILAR = f"""WITH s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS doc_id,
         list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS cosine
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 6) DESC, doc_id) AS rank
        FROM s QUALIFY rank <= {SIM_K})
SELECT query_id, doc_id, rank::BIGINT AS rank, round(cosine, 6) AS cosine FROM top"""


@register("similar_documents", SQL_SIMILAR)
def q_similar_documents(spark, sf_dir):
    """R10 batch form: the 5 nearest other vectors of every stored vector."""
    res = similar_documents(fx.all_vectors(spark, sf_dir), k=SIM_K, unrestricted=True)
    return res.select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), r6("cosine"))


# --------------------------------------------------------- hybrid family
HYB_K = 5


def _hybrid_sql(with_roles: bool, with_filters: bool, rerank: bool) -> str:
    cols = ["b.item_id AS query_id", "b.text AS query_text", "e.embedding AS qvec"]
    fields = []
    if with_roles:
        cols.append(f"{QUERY_ROLE} AS user_role")
        cols.append(ROLE_ALLOWED.format(r=QUERY_ROLE) + " AS allowed_clearance")
        fields.append("allowed_clearance")
    if with_filters:
        cols.append("CASE WHEN b.item_id % 2 = 0 THEN ['s3','api'] END AS source_types")
        cols.append("""(SELECT list_sort(list(r_name)) FROM region
                         WHERE r_regionkey IN (b.item_id % 5, (b.item_id + 1) % 5)) AS regions""")
        cols.append("CAST(DATE '2024-01-01' + CAST(b.item_id % 45 AS INTEGER) AS DATE) AS date_start")
        cols.append("CAST(DATE '2024-01-01' + CAST(b.item_id % 45 + 44 AS INTEGER) AS DATE) AS date_end")
        fields += ["source_types", "regions", "date_start", "date_end"]
    pred = filter_pred("q", "c", fields)
    k2 = 2 * HYB_K
    final = "combined_score"
    rr = ""
    out_extra = ""
    if rerank:
        rr = f""",
rr AS (
  SELECT f.*, jac AS rerank_score, 0.7 * f.combined_score + 0.3 * jac AS final_score
  FROM (SELECT f.*, CASE WHEN len(qa) + len(da) - len(list_intersect(qa, da)) > 0
                    THEN len(list_intersect(qa, da)) / (len(qa) + len(da) - len(list_intersect(qa, da)))
                    ELSE 0.0 END AS jac
        FROM (SELECT f.*, list_distinct({toks('q.query_text')}) AS qa, list_distinct({toks('c.text')}) AS da
              FROM fused f JOIN corpus c USING (doc_id) JOIN qry q USING (query_id)) f) f)"""
        final = "final_score"
        out_extra = ", round(rerank_score, 6) AS rerank_score, round(final_score, 6) AS final_score"
    src = "rr" if rerank else "fused"
    return f"""WITH {CORPUS},
qry AS (SELECT {', '.join(cols)} FROM benchmark b LEFT JOIN embeddings e ON e.vec_id = b.item_id),
{bm25_ctes('qry')},
bm_top AS (SELECT a.query_id, a.doc_id, a.score FROM bm_all a JOIN corpus c ON c.doc_id = a.doc_id
           JOIN qry q ON q.query_id = a.query_id WHERE {pred}
           QUALIFY row_number() OVER (PARTITION BY a.query_id ORDER BY round(a.score, 9) DESC, a.doc_id) <= {k2}),
bm AS (SELECT query_id, doc_id, {minmax('score')} AS bm25_score FROM bm_top),
vecs AS (SELECT vec_id AS doc_id, embedding FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)),
sem_top AS (
  SELECT q.query_id, v.doc_id, list_cosine_similarity(q.qvec::DOUBLE[], v.embedding::DOUBLE[]) AS cosine
  FROM qry q JOIN vecs v ON TRUE JOIN corpus c ON c.doc_id = v.doc_id
  WHERE q.qvec IS NOT NULL AND {pred}
  QUALIFY row_number() OVER (PARTITION BY q.query_id ORDER BY round(cosine, 6) DESC, v.doc_id) <= {k2}),
sem AS (SELECT query_id, doc_id, {minmax('cosine')} AS sem_score FROM sem_top),
fused AS (
  SELECT coalesce(s.query_id, b.query_id) AS query_id, coalesce(s.doc_id, b.doc_id) AS doc_id,
         s.sem_score, b.bm25_score,
         coalesce(s.sem_score, 0) * {W_SEM!r} + coalesce(b.bm25_score, 0) * {W_BM!r} AS combined_score
  FROM sem s FULL OUTER JOIN bm b ON s.query_id = b.query_id AND s.doc_id = b.doc_id){rr},
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round({final}, 9) DESC, doc_id) AS rank
           FROM {src} QUALIFY rank <= {HYB_K})
SELECT query_id, doc_id, rank::BIGINT AS rank, round(sem_score, 6) AS sem_score,
       round(bm25_score, 6) AS bm25_score, round(combined_score, 6) AS combined_score{out_extra}
FROM ranked"""


def _hybrid(spark, sf_dir, with_roles, with_filters, rerank):
    docs = fx.corpus_docs(spark, sf_dir)
    corpus = HybridCorpus(index=fx.term_index(spark, sf_dir), vectors=fx.doc_vectors(spark, sf_dir), docs=docs)
    q = fx.filtered_queries(spark, sf_dir) if with_filters else fx.hybrid_queries(spark, sf_dir, with_roles)
    # queries without roles are searched unrestricted on purpose (R9 opt-in)
    res = hybrid_search(corpus, q, HYB_K, enable_rerank=rerank, unrestricted=not with_roles)
    cols = ["query_id", "doc_id", F.col("rank").cast("long").alias("rank"),
            r6("sem_score"), r6("bm25_score"), r6("combined_score")]
    if rerank:
        cols += [r6("rerank_score"), r6("final_score")]
    return res.select(*cols)


@register("hybrid_search", _hybrid_sql(False, False, False))
def q_hybrid_search(spark, sf_dir):
    """R3-R5, R9 without roles or reranking."""
    return _hybrid(spark, sf_dir, False, False, False)


@register("hybrid_reranked", _hybrid_sql(False, False, True))
def q_hybrid_reranked(spark, sf_dir):
    """R9 with the R6 rerank blend (built-in Jaccard scorer)."""
    return _hybrid(spark, sf_dir, False, False, True)


@register("rbac_search", _hybrid_sql(True, False, True))
def q_rbac_search(spark, sf_dir):
    """R7 + R9: role clearance applied before ranking, reranked."""
    return _hybrid(spark, sf_dir, True, False, True)


@register("filtered_search", _hybrid_sql(True, True, True))
def q_filtered_search(spark, sf_dir):
    """R8 + R9: role plus source-type / region / date-range filters."""
    return _hybrid(spark, sf_dir, True, True, True)


SQL_RESPONSE = _hybrid_sql(True, False, True).replace(
    "SELECT query_id, doc_id, rank::BIGINT AS rank, round(sem_score, 6) AS sem_score,\n"
    "       round(bm25_score, 6) AS bm25_score, round(combined_score, 6) AS combined_score, "
    "round(rerank_score, 6) AS rerank_score, round(final_score, 6) AS final_score\nFROM ranked",
    """SELECT q.query_id, q.user_role,
       coalesce(string_agg(r.doc_id::VARCHAR, ',' ORDER BY r.rank), '') AS source_ids,
       count(r.doc_id)::BIGINT AS sources_count, 'hybrid' AS method
FROM qry q LEFT JOIN ranked r ON r.query_id = q.query_id
GROUP BY q.query_id, q.user_role""")


@register("search_response", SQL_RESPONSE)
def q_search_response(spark, sf_dir):
    """Response rows for rbac_search (sources in rank order)."""
    docs = fx.corpus_docs(spark, sf_dir)
    corpus = HybridCorpus(index=fx.term_index(spark, sf_dir), vectors=fx.doc_vectors(spark, sf_dir), docs=docs)
    q = fx.hybrid_queries(spark, sf_dir, True)
    res = hybrid_search(corpus, q, HYB_K, enable_rerank=True)
    resp = query_response(res, q)
    return resp.select(
        "query_id", "user_role",
        F.concat_ws(",", F.transform("sources", lambda s: s["doc_id"].cast("string"))).alias("source_ids"),
        "sources_count", "method")


# ------------------------------------------------------------ text_index
SQL_TEXT_INDEX = f"""WITH toks AS (SELECT doc_id, {toks('text')} AS t FROM documents)
SELECT doc_id, term, dl::BIGINT AS dl, count(*)::BIGINT AS tf
FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM toks) GROUP BY doc_id, term, dl"""


@register("text_index", SQL_TEXT_INDEX)
def q_text_index(spark, sf_dir):
    """The keyword index (postings with term frequency and document
    length) over every document."""
    idx = build_text_index(read_table(spark, sf_dir, "documents"))
    return idx.postings.select("doc_id", "term", F.col("dl").cast("long").alias("dl"),
                               F.col("tf").cast("long").alias("tf"))
