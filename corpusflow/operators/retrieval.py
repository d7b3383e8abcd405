"""Keyword, vector and hybrid retrieval over whole tables of queries.

A query table has ``query_id`` plus any of ``query_text``, ``qvec``
(array<float|double>), ``user_role`` and the filter columns listed in
``FILTER_FIELDS``. Every ranking orders by ``round(score, d) DESC, doc_id ASC``
so results are deterministic and reproducible in another engine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import tokens
from corpusflow.operators.index import TextIndex
from corpusflow.operators.vector_cells import cell_candidates
from corpusflow.operators.term_index import TermIndex, term_index_scores
from corpusflow.operators.sizing import (BROADCAST_MAX_ROWS, bounded_count, fits, minmax_normalize,
                                         sized_broadcast, top_k)
from corpusflow.session import scratch_path

# Role -> security clearance levels the role may read. A role not
# in the table reads public documents only; no role at all means no restriction.
ROLE_CLEARANCE = {
    "admin": ["public", "internal", "confidential", "restricted"],
    "supply_chain_manager": ["public", "internal", "confidential"],
    "warehouse_operator": ["public", "internal"],
    "viewer": ["public"],
}
DEFAULT_CLEARANCE = ["public"]

# Default fusion weights, blend weights for reranking and
# result size.
SEMANTIC_WEIGHT, BM25_WEIGHT = 0.7, 0.3
RERANK_KEEP, RERANK_MODEL = 0.7, 0.3
DEFAULT_TOP_K = 5
BM25_K1, BM25_B = 1.2, 0.75

# (query column, document column, kind). "in": the query's array lists the
# allowed document values (null or empty = unrestricted); "clear": the same, but a
# null is unrestricted only where with_clearance made it so, and an empty array allows
# nothing; "ge"/"le": inclusive bound (null = unrestricted).
FILTER_FIELDS = [
    ("allowed_clearance", "security_clearance", "clear"),
    ("source_types", "source_type", "in"),
    ("document_types", "document_type", "in"),
    ("regions", "region", "in"),
    ("date_start", "doc_date", "ge"),
    ("date_end", "doc_date", "le"),
]

COSINE_DIGITS = 6
BM25_DIGITS = 9


def clearance_for_role(role: Column, unrestricted: bool = True) -> Column:
    """R7 as a column: allowed clearance array for a role column. An unknown
    role reads public only. A null or empty role means no restriction when
    ``unrestricted`` (the reference behaviour), else public only."""
    m = F.create_map(*[x for r, lv in ROLE_CLEARANCE.items()
                       for x in (F.lit(r), F.array(*[F.lit(v) for v in lv]))])
    default = F.array(*[F.lit(v) for v in DEFAULT_CLEARANCE])
    no_role = F.lit(None).cast("array<string>") if unrestricted else default
    return F.when(role.isNull() | (role == ""), no_role) \
            .otherwise(F.coalesce(F.element_at(m, role), default))


def with_clearance(queries: DataFrame, role_col: str = "user_role", unrestricted: bool = False) -> DataFrame:
    """Add ``allowed_clearance`` from the role; a given one is kept, but where it is null the
    query reads what its role allows. Without a role column, nothing is added when
    ``unrestricted``; otherwise every query reads public documents only."""
    if "allowed_clearance" in queries.columns:
        role = F.col(role_col) if role_col in queries.columns else F.lit(None).cast("string")
        return queries.withColumn("allowed_clearance", F.coalesce("allowed_clearance", clearance_for_role(role, unrestricted)))
    if role_col not in queries.columns:
        if unrestricted:
            return queries
        return queries.withColumn("allowed_clearance", F.array(*[F.lit(v) for v in DEFAULT_CLEARANCE]))
    return queries.withColumn("allowed_clearance", clearance_for_role(F.col(role_col), unrestricted))


def _active_filters(queries: DataFrame, docs: DataFrame | None):
    """The filters that the queries state; documents without the column to test are an error,
    never an unfiltered answer."""
    stated = [f for f in FILTER_FIELDS if f[0] in queries.columns]
    missing = sorted({f[1] for f in stated if docs is None or f[1] not in docs.columns})
    if missing:
        raise ValueError(f"queries are filtered by columns that the documents don't have: {missing}")
    return stated


def filter_predicate(fields) -> Column:
    """Conjunction of the active filter fields (query cols vs doc cols)."""
    pred = F.lit(True)
    for qc, dc, kind in fields:
        q, d = F.col(qc), F.col(dc)
        if kind == "in":
            ok = q.isNull() | (F.size(q) == 0) | F.array_contains(q, d)
        elif kind == "clear":
            ok = q.isNull() | F.array_contains(q, d)
        elif kind == "ge":
            ok = q.isNull() | (d >= q)
        else:
            ok = q.isNull() | (d <= q)
        pred = pred & ok
    return pred


def _np_filter_mask(qrow, dpdf: pd.DataFrame, fields) -> np.ndarray:
    """Same predicate as ``filter_predicate`` for one query over a block of
    documents (used inside the vector-search tasks)."""
    mask = np.ones(len(dpdf), dtype=bool)
    for qc, dc, kind in fields:
        v = qrow[qc]
        if v is None or (kind == "in" and len(v) == 0):
            continue
        if kind in ("ge", "le") and pd.isna(v):
            continue
        col = dpdf[dc]
        if kind in ("in", "clear"):
            mask &= col.isin(list(v)).to_numpy()
        elif kind == "ge":
            mask &= (col >= v).fillna(False).to_numpy(dtype=bool)
        else:
            mask &= (col <= v).fillna(False).to_numpy(dtype=bool)
    return mask


def apply_filters(scored: DataFrame, queries: DataFrame, docs: DataFrame | None) -> DataFrame:
    """Keep ``(query_id, doc_id, ...)`` rows whose document passes the query's
    filters. The query side is small and broadcast after a size check."""
    fields = _active_filters(queries, docs)
    if not fields:
        return scored
    qf = queries.select("query_id", *[f[0] for f in fields])
    dm = docs.select("doc_id", *sorted({f[1] for f in fields}))
    out = (scored.join(dm, "doc_id").join(sized_broadcast(qf), "query_id")
           .where(filter_predicate(fields)))
    return out.select(*scored.columns)


# ---------------------------------------------------------------- R1 BM25

def query_terms(queries: DataFrame, text_col: str = "query_text") -> DataFrame:
    """Distinct ``(query_id, term)`` pairs of each query."""
    return queries.select("query_id", F.explode(F.array_distinct(tokens(text_col))).alias("term"))


def bm25_scores(index: TextIndex, queries: DataFrame, k1: float = BM25_K1,
                b: float = BM25_B, text_col: str = "query_text", fields=()) -> DataFrame:
    """Okapi BM25 ``(query_id, doc_id, score)`` for every document sharing a
    term with a query. idf = ln(1 + (N - df + .5)/(df + .5)); N, avgdl and df
    are corpus-wide (filters restrict candidates only). ``fields`` are filter
    fields whose document columns are on the postings: they are evaluated in
    the query-term join, before aggregation."""
    qt = query_terms(queries, text_col)
    if fields:
        qt = qt.join(queries.select("query_id", *[f[0] for f in fields]), "query_id")
    # one size check bounds both: distinct terms never outnumber (query, term) pairs
    small = fits(qt)
    terms = qt.select("term").distinct()
    terms = F.broadcast(terms) if small else sized_broadcast(terms)
    qt_side = F.broadcast(qt) if small else qt
    # Postings of query terms only. A semi-join on the grouping key is pushed
    # below the postings aggregation, so with a lazy index only matching
    # tokens are counted; the term list is broadcast, so the large side is
    # filtered map-side and never shuffled for this join.
    match = index.postings.join(terms, "term", "left_semi")
    if not index.materialized:
        # match feeds both df and scoring; write it once to the checkpoint
        # folder instead of tokenising the corpus twice.
        match = match.checkpoint(eager=True)
    dfreq = match.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n, avgdl = index.n_docs(), index.avg_dl()
    idf = F.log(1.0 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + k1 * (1.0 - b + b * F.col("dl") / avgdl)
    w = idf * F.col("tf") * (k1 + 1.0) / norm
    # dfreq has one row per distinct query term: broadcast only if the check above bounds them
    scored = match.join(F.broadcast(dfreq) if small else dfreq, "term").join(qt_side, "term")
    if fields:
        scored = scored.where(filter_predicate(fields))
    return scored.select("query_id", "doc_id", w.alias("w")) \
                 .groupBy("query_id", "doc_id").agg(F.sum("w").alias("score"))


def bm25_search(index: TextIndex | TermIndex, queries: DataFrame, k: int = 10, docs: DataFrame | None = None,
                k1: float = BM25_K1, b: float = BM25_B, text_col: str = "query_text",
                unrestricted: bool = False) -> DataFrame:
    """R1 (+R3, R8): filtered keyword top-k with min-max normalised score.

    Filters on document columns carried by the index run inside the
    query-term join; any others join ``docs`` on the aggregated candidates.
    A query without a role reads public documents only, unless ``unrestricted``.
    Returns ``query_id, doc_id, bm25_raw, bm25_score, bm25_rank``.
    """
    queries = with_clearance(queries, unrestricted=unrestricted)
    fields = _active_filters(queries, docs)
    by_term = isinstance(index, TermIndex)
    on_postings = [f for f in fields if f[1] in (index.columns if by_term else index.postings.columns)]
    rest = [f for f in fields if f not in on_postings]
    if by_term:
        # filters that the postings can't answer come after scoring: then nothing may be skipped
        qt = query_terms(queries, text_col)
        if on_postings:
            qt = qt.join(queries.select("query_id", *[f[0] for f in on_postings]), "query_id")
        scored = term_index_scores(index, qt, None if rest else k, on_postings, filter_predicate(on_postings) if on_postings else None,
                                   k1, b, small=fits(qt))
    else:
        scored = bm25_scores(index, queries, k1, b, text_col, on_postings)
    if rest:
        scored = apply_filters(scored, queries.select("query_id", *[f[0] for f in rest]), docs)
    top = top_k(scored, k, "score", digits=BM25_DIGITS, rank_col="bm25_rank")
    top = minmax_normalize(top, "score", "bm25_score")
    return top.select("query_id", "doc_id", F.col("score").alias("bm25_raw"),
                      "bm25_score", "bm25_rank")


# ------------------------------------------------------------- R2 vectors

# Upper bound on broadcast query vectors (numbers x 8 bytes).
QUERY_BROADCAST_BYTES = 64 * 1024 * 1024
BLOCK_ROWS = 4096


def _block_topk(qids, qmat, qmeta, dids, dmat, dmeta, k, exclude_self, fields):
    """Top-k (plus rounding-tie margin) per query within one block of
    documents. Returns three aligned arrays (query_id, doc_id, cosine)."""
    if len(dids) == 0 or len(qids) == 0:
        return [], [], []
    sims = qmat @ dmat.T
    out_q, out_d, out_s = [], [], []
    for i, qid in enumerate(qids):
        s = sims[i].copy()
        if fields:
            s[~_np_filter_mask(qmeta[i], dmeta, fields)] = -np.inf
        if exclude_self:
            s[dids == qid] = -np.inf
        ok = np.isfinite(s)
        if not ok.any():
            continue
        cand = np.flatnonzero(ok)
        if len(cand) > k:
            kth = np.partition(s[cand], len(cand) - k)[len(cand) - k]
            # keep everything that could tie with the k-th after rounding
            cand = cand[s[cand] >= kth - 2 * 10.0 ** (-COSINE_DIGITS)]
        out_q.append(np.repeat(qids[i:i + 1], len(cand)))
        out_d.append(dids[cand])
        out_s.append(s[cand])
    if not out_q:
        return [], [], []
    return np.concatenate(out_q), np.concatenate(out_d), np.concatenate(out_s)


def _unit_rows(arrs) -> np.ndarray:
    m = np.vstack([np.asarray(a, dtype=np.float64) for a in arrs])
    n = np.linalg.norm(m, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return m / n


def _qmeta_rows(pdf: pd.DataFrame, fields):
    cols = [f[0] for f in fields]
    return [dict(zip(cols, r)) for r in pdf[cols].itertuples(index=False, name=None)] \
        if cols else [None] * len(pdf)


def _knn_schema(q: DataFrame, d: DataFrame) -> str:
    """Candidates keep the types of both ids (numbers, strings, ...)."""
    return f"query_id {dict(q.dtypes)['query_id']}, doc_id {dict(d.dtypes)['doc_id']}, cosine double"


def knn_candidates(queries: DataFrame, vectors: DataFrame, k: int,
                   exclude_self: bool = False, docs: DataFrame | None = None,
                   qvec_col: str = "qvec", unrestricted: bool = False, cells: bool = False) -> DataFrame:
    """Exact cosine k-NN candidates ``(query_id, doc_id, cosine)``.

    ``vectors`` is ``(doc_id, embedding)``; ids may be of any type. Each task multiplies a block of
    queries by a block of documents with numpy and emits only its local top-k
    per query; no query x document pair becomes a row. Small query tables are
    broadcast (bounded by ``QUERY_BROADCAST_BYTES``); larger ones, and any with
    ``cells``, visit the cells that the triangle inequality leaves (:mod:`vector_cells`).
    A query without a role reads public documents only, unless ``unrestricted``.
    """
    queries = with_clearance(queries, unrestricted=unrestricted)
    fields = _active_filters(queries, docs if docs is not None else vectors)
    meta_cols = sorted({f[1] for f in fields})
    d = vectors
    missing = [c for c in meta_cols if c not in vectors.columns]
    if missing:
        # a vector index built with build_vector_index carries these already
        d = d.join(docs.select("doc_id", *missing), "doc_id")
    d = d.select("doc_id", F.col("embedding"), *meta_cols)
    q = queries.select("query_id", F.col(qvec_col).alias("qvec"), *[f[0] for f in fields]) \
               .where(F.col("qvec").isNotNull())

    if not cells:  # queries are collected for broadcasting only below a bound on their measured size
        numbers = q.agg(F.sum(F.size("qvec").cast("long"))).first()[0] or 0
        if 8 * numbers <= QUERY_BROADCAST_BYTES:
            return _knn_broadcast(q, d, k, exclude_self, fields)
    return cell_candidates(q, d, k, fields, _np_filter_mask, exclude_self, BLOCK_ROWS)[0]


def _knn_broadcast(q, d, k, exclude_self, fields):
    spark, qpdf = d.sparkSession, q.toPandas()
    payload = {
        "ids": qpdf["query_id"].to_numpy(),
        "mat": _unit_rows(qpdf["qvec"]) if len(qpdf) else np.zeros((0, 1)),
        "meta": _qmeta_rows(qpdf, fields),
    }
    bq = spark.sparkContext.broadcast(payload)

    def run(batches):
        p = bq.value
        for pdf in batches:
            if pdf.empty:
                continue
            dmat = _unit_rows(pdf["embedding"])
            qs, ds, ss = _block_topk(p["ids"], p["mat"], p["meta"],
                                     pdf["doc_id"].to_numpy(), dmat, pdf,
                                     k, exclude_self, fields)
            if len(qs):
                yield pd.DataFrame({"query_id": qs, "doc_id": ds, "cosine": ss})

    return d.mapInPandas(run, _knn_schema(q, d))


def vector_search(queries: DataFrame, vectors: DataFrame, k: int = 10,
                  docs: DataFrame | None = None, exclude_self: bool = False,
                  qvec_col: str = "qvec", unrestricted: bool = False) -> DataFrame:
    """R2 (+R3, R8): filtered cosine top-k with min-max normalised score.
    A query without a role reads public documents only, unless ``unrestricted``.

    Returns ``query_id, doc_id, cosine, sem_score, sem_rank``.
    """
    cand = knn_candidates(queries, vectors, k, exclude_self, docs, qvec_col, unrestricted)
    top = top_k(cand, k, "cosine", digits=COSINE_DIGITS, rank_col="sem_rank")
    top = minmax_normalize(top, "cosine", "sem_score")
    return top.select("query_id", "doc_id", "cosine", "sem_score", "sem_rank")


# ------------------------------------------------------------ R4-R6, R9

def normalize_weights(semantic_weight: float = SEMANTIC_WEIGHT,
                      bm25_weight: float = BM25_WEIGHT) -> tuple[float, float]:
    """Divide both weights by their sum (which must be positive)."""
    total = semantic_weight + bm25_weight
    if total <= 0:
        raise ValueError("semantic_weight + bm25_weight must be positive")
    return semantic_weight / total, bm25_weight / total


def fuse(sem: DataFrame, bm: DataFrame, semantic_weight: float = SEMANTIC_WEIGHT,
         bm25_weight: float = BM25_WEIGHT) -> DataFrame:
    """Full outer join of the two normalised lists; a missing side counts 0."""
    ws, wb = normalize_weights(semantic_weight, bm25_weight)
    j = sem.select("query_id", "doc_id", "sem_score").join(
        bm.select("query_id", "doc_id", "bm25_score"), ["query_id", "doc_id"], "full_outer")
    return j.withColumn("combined_score",
                        F.coalesce("sem_score", F.lit(0.0)) * ws
                        + F.coalesce("bm25_score", F.lit(0.0)) * wb)


def jaccard_scorer(query_text: Column, content: Column) -> Column:
    """Built-in rerank scorer (declared substitute for a cross-encoder):
    Jaccard overlap of distinct tokens, in [0, 1]."""
    a, b = F.array_distinct(tokens(query_text)), F.array_distinct(tokens(content))
    inter = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def rerank(fused: DataFrame, queries: DataFrame, docs_text: DataFrame,
           scorer=jaccard_scorer, text_col: str = "text", max_candidates: int | None = None,
           n_queries: int | None = None) -> DataFrame:
    """``final = 0.7 * combined + 0.3 * rerank_score``.

    Only candidates are scored: their ids are broadcast into the document
    scan, so the corpus is filtered map-side instead of shuffled. The
    broadcast needs a size bound: ``max_candidates`` when the caller knows one
    (hybrid search: queries x 4k), otherwise the ids are counted.
    """
    cands = fused.select("query_id", "doc_id", "combined_score", "sem_score", "bm25_score")
    cand_ids = cands.select("doc_id").distinct()
    if max_candidates is not None and max_candidates <= BROADCAST_MAX_ROWS:
        ids = F.broadcast(cand_ids)
    else:
        ids = sized_broadcast(cand_ids)
    content = docs_text.select("doc_id", F.col(text_col).alias("content")).join(ids, "doc_id", "left_semi")
    qsel = queries.select("query_id", "query_text")
    q = F.broadcast(qsel) if n_queries is not None and n_queries <= BROADCAST_MAX_ROWS else sized_broadcast(qsel)
    if scorer is jaccard_scorer:
        # distinct tokens once per candidate document (not once per pair)
        dt = content.select("doc_id", F.array_distinct(tokens(F.col("content"))).alias("dtoks"))
        qa = q.select("query_id", F.array_distinct(tokens(F.col("query_text"))).alias("qtoks"))
        j = cands.join(dt, "doc_id").join(qa, "query_id")
        inter = F.size(F.array_intersect("qtoks", "dtoks"))
        union = F.size("qtoks") + F.size("dtoks") - inter
        score = F.when(union > 0, inter / union).otherwise(F.lit(0.0))
    else:
        j = cands.join(content, "doc_id").join(q, "query_id")
        score = scorer(F.col("query_text"), F.col("content"))
    j = j.withColumn("rerank_score", score.cast("double"))
    return j.select(*cands.columns, "rerank_score",
                    (RERANK_KEEP * F.col("combined_score") + RERANK_MODEL * F.col("rerank_score"))
                    .alias("final_score"))


@dataclass
class HybridCorpus:
    """Everything R9 needs: keyword index, vectors, metadata and text."""
    index: TextIndex | TermIndex
    vectors: DataFrame      # doc_id, embedding
    docs: DataFrame         # doc_id, text, metadata columns


def hybrid_search(corpus: HybridCorpus, queries: DataFrame, top_k_: int | None = DEFAULT_TOP_K,
                  semantic_weight: float = SEMANTIC_WEIGHT, bm25_weight: float = BM25_WEIGHT,
                  enable_rerank: bool = True, scorer=jaccard_scorer, unrestricted: bool = False) -> DataFrame:
    """role/metadata filters -> 2k semantic + 2k keyword candidates ->
    normalise -> fuse -> (rerank) -> top k. ``top_k_`` 0/None means 5.

    Fail-closed: a query without a role reads public documents only unless
    ``unrestricted=True`` is passed (then, as in the reference, no role means
    no restriction).

    Returns ``query_id, doc_id, sem_score, bm25_score, combined_score,
    [rerank_score, final_score], rank``.
    """
    k = top_k_ or DEFAULT_TOP_K
    queries = with_clearance(queries, unrestricted=unrestricted)
    sem = vector_search(queries, corpus.vectors, 2 * k, docs=corpus.docs, unrestricted=unrestricted)
    bm = bm25_search(corpus.index, queries, 2 * k, docs=corpus.docs, unrestricted=unrestricted)
    fused = fuse(sem, bm, semantic_weight, bm25_weight)
    if enable_rerank:
        # at most 2k semantic + 2k keyword candidates per query; counting the
        # (cheap) query table bounds the candidate list without running the search
        nq = bounded_count(queries, BROADCAST_MAX_ROWS)
        # reranking takes the candidates twice, for their texts and for their scores: found once, they are kept
        path = scratch_path(queries.sparkSession, "candidates")
        fused.write.parquet(path)
        fused = queries.sparkSession.read.schema(fused.schema).parquet(path)
        fused = rerank(fused, queries, corpus.docs, scorer, max_candidates=nq * 4 * k, n_queries=nq)
        score = "final_score"
    else:
        score = "combined_score"
    return top_k(fused, k, score, digits=BM25_DIGITS)


def similar_documents(vectors: DataFrame, k: int = DEFAULT_TOP_K,
                      queries: DataFrame | None = None, docs: DataFrame | None = None,
                      unrestricted: bool = False) -> DataFrame:
    """Nearest stored documents to stored documents, excluding the
    document itself. ``queries`` (``query_id``, and if wanted ``user_role`` and
    filter columns) selects which stored documents to ask about; default is
    every stored document (a k-NN table). Unknown ids give no rows. Without a
    role only public documents are found, unless ``unrestricted``; ``docs``
    holds the columns to filter by, if ``vectors`` doesn't.
    Returns ``query_id, doc_id, cosine, rank``."""
    own = vectors.select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("qvec"))
    q = own if queries is None else queries.join(own, "query_id")
    cand = knn_candidates(q, vectors, k, exclude_self=True, docs=docs, unrestricted=unrestricted, cells=queries is None)
    return top_k(cand, k, "cosine", digits=COSINE_DIGITS)


def query_response(results: DataFrame, queries: DataFrame, score: str = "final_score",
                   method: str = "hybrid") -> DataFrame:
    """One response row per query: sources ordered by rank, their count,
    role, method and retrieval time. Each list holds at most k entries."""
    src = F.struct(F.col("rank").cast("long").alias("rank"), F.col("doc_id"),
                   F.col(score).alias("score"))
    agg = results.groupBy("query_id").agg(F.array_sort(F.collect_list(src)).alias("sources"))
    role = queries.select("query_id", *(["user_role"] if "user_role" in queries.columns else []))
    out = role.join(agg, "query_id", "left")
    out = out.withColumn("sources", F.coalesce("sources", F.array().cast(agg.schema["sources"].dataType)))
    return (out.withColumn("sources_count", F.size("sources").cast("long"))
               .withColumn("method", F.lit(method))
               .withColumn("retrieved_at", F.current_timestamp()))
