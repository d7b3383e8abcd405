"""DuckDB SQL fragments shared by oracle queries (same rules as the Spark
column functions, written independently in SQL)."""

from corpusflow.operators.retrieval import normalize_weights

W_SEM, W_BM = normalize_weights()


def toks(expr: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower({expr}), '[^\\p{{L}}\\p{{N}}]+'), "
            f"lambda t: t <> '')")


CORPUS = """corpus AS (
  SELECT d.doc_id, d.text, d.source,
         ['public','internal','confidential','restricted'][(d.doc_id % 4) + 1] AS security_clearance,
         ['s3','database','api'][(d.doc_id % 3) + 1] AS source_type,
         d.source AS document_type,
         CAST(DATE '2024-01-01' + CAST(d.doc_id % 90 AS INTEGER) AS DATE) AS doc_date,
         r.r_name AS region
  FROM documents d LEFT JOIN region r ON r.r_regionkey = d.doc_id % 5)"""

ROLE_ALLOWED = """CASE WHEN {r} IS NULL THEN NULL
       WHEN {r} = 'admin' THEN ['public','internal','confidential','restricted']
       WHEN {r} = 'supply_chain_manager' THEN ['public','internal','confidential']
       WHEN {r} = 'warehouse_operator' THEN ['public','internal']
       ELSE ['public'] END"""

QUERY_ROLE = "['admin','supply_chain_manager','warehouse_operator','viewer','guest'][(b.item_id % 5) + 1]"


def bm25_ctes(queries_cte: str) -> str:
    """CTEs producing ``bm_all(query_id, doc_id, score)`` over the whole
    documents table for the queries in ``queries_cte`` (query_id, query_text)."""
    return f"""toks AS (SELECT doc_id, {toks('text')} AS t FROM documents),
stats AS (SELECT count(*)::DOUBLE AS n, avg(len(t)) AS avgdl FROM toks),
post AS (SELECT doc_id, term, dl, count(*) AS tf
         FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM toks) GROUP BY doc_id, term, dl),
qt AS (SELECT DISTINCT query_id, term FROM (SELECT query_id, unnest({toks('query_text')}) AS term FROM {queries_cte})),
m AS (SELECT * FROM post WHERE term IN (SELECT term FROM qt)),
dfq AS (SELECT term, count(*) AS df FROM m GROUP BY term),
bm_all AS (
  SELECT qt.query_id, m.doc_id,
         sum(ln(1 + (stats.n - dfq.df + 0.5) / (dfq.df + 0.5)) * m.tf * (1.2 + 1)
             / (m.tf + 1.2 * (1 - 0.75 + 0.75 * m.dl / stats.avgdl))) AS score
  FROM m JOIN dfq USING (term) JOIN qt USING (term) CROSS JOIN stats
  GROUP BY qt.query_id, m.doc_id)"""


def minmax(col: str) -> str:
    return (f"CASE WHEN max({col}) OVER (PARTITION BY query_id) = min({col}) OVER (PARTITION BY query_id) "
            f"THEN 1.0 ELSE ({col} - min({col}) OVER (PARTITION BY query_id)) / "
            f"(max({col}) OVER (PARTITION BY query_id) - min({col}) OVER (PARTITION BY query_id)) END")


def filter_pred(q: str, d: str, fields: list[str]) -> str:
    """SQL twin of retrieval.filter_predicate for the named query columns."""
    parts = []
    for qc, dc, kind in [("allowed_clearance", "security_clearance", "in"),
                         ("source_types", "source_type", "in"),
                         ("document_types", "document_type", "in"),
                         ("regions", "region", "in"),
                         ("date_start", "doc_date", "ge"),
                         ("date_end", "doc_date", "le")]:
        if qc not in fields:
            continue
        if kind == "in":
            parts.append(f"({q}.{qc} IS NULL OR len({q}.{qc}) = 0 OR list_contains({q}.{qc}, {d}.{dc}))")
        elif kind == "ge":
            parts.append(f"({q}.{qc} IS NULL OR {d}.{dc} >= {q}.{qc})")
        else:
            parts.append(f"({q}.{qc} IS NULL OR {d}.{dc} <= {q}.{qc})")
    return " AND ".join(parts) if parts else "TRUE"
