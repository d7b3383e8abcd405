"""Keyword and vector index tables.

The keyword index is a postings table ``(doc_id, term, tf, dl)`` plus a
per-document table ``(doc_id, dl)``. Carrying ``dl`` (document length in
tokens) on every posting lets BM25 score without joining back to documents.
Vectors are unit-normalised once at build time so cosine becomes a dot product.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.text import tokens

# Fixed value: one token = a maximal run of Unicode letters/digits (the
# complement of the tokeniser's separator class).
TOKEN_RUN = r"[\p{L}\p{N}]+"


@dataclass
class TextIndex:
    postings: DataFrame   # doc_id, term, tf, dl (+ filter columns)
    docs: DataFrame       # doc_id, dl  (every document, also those with no tokens)
    materialized: bool = False  # postings are a written table (cheap to rescan)

    def n_docs(self):
        """Scalar subquery column: number of indexed documents."""
        return self.docs.select(F.count(F.lit(1))).scalar()

    def avg_dl(self):
        """Scalar subquery column: average document length in tokens."""
        return self.docs.select(F.avg("dl")).scalar()

    def doc_freq(self, terms: DataFrame | None = None) -> DataFrame:
        """``(term, df)``; restricted to ``terms`` when given (semi-join first,
        so only the needed postings are counted). Partial aggregation runs
        map-side, so a very frequent term does not skew the shuffle."""
        p = self.postings
        if terms is not None:
            p = p.join(terms, "term", "left_semi")
        return p.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


# Document columns that retrieval filters use; when present they ride along on
# every posting so filters run inside the (broadcast) query-term join.
FILTER_DOC_COLUMNS = ("security_clearance", "source_type", "document_type", "region", "doc_date")


def build_text_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     path: str | None = None, meta_cols: list[str] | None = None) -> TextIndex:
    """Tokenise once per document, explode, count per ``(doc_id, term)``.

    ``meta_cols`` (default: the filter columns present in ``df``) are copied
    onto each posting from the document's own row, so no join is needed to
    filter candidates. With ``path`` the index is written there (Parquet,
    shared folder) and read back, so later queries scan the small index
    instead of re-tokenising the corpus, and the lineage is cut there.
    """
    meta = list(meta_cols) if meta_cols is not None else [c for c in FILTER_DOC_COLUMNS if c in df.columns]
    toks = df.select(F.col(id_col).alias("doc_id"), *meta, tokens(text_col).alias("toks"))
    toks = toks.withColumn("dl", F.size("toks"))
    # explode_outer: a plain explode makes the optimizer add a size(...) > 0
    # filter that evaluates the tokeniser a second time per document.
    postings = (toks.select("doc_id", "dl", *meta, F.explode_outer("toks").alias("term"))
                .where(F.col("term").isNotNull())
                .groupBy("doc_id", "term", "dl", *meta)
                .agg(F.count(F.lit(1)).alias("tf")))
    # Token count per document for N/avgdl: counting maximal letter/digit runs
    # equals the number of non-empty split pieces, without building arrays.
    docs = df.select(F.col(id_col).alias("doc_id"),
                     F.coalesce(F.regexp_count(F.lower(F.col(text_col)), F.lit(TOKEN_RUN)), F.lit(0)).alias("dl"))
    index = TextIndex(postings=postings, docs=docs)
    if path is None:
        return index
    save_text_index(index, path)
    return load_text_index(df.sparkSession, path)


def save_text_index(index: TextIndex, path: str) -> None:
    """Write the index as Parquet (postings sorted by term within each file,
    which keeps term runs together for compression and min/max pruning)."""
    (index.postings.sortWithinPartitions("term", "doc_id")
     .write.mode("overwrite").parquet(f"{path}/postings"))
    # document lengths come from the written postings: no second tokenising
    # pass; documents without tokens get dl = 0.
    spark = index.postings.sparkSession
    lens = spark.read.parquet(f"{path}/postings").groupBy("doc_id").agg(F.first("dl").alias("dl"))
    index.docs.select("doc_id").join(lens, "doc_id", "left").fillna({"dl": 0}) \
        .write.mode("overwrite").parquet(f"{path}/docs")


def load_text_index(spark: SparkSession, path: str) -> TextIndex:
    return TextIndex(postings=spark.read.parquet(f"{path}/postings"),
                     docs=spark.read.parquet(f"{path}/docs"), materialized=True)


def unit_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 out_id: str = "doc_id") -> DataFrame:
    """``(doc_id, uvec array<double>)`` with each vector scaled to length 1
    (zero vectors stay zero)."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return df.select(F.col(id_col).alias(out_id),
                     F.when(norm > 0, F.transform(v, lambda x: x / norm))
                     .otherwise(v).alias("uvec"))


def build_vector_index(vectors: DataFrame, docs: DataFrame | None = None, path: str | None = None,
                       id_col: str = "doc_id", vec_col: str = "embedding",
                       meta_cols: list[str] | None = None) -> DataFrame:
    """R12 (vectors): ``(doc_id, embedding, <filter columns>)``. The filter
    columns of ``docs`` are joined on once here, so filtered vector searches
    read them from the index instead of joining metadata per query batch.
    With ``path`` the index is written to the shared folder and read back."""
    v = vectors.select(F.col(id_col).alias("doc_id"), F.col(vec_col).alias("embedding"))
    if docs is not None:
        meta = list(meta_cols) if meta_cols is not None else [c for c in FILTER_DOC_COLUMNS if c in docs.columns]
        if meta:
            v = v.join(docs.select("doc_id", *meta), "doc_id")
    if path is None:
        return v
    v.write.mode("overwrite").parquet(path)
    return vectors.sparkSession.read.parquet(path)
