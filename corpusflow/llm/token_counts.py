"""Token counts by an exact length histogram.

Each document's encoded length is counted in its task; the histogram (documents by length)
is one partially aggregated count. Its sums from the short and from the long end answer, for
every context limit at once: how many documents fit, the tokens that truncation keeps and
drops, and any quantile. The sums run over blocks of lengths first and then within each
block, so that no task holds all lengths.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm.bpe import codec, shared_vocabulary
from corpusflow.llm.common import id_text, stored

#: Lengths in a block of the two-level sums.
BLOCK = 1024


def _lengths(ranks, pattern):
    def run(batches):
        own = codec(ranks.value, pattern)
        for batch in batches:
            counts = [own.count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])
    return run


def token_lengths(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens)`` of every row; null and empty texts have length zero."""
    rows = id_text(docs, id_col, text_col)
    return rows.mapInArrow(_lengths(shared_vocabulary(docs.sparkSession, vocabulary), pattern), f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """A row per length that occurs:

    ``n_tokens, n_docs, docs_le, docs_ge, tokens_le, tokens_ge, truncated_tokens, dropped_tokens, quantile``.

    ``docs_le``/``tokens_le``: documents of this length or less and their tokens; ``_ge``: of this
    length or more. ``truncated_tokens``: what remains if each document is cut at this length,
    ``dropped_tokens`` what goes. ``quantile``: the share of documents of this length or less,
    so the q-quantile is the first row with ``quantile >= q``. No rows give no rows.
    """
    counts = stored(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "length-counts")
    counts = counts.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = counts.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}_before") for x in "dt"], *[F.sum(x).over(every).alias(f"{x}_all") for x in "dt"])
    within = Window.partitionBy("block").orderBy("n_tokens")
    return (counts.join(blocks, "block")
            .withColumn("docs_le", F.col("d_before") + F.sum("n_docs").over(within))
            .withColumn("tokens_le", F.col("t_before") + F.sum("tokens").over(within))
            .withColumn("docs_ge", F.col("d_all") - F.col("docs_le") + F.col("n_docs"))
            .withColumn("tokens_ge", F.col("t_all") - F.col("tokens_le") + F.col("tokens"))
            .withColumn("truncated_tokens", F.col("tokens_le") + F.col("n_tokens") * (F.col("d_all") - F.col("docs_le")))
            .select("n_tokens", "n_docs", "docs_le", "docs_ge", "tokens_le", "tokens_ge", "truncated_tokens",
                    (F.col("t_all") - F.col("truncated_tokens")).alias("dropped_tokens"), (F.col("docs_le") / F.col("d_all")).alias("quantile")))


def context_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each limit, lengths that don't occur included: ``context, docs_fit, truncated_tokens, dropped_tokens``."""
    part = F.least("n_tokens", "context") * F.col("n_docs")
    return (histogram.select("n_tokens", "n_docs", F.explode(F.array(*[F.lit(x).cast("long") for x in sorted(set(limits))])).alias("context"))
            .groupBy("context").agg(F.sum(F.when(F.col("n_tokens") <= F.col("context"), F.col("n_docs")).otherwise(0)).alias("docs_fit"),
                                    F.sum(part).alias("truncated_tokens"),
                                    F.sum(F.col("n_tokens") * F.col("n_docs") - part).alias("dropped_tokens")))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """``(share, n_tokens)``: the least length that at least that share of the documents doesn't exceed."""
    return (histogram.select("n_tokens", "quantile", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
            .where("quantile >= share").groupBy("share").agg(F.min("n_tokens").alias("n_tokens")))
