"""Size-checked broadcast and deterministic top-k helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows above which a side is never broadcast by us; AQE may still convert a
# shuffle join to a broadcast join at run time from measured stage sizes.
BROADCAST_MAX_ROWS = 200_000


def bounded_count(df: DataFrame, bound: int) -> int:
    """Count rows, stopping at ``bound + 1`` (cheap on large inputs)."""
    return df.limit(bound + 1).count()


def fits(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True if ``df`` provably has at most ``max_rows`` rows."""
    return bounded_count(df, max_rows) <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it provably has at most ``max_rows`` rows;
    otherwise return it unchanged so the join shuffles."""
    if bounded_count(df, max_rows) <= max_rows:
        return F.broadcast(df)
    return df


def split_repeated(df: DataFrame, keys: list[str], scratch: str) -> tuple[DataFrame, DataFrame | None]:
    """``df``'s rows whose key is theirs alone, and those whose key may repeat (None if there are none). Only
    hashes of the keys are shuffled; those that repeat are kept under ``scratch`` and broadcast where
    they fit. ``df`` must read the same each time, as a written table does."""
    h = F.xxhash64(*keys)
    df.groupBy(h.alias("__hash")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("__hash").write.parquet(scratch)
    seen = df.sparkSession.read.schema("__hash long").parquet(scratch)
    n = bounded_count(seen, BROADCAST_MAX_ROWS)
    if n == 0:
        return df, None
    seen = F.broadcast(seen) if n <= BROADCAST_MAX_ROWS else seen.hint("shuffle_hash")
    on = h == seen["__hash"]
    return df.join(seen, on, "left_anti"), df.join(seen, on, "left_semi")


def rank_order(score: str | Column, tie: str = "doc_id", digits: int = 9) -> list[Column]:
    """Deterministic rank order: rounded score descending, id ascending."""
    s = F.col(score) if isinstance(score, str) else score
    return [F.round(s, digits).desc(), F.col(tie).asc()]


def top_k(df: DataFrame, k: int, score: str, part: str = "query_id", tie: str = "doc_id",
          digits: int = 9, rank_col: str = "rank") -> DataFrame:
    """Per-partition top-k with ``row_number``; Spark's window-group-limit
    keeps only k rows per group before the shuffle."""
    w = Window.partitionBy(part).orderBy(*rank_order(score, tie, digits))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def minmax_normalize(df: DataFrame, score: str, out: str, part: str = "query_id") -> DataFrame:
    """Min-max scale within each group; all-equal groups get 1.0."""
    w = Window.partitionBy(part)
    mn, mx = F.min(score).over(w), F.max(score).over(w)
    return df.withColumn(out, F.when(mx == mn, F.lit(1.0))
                         .otherwise((F.col(score) - mn) / (mx - mn)))
