"""A keyword index organised by term, for repeated BM25 searches.

On disk (shared folder, Parquet):

* ``blocks/bucket=<b>/`` - postings by hash bucket of the term. A row is a block of up to ``BLOCK``
  postings of one term, those with the highest impact (BM25 weight without the idf) first, with the
  highest impact of the block as ``bound``. A very frequent term is many blocks, spread over
  files by the range sort that writes them; no task ever holds a whole posting list.
* ``terms/bucket=<b>/`` - document frequency and highest impact of each term.
* ``metas/`` - the distinct values of the filter columns, which postings name by number.
* ``docs/``, ``stats/`` - lengths of all documents; their number and mean length, k1 and b.

A search reads the buckets of its terms alone. For short queries the first blocks give a score that the query's
k-th document reaches at least; a block is skipped if its bound, with the highest impacts of the
query's other terms, stays below that, for then none of its documents can be among the k best.
Documents that can are in no skipped block, so their scores are whole and the result is exact.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.functions.text import tokens
from corpusflow.operators.index import FILTER_DOC_COLUMNS
from corpusflow.operators.sizing import sized_broadcast

BUCKETS = 64
BLOCK = 256
#: Pairs of query and posting that fall to a scoring task, about.
TASK_PAIRS = 4_000_000
#: Scores this far below the k-th can't reach it by rounding.
SLACK = 1e-6
#: Queries with more terms read all blocks of their terms.
SKIP_TERMS = 8


def term_counts(toks: Column) -> Column:
    """``array<struct<term, tf>>`` of a token array, counted inside the row: the sorted array is cut where
    neighbours differ. The array is bound once, so the work is that of the sort."""
    def runs(s):
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return F.transform(F.array(starts), lambda a: F.transform(
            F.arrays_zip(a.alias("a"), F.concat(F.slice(a, 2, F.size(a)), F.array(F.size(s))).alias("b")),
            lambda x: F.struct(F.get(s, x["a"]).alias("term"), (x["b"] - x["a"]).alias("tf"))))
    # sort_array, as array_sort compares by an interpreted function
    bound = F.transform(F.array(F.sort_array(toks)), lambda s: F.get(runs(s), 0))
    return F.when(F.size(toks) > 0, F.get(bound, 0))


def bucket_of(term: Column, buckets: int) -> Column:
    """Ranges of the hash, so that what is sorted by the hash lies bucket by bucket."""
    high = F.shiftright(F.xxhash64(term), 32).cast("long") + F.lit(1 << 31)
    return F.shiftright(high * F.lit(buckets), 32).cast("int")


def impact(k1: float, b: float, avg_dl: float) -> Column:
    """BM25 weight of a posting without its idf."""
    return F.col("tf") * (k1 + 1.0) / (F.col("tf") + k1 * (1.0 - b + b * F.col("dl") / F.lit(avg_dl)))


@dataclass
class TermIndex:
    path: str
    blocks: DataFrame   # bucket, term, block, bound, postings
    terms: DataFrame    # bucket, term, df, best
    docs: DataFrame     # doc_id, dl
    n: int
    avg_dl: float
    buckets: int
    k1: float
    b: float
    columns: list[str] = field(default_factory=list)  # filter columns
    metas: DataFrame | None = None  # meta, filter columns: the values that postings name by number


def _cut_blocks(names: list[str]):
    """Rows sorted by term and falling impact -> blocks. What is left of a batch's last block
    goes on with the next batch."""
    def run(batches):
        rest, number = None, 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            blocks, rest, number = cut(table.combine_chunks(), number, False)
            if blocks is not None:
                yield blocks
        if rest is not None and rest.num_rows:
            yield cut(rest.combine_chunks(), number, True)[0]

    def cut(table, number, last):
        n = table.num_rows
        if not n:
            return None, None, 0
        term = table.column("term").combine_chunks()
        new = np.concatenate(([True], pc.not_equal(term.slice(1), term.slice(0, n - 1)).to_numpy(zero_copy_only=False)))
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(new, at, 0))
        begins = np.flatnonzero((at - start) % BLOCK == 0)
        block = (begins - start[begins]) // BLOCK
        block[start[begins] == 0] += number  # the first run goes on from the batch before
        end = n if last else begins[-1]
        open_number = 0 if last else int(block[-1])
        rows = begins if last else begins[:-1]
        rest = None if last else table.slice(begins[-1])
        if not len(rows):
            return None, rest, open_number
        closed = table.slice(0, end).combine_chunks()
        column = lambda c: closed.column(c).combine_chunks()
        items = pa.StructArray.from_arrays([column(c) for c in names], names)
        first = pa.array(rows)
        ends = np.append(rows, end).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            column("term").take(first), pa.array(block[:len(rows)].astype(np.int32)), column("impact").take(first),
            pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends), items)],
            ["term", "block", "bound", "n", "postings"]), rest, open_number
    return run


@contextmanager
def _rows_bound_batches(spark: SparkSession):
    """Arrow batches bounded by their number of rows alone: against a bound in bytes Spark measures the batch
    anew with every row, which for rows as narrow as postings costs more than handing them over."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(2 ** 31 - 1))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def build_term_index(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     meta_cols: list[str] | None = None, buckets: int = BUCKETS, k1: float = 1.2, b: float = 0.75) -> TermIndex:
    """Write the index of ``df`` under ``path`` and load it. Null and empty texts are documents of
    length 0. ``meta_cols`` (default: the filter columns that ``df`` has) are numbered by their distinct
    values, and each posting has its document's number."""
    spark = df.sparkSession
    meta = list(meta_cols) if meta_cols is not None else [c for c in FILTER_DOC_COLUMNS if c in df.columns]
    rows = df.select(F.col(id_col).alias("doc_id"), *meta, tokens(text_col).alias("toks"))
    counted = rows.select("doc_id", *meta, F.greatest(F.size("toks"), F.lit(0)).alias("dl"), term_counts(F.col("toks")).alias("counts"))
    counted.write.parquet(f"{path}/counts")  # one pass over the texts
    counted = spark.read.parquet(f"{path}/counts")
    kinds = {f.name: f.dataType.simpleString() for f in counted.schema}
    if meta:  # a posting has the number of its filter values, not the values
        counted.select(*meta).distinct().withColumn("meta", F.monotonically_increasing_id()).write.parquet(f"{path}/metas")
        metas = sized_broadcast(spark.read.parquet(f"{path}/metas").select("meta", F.struct(*meta).alias("values")))
        counted = counted.withColumn("own", F.struct(*meta)).join(metas, F.col("own").eqNullSafe(F.col("values")))
    counted.select("doc_id", "dl").write.parquet(f"{path}/docs")
    stats = counted.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("dl"), F.lit(0.0)).alias("avg_dl"))
    stats = stats.withColumns({"buckets": F.lit(buckets), "k1": F.lit(float(k1)), "b": F.lit(float(b))})
    stats.write.parquet(f"{path}/stats")
    avg_dl = spark.read.parquet(f"{path}/stats").first()["avg_dl"]
    ids = ["meta"] if meta else []
    # sorted by a hash of the term first, which gives each task few buckets to write and decides most comparisons without looking at the strings
    postings = (counted.select("doc_id", *ids, "dl", F.inline("counts"))
                .withColumns({"hash": F.xxhash64("term"), "impact": impact(k1, b, avg_dl)}))
    names = ["doc_id", "tf", "dl", *ids]
    order = ["hash", "term", F.desc("impact"), "doc_id"]
    blocks = (postings.select("hash", "term", "impact", *names).repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(_cut_blocks(names), f"term string, block int, bound double, n int, postings {_postings_type(kinds, meta)}")
              .withColumn("bucket", bucket_of(F.col("term"), buckets)))
    with _rows_bound_batches(spark):
        blocks.write.partitionBy("bucket").parquet(f"{path}/blocks")
    # a term's blocks are few and lie together: counted there, postings needn't be shuffled for it
    sizes = spark.read.schema("term string, bound double, n int, bucket int").parquet(f"{path}/blocks")
    (sizes.groupBy("bucket", "term").agg(F.sum("n").alias("df"), F.max("bound").alias("best"))
     .write.partitionBy("bucket").parquet(f"{path}/terms"))
    return load_term_index(spark, path)


def load_term_index(spark: SparkSession, path: str) -> TermIndex:
    s = spark.read.parquet(f"{path}/stats").first()
    kinds = {f.name: f.dataType.simpleString() for f in spark.read.parquet(f"{path}/counts").schema}
    meta = [c for c in kinds if c not in ("doc_id", "dl", "counts")]
    metas = spark.read.parquet(f"{path}/metas") if meta else None
    blocks = spark.read.schema(f"term string, block int, bound double, postings {_postings_type(kinds, meta)}, bucket int").parquet(f"{path}/blocks")
    terms = spark.read.schema("term string, df long, best double, bucket int").parquet(f"{path}/terms")
    return TermIndex(path, blocks, terms, spark.read.parquet(f"{path}/docs"), s["n"], s["avg_dl"], s["buckets"], s["k1"], s["b"], meta, metas)


def _postings_type(kinds: dict[str, str], meta: list[str]) -> str:
    item = f"doc_id: {kinds['doc_id']}, tf: int, dl: int" + (", meta: bigint" if meta else "")
    return f"array<struct<{item}>>"


def matching_blocks(index: TermIndex, terms: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """Blocks and term rows of the buckets that ``terms`` fall in, and these buckets (``index.buckets`` at most)."""
    wanted = sorted(r[0] for r in terms.select(bucket_of(F.col("term"), index.buckets)).distinct().collect())
    return index.blocks.where(F.col("bucket").isin(wanted)), index.terms.where(F.col("bucket").isin(wanted)), wanted


def term_index_scores(index: TermIndex, query_terms: DataFrame, k: int | None, fields=(), predicate: Column | None = None,
                      k1: float = 1.2, b: float = 0.75, small: bool = False, skipped: bool = False) -> DataFrame:
    """``(query_id, doc_id, score)``: BM25 of ``query_terms`` (``query_id, term`` and the filters' columns, each
    pair once). With ``k`` (and the index's own k1 and b) at least the k best of each query, scores whole;
    without it all documents. ``small``: the terms may be broadcast. ``skipped`` returns instead what
    the searches make of the blocks, ``(query_id, term, block, skip)``.

    Blocks are skipped for queries of ``SKIP_TERMS`` terms at most: with more, what a query has to spare hardly ever
    falls below a block's distance to its term's best, and finding it out costs more than it saves.
    """
    blocks, terms, _ = matching_blocks(index, query_terms)
    idf = F.log(1.0 + (F.lit(index.n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    side = F.broadcast if small else (lambda d: d)
    known = terms.join(side(query_terms.select("term").distinct()), "term", "left_semi").select("term", "df", idf.alias("idf"), "best")
    weighted = query_terms.join(side(known), "term").withColumn("spare", F.lit(float("inf")))
    if k is not None and k1 == index.k1 and b == index.b:
        weighted = weighted.drop("spare").join(side(_spare(index, blocks, weighted, k, fields, predicate, side)), "query_id", "left") \
            .withColumn("spare", F.coalesce("spare", F.lit(float("inf"))))
    lack = F.col("idf") * (F.col("best") - F.col("bound"))  # what the block lacks to its term's best
    if skipped:
        return blocks.join(side(weighted), "term").select("query_id", "term", "block", (lack > F.col("spare") + SLACK).alias("skip"))
    return _scored(index, blocks, weighted, fields, predicate, side, lack, k1, b)


def _scored(index: TermIndex, blocks: DataFrame, weighted: DataFrame, fields, predicate: Column | None, side, lack: Column, k1: float, b: float) -> DataFrame:
    """Blocks that some query needs (``lack`` is at most what it has to spare) are dealt out anew, so that the many of a frequent term, which lie in
    a file or two, don't fall to one task; opened once, their postings are dealt out by document. There they meet the
    queries that need them, so that pairs of query and document are never shuffled: their sums form where they arise."""
    needed = F.col("lack") <= F.col("spare") + SLACK
    context = blocks.sparkSession.sparkContext
    tasks = max(2 * context.defaultParallelism, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    widest = weighted.groupBy("term").agg(F.first("idf").alias("idf"), F.first("best").alias("best"), F.max("spare").alias("spare"))
    columns = list(dict.fromkeys(f[1] for f in fields))
    names = ["doc_id", "tf", "dl", *(["meta"] if columns else [])]
    postings = (blocks.join(side(widest), "term").withColumn("lack", lack).where(needed).repartition(tasks, "term", "block")
                .select("term", "idf", "lack", F.inline(F.arrays_zip(*[F.col(f"postings.{c}").alias(c) for c in names]))))
    weight = F.col("idf") * impact(k1, b, index.avg_dl)
    postings = postings.select("term", "lack", "doc_id", weight.alias("weight"), *names[3:])
    # as many tasks as the pairs that they add up ask for
    pairs = weighted.agg(F.sum("df")).first()[0] or 0
    matched = postings.repartition(max(tasks, -(-pairs // TASK_PAIRS)), "doc_id").join(side(weighted.drop("idf", "best", "df")), "term").where(needed)
    if columns:
        matched = matched.join(sized_broadcast(index.metas.select("meta", *columns)), "meta")
    if predicate is not None:
        matched = matched.where(predicate)
    return matched.groupBy("query_id", "doc_id").agg(F.sum("weight").alias("score"))


def _spare(index: TermIndex, blocks: DataFrame, weighted: DataFrame, k: int, fields, predicate, side) -> DataFrame:
    """``(query_id, spare)`` of short queries: their highest possible score less what the first blocks alone
    give their k-th document."""
    size = weighted.groupBy("query_id").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("idf") * F.col("best")).alias("most")).where(F.col("size") <= SKIP_TERMS)
    short = weighted.join(side(size.select("query_id")), "query_id", "left_semi")
    first = _scored(index, blocks.where("block = 0"), short, fields, predicate, side, F.lit(0.0), index.k1, index.b)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    least = first.withColumn("place", place).where(F.col("place") <= k).groupBy("query_id").agg(
        F.min("score").alias("least"), F.count(F.lit(1)).alias("found")).where(F.col("found") == k)
    return size.join(least, "query_id").select("query_id", (F.col("most") - F.col("least")).alias("spare"))
