"""Index upsert, lineage, run statistics, quarantine, corpus
statistics, document summary, job status and the versioned index.

Every table here is an ordinary DataFrame; persistence is Parquet snapshots in
the shared folder (a new directory per version, never overwriting what is
being read), so a lost executor or a re-run cannot leave a half-written index.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.operators.sizing import BROADCAST_MAX_ROWS, bounded_count, sized_broadcast

# ------------------------------------------------------------------ G1

def _latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key as an aggregation (``max_by`` over the order
    columns): partial aggregation keeps one row per key per task before the
    shuffle, so a key with a huge number of copies is not sorted in one task."""
    others = [c for c in rows.columns if c not in keys]
    # nulls in the order columns rank lowest (as desc_nulls_last would)
    ordkey = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order])
    best = F.max_by(F.struct(*[F.col(c) for c in others]), ordkey).alias("__best")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in others])


def upsert(existing: DataFrame | None, updates: DataFrame, key: str | list[str] = "chunk_id",
           order: list[str] | None = None) -> DataFrame:
    """Keyed upsert: for each key keep the row with the greatest ``order``
    columns (default ``ingest_ts``, ``batch_id``).

    Only keys present in ``updates`` are re-ranked: the update keys are
    broadcast (after a size check) and split the existing table map-side into
    untouched rows, passed through without a shuffle, and touched rows, which
    are ranked together with the updates. Each key's window holds only its own
    versions."""
    keys = [key] if isinstance(key, str) else list(key)
    order = order or ["ingest_ts", "batch_id"]
    if existing is None:
        return _latest(updates, keys, order)
    upd_keys = sized_broadcast(updates.select(*keys).distinct())
    untouched = existing.join(upd_keys, keys, "left_anti")
    touched = existing.join(upd_keys, keys, "left_semi")
    merged = _latest(touched.unionByName(updates, allowMissingColumns=True), keys, order)
    return untouched.unionByName(merged, allowMissingColumns=True)


def _located(rows: DataFrame) -> DataFrame:
    """Rows of a written table with the place they were read from."""
    return rows.withColumns({"__file": F.col("_metadata.file_name"), "__row": F.col("_metadata.row_index")})


def newest_rows(rows: DataFrame, keys: list[str], order: list[str], scratch: str) -> DataFrame:
    """Of the rows that repeat a key the one with the greatest ``order`` columns, of equal ones that of the
    later ``__layer``; rows of a full snapshot (layer -1) whose key no layer has stay as they are. ``rows``
    is a written table with ``__layer``, ``__file`` and ``__row``, which together are unique.

    Contents aren't shuffled to find out: hashes of the keys are counted, those that repeat are kept under
    ``scratch``, and only they are looked at. Rows are then dropped by a broadcast join, or by one shuffled
    hash join, which sorts no contents, if many keys repeat. Null keys match nothing, as in a join: each layer keeps its own.
    """
    spark, place = rows.sparkSession, ["__layer", "__file", "__row"]
    null_key = F.lit(False)
    for c in keys:
        null_key = null_key | F.col(c).isNull()
    rows = rows.withColumns({"__null_in": F.when(null_key, F.col("__layer")).otherwise(F.lit(-1)),
                             "__hash": F.xxhash64(*keys, F.when(null_key, F.col("__layer")))})
    path = f"{scratch}/repeated/{uuid.uuid4().hex[:12]}"
    # a key of the full snapshot alone doesn't count: max(__layer) is -1
    rows.groupBy("__hash").agg(F.count(F.lit(1)).alias("n"), F.max("__layer").alias("last")) \
        .where((F.col("n") > 1) & (F.col("last") >= 0)).select("__hash").write.parquet(path)
    repeated = spark.read.schema("__hash long").parquet(path)
    helpers = [*place, "__null_in", "__hash"]
    n = bounded_count(repeated, BROADCAST_MAX_ROWS)
    if n == 0:
        return rows.drop(*helpers)
    small = n <= BROADCAST_MAX_ROWS
    # nulls in the order columns rank lowest (as desc_nulls_last would)
    rank = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order], *place)
    suspects = rows.join(F.broadcast(repeated), "__hash", "left_semi") if small else rows
    best = suspects.groupBy(*keys, "__null_in", "__hash").agg(F.max(rank).alias("__best"), F.count(F.lit(1)).alias("__n"),
                                                              F.max("__layer").alias("__last"))
    best = best.where((F.col("__n") > 1) & (F.col("__last") >= 0)).select(
        "__hash", F.struct(*keys, "__null_in").alias("__key"), F.col("__best.__layer").alias("__bl"),
        F.col("__best.__file").alias("__bf"), F.col("__best.__row").alias("__br"))
    same = F.struct(*keys, "__null_in").eqNullSafe(F.col("__key"))
    joined = rows.withColumnRenamed("__hash", "__h").join(
        F.broadcast(best) if small else best.hint("shuffle_hash"), (F.col("__h") == F.col("__hash")) & same, "left")
    kept = F.col("__bl").isNull() | ((F.col("__layer") == F.col("__bl")) & (F.col("__file") == F.col("__bf")) & (F.col("__row") == F.col("__br")))
    return joined.where(kept).drop(*helpers, "__h", "__key", "__bl", "__bf", "__br")


class SnapshotTable:
    """A table kept as numbered versions in the shared folder, none of which is ever changed: full
    snapshots ``<base>/v=<n>`` and, for upserts, layers ``<base>/__layer=<n>`` that hold the upserted
    rows alone, each with a ``_SUCCESS`` marker. The current version is the highest complete one.

    An upsert writes its own rows, without a shuffle and without reading the table. A reader takes the
    last full snapshot and the layers after it and, of rows that repeat a key, the newest
    (:func:`newest_rows`); ``compact`` writes that as a full snapshot."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _complete(self, prefix: str) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.base)
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            return []
        out = []
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if name.startswith(prefix) and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[len(prefix):]))
        return sorted(out)

    def _versions(self) -> list[int]:
        return sorted(self._complete("v=") + self._complete("__layer="))

    def current_version(self) -> int | None:
        v = self._versions()
        return v[-1] if v else None

    def _next(self) -> int:
        cur = self.current_version()
        return cur + 1 if cur is not None else 0

    def _layers(self) -> list[int]:
        full = self._complete("v=")
        return [n for n in self._complete("__layer=") if not full or n > full[-1]]

    def read(self) -> DataFrame | None:
        full, layers = self._complete("v="), self._layers()
        if not layers:
            return self.spark.read.parquet(f"{self.base}/v={full[-1]}") if full else None
        # the layers' own columns may differ; a column that a layer lacks is null in its rows
        rows = self.spark.read.option("basePath", self.base).option("mergeSchema", len(layers) > 1) \
            .parquet(*[f"{self.base}/__layer={n}" for n in layers]).withColumn("__layer", F.col("__layer").cast("int"))
        rows = _located(rows)
        if full:
            old = self.spark.read.parquet(f"{self.base}/v={full[-1]}").withColumn("__layer", F.lit(-1))
            rows = _located(old).unionByName(rows, allowMissingColumns=True)
        keys, order = self._merge()
        return newest_rows(rows, keys, order, self.base)

    def write(self, df: DataFrame) -> int:
        """Write ``df`` as a full snapshot, the version after the current one."""
        version = self._next()
        df.write.mode("overwrite").parquet(f"{self.base}/v={version}")
        return version

    def append(self, updates: DataFrame, keys: list[str], order: list[str]) -> int:
        """Write ``updates`` as the layer after the current version. All layers since a full snapshot
        share their keys and order; with others the table is compacted first."""
        active = self._layers()
        if active and self._merge() != (keys, order):
            self.compact()
            active = []
        if not active:
            path, fs = self._path("merge.json")
            out = fs.create(path, True)
            out.write(bytearray(json.dumps([keys, order]).encode()))
            out.close()
        version = self._next()
        updates.write.mode("overwrite").parquet(f"{self.base}/__layer={version}")
        return version

    def compact(self) -> int | None:
        """The current rows as a full snapshot; None if the table has no version."""
        rows = self.read()
        return None if rows is None else self.write(rows)

    def _merge(self) -> tuple[list[str], list[str]]:
        text = self.spark.read.text(f"{self.base}/merge.json", wholetext=True).first()[0]
        keys, order = json.loads(text)
        return keys, order

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _commit(self, stream: str, batch_id: int):
        return self._path(f"commits/{stream}/{batch_id}")

    def committed(self, stream: str, batch_id: int) -> bool:
        """Whether the batch of that stream (named by its checkpoint) is in the table."""
        path, fs = self._commit(stream, batch_id)
        return fs.exists(path)

    def commit(self, stream: str, batch_id: int) -> None:
        """Note a batch as done, after its snapshot is complete. A batch that failed in between
        is upserted again, by key, which changes nothing."""
        path, fs = self._commit(stream, batch_id)
        fs.create(path, True).close()

    def side(self, name: str) -> str:
        """Folder of a side table (quarantine, lineage, run counts), a subfolder per batch."""
        return f"{self.base}/{name}"


def upsert_snapshot(store: SnapshotTable, updates: DataFrame, key: str | list[str] = "chunk_id",
                    order: list[str] | None = None) -> int:
    """G1 persisted: the updates as the table's next version, as :func:`upsert` would make it."""
    keys = [key] if isinstance(key, str) else list(key)
    return store.append(updates, keys, list(order or ["ingest_ts", "batch_id"]))


# ----------------------------------------------------------------- G2-G4

def lineage(chunks: DataFrame, run_id: str, doc_col: str = "document_id") -> DataFrame:
    """One lineage row per document of a run: ``run_id, document_id,
    source_type, source_uri, ingestion_ts, chunk_count, chunking_method``."""
    return chunks.groupBy(doc_col, "source_type", "source_uri", "chunking_method").agg(
        F.count(F.lit(1)).alias("chunk_count"), F.max("ingestion_ts").alias("ingestion_ts")) \
        .withColumn("run_id", F.lit(run_id))


def run_stats(status: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """``total, successful, failed, total_chunks`` from a per-item status
    table ``(status, chunk_count)``; one row, or one per ``group_cols``."""
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("status") == "ok").alias("successful"),
            F.count_if(F.col("status") != "ok").alias("failed"),
            F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("chunk_count"))), F.lit(0)).alias("total_chunks")]
    g = status.groupBy(*group_cols) if group_cols else status.groupBy()
    return g.agg(*aggs)


def split_quarantine(df: DataFrame, ok: "F.Column", error: "F.Column") -> tuple[DataFrame, DataFrame]:
    """Per-item error isolation: rows passing ``ok`` continue; the others
    get an ``error`` text and go to quarantine (nothing is dropped)."""
    good = df.where(ok)
    bad = df.where(~ok | ok.isNull()).withColumn("error", error)
    return good, bad


# ----------------------------------------------------------------- G6-G9

def corpus_stats(docs: DataFrame, chunk_counts: DataFrame, ts_col: str = "doc_date") -> DataFrame:
    """One pass with GROUPING SETS ((source_type), (document_type), ()):
    documents, chunks and last update per source type, per document type and
    overall. ``grouping`` says which level a row is."""
    j = docs.join(chunk_counts, "doc_id", "left").fillna({"chunk_count": 0})
    g = j.groupingSets([["source_type"], ["document_type"], []], "source_type", "document_type").agg(
        F.count_distinct("doc_id").alias("documents"), F.sum("chunk_count").alias("chunks"),
        F.max(ts_col).alias("last_updated"), F.grouping_id().alias("__gid"))
    level = F.when(F.col("__gid") == 1, "source_type").when(F.col("__gid") == 2, "document_type").otherwise("total")
    key = F.when(F.col("__gid") == 1, F.col("source_type")).when(F.col("__gid") == 2, F.col("document_type"))
    return g.select(level.alias("grouping"), key.alias("key"), "documents", "chunks", "last_updated")


def document_summary(docs: DataFrame, chunk_counts: DataFrame) -> DataFrame:
    """Documents with chunk count and ``indexed``/``pending`` status."""
    j = docs.join(chunk_counts, "doc_id", "left").fillna({"chunk_count": 0})
    return j.withColumn("status", F.when(F.col("chunk_count") > 0, "indexed").otherwise("pending"))


def job_status(runs: DataFrame, job_id: str | None = None) -> DataFrame:
    """Job rows (all, or the one asked for) with a derived state."""
    r = runs if job_id is None else runs.where(F.col("job_id") == job_id)
    return r.withColumn("state", F.when(F.col("failed") > 0, "completed_with_errors").otherwise("completed"))


def versioned_index(versions: DataFrame, key: str = "doc_id", ts_col: str = "ingest_ts",
                    content_col: str = "content", slices: int | None = None) -> DataFrame:
    """Audit history per document. Consecutive ingests with unchanged
    content (same sha2) collapse into one version; each version gets
    ``version`` (1, 2, ...), ``valid_from``, ``valid_to`` (next version's
    start, null for the current one) and ``is_current``.

    Skew-safe: the ordering work runs on a narrow ``(key, ts, sha)`` skeleton
    range-partitioned by ``(key, ts)``, so one document with a huge history is
    split over many slices. Lags and numbering are computed inside each
    ``(key, slice)`` and stitched across slice boundaries through a small
    per-slice summary (at most one row per slice per document). The content is
    joined back once on ``(key, ts, sha)``. The slice number of every skeleton row
    is checkpointed, so all branches of the plan see the same slices. Several
    ingests of a document at one time count as one, the one whose hash is greatest.
    """
    spark = versions.sparkSession
    n = slices or spark.sparkContext.defaultParallelism
    sha = F.sha2(F.col(content_col), 256)
    # one content per document and time: of several the greatest hash
    sk = (versions.select(key, ts_col, sha.alias("content_sha")).groupBy(key, ts_col).agg(F.max("content_sha").alias("content_sha"))
          .repartitionByRange(n, key, ts_col).withColumn("__s", F.spark_partition_id()).checkpoint())
    w_in = Window.partitionBy(key, "__s").orderBy(ts_col)
    sk = sk.withColumn("__prev", F.lag("content_sha").over(w_in)).withColumn("__rn", F.row_number().over(w_in))
    # last hash of every slice, and the previous slice's last hash per document
    w_doc = Window.partitionBy(key).orderBy("__s")
    ends = sk.groupBy(key, "__s").agg(F.max_by("content_sha", ts_col).alias("__last")) \
             .withColumn("__prev_slice", F.lag("__last").over(w_doc)).drop("__last")
    sk = sk.join(ends, [key, "__s"])
    prev = F.when(F.col("__rn") == 1, F.col("__prev_slice")).otherwise(F.col("__prev"))
    kept = sk.where(prev.isNull() | (prev != F.col("content_sha"))).select(key, ts_col, "content_sha", "__s")
    kept = kept.withColumn("__kr", F.row_number().over(w_in)).withColumn("__next", F.lead(ts_col).over(w_in))
    # kept versions before each slice, and the first kept start of the next slice
    summ = kept.groupBy(key, "__s").agg(F.count(F.lit(1)).alias("__kc"), F.min(ts_col).alias("__first"))
    summ = summ.withColumn("__offset", F.coalesce(F.sum("__kc").over(
                 w_doc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
               .withColumn("__next_slice", F.lead("__first").over(w_doc)).select(key, "__s", "__offset", "__next_slice")
    kept = kept.join(summ, [key, "__s"])
    valid_to = F.coalesce(F.col("__next"), F.col("__next_slice"))
    hist = kept.select(key, ts_col, "content_sha", (F.col("__offset") + F.col("__kr")).alias("version"),
                       F.col(ts_col).alias("valid_from"), valid_to.alias("valid_to"),
                       valid_to.isNull().alias("is_current"))
    rows = versions.withColumn("content_sha", sha).dropDuplicates([key, ts_col, "content_sha"])
    return rows.join(hist, [key, ts_col, "content_sha"])
