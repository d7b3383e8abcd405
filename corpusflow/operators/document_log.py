"""G1 as a log: an index table whose revisions replace whole documents.

``DocumentLog`` keeps, under one base folder in the shared store:

* ``layers/<n>-<id>/rows/bucket=<b>/`` - the chunks that revision ``n`` brought, by hash bucket of the document;
* ``layers/<n>-<id>/documents/`` - the documents it replaced or deleted (its tombstones);
* ``manifests/<n>.json`` - the layers that make up version ``n``, written last, by renaming.

A revision writes its own layer only: no earlier file is changed or read. A reader takes a document's rows
from the last layer that names it, so a shorter revision leaves no old chunks behind, and a document
without rows is gone. A job that dies before its manifest leaves the version before as it was.
``compact`` writes one layer with what is current.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

BUCKETS = 32


class DocumentLog:
    """``key`` is the column that names a row's document; null isn't allowed in it."""

    def __init__(self, spark: SparkSession, base: str, key: str = "document_id", buckets: int = BUCKETS):
        self.spark, self.base, self.key, self.buckets = spark, base.rstrip("/"), key, buckets

    # ---- manifests

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        path, fs = self._fs(f"{self.base}/manifests")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def layers(self, version: int | None = None) -> list[str]:
        """Layer folders of a version (default: the current one), oldest first."""
        version = self.current_version() if version is None else version
        if version is None:
            return []
        path, fs = self._fs(f"{self.base}/manifests/{version}.json")
        if not fs.exists(path):
            raise ValueError(f"no version {version} in {self.base}")
        text = self.spark.read.text(path.toString(), wholetext=True).first()[0]
        return json.loads(text)["layers"]

    def _publish(self, version: int, layers: list[str]) -> int:
        draft, fs = self._fs(f"{self.base}/manifests/.{version}-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps({"version": version, "layers": layers}).encode()))
        out.close()
        target, _ = self._fs(f"{self.base}/manifests/{version}.json")
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise RuntimeError(f"version {version} of {self.base} was written by another job")
        return version

    # ---- writing

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _write_layer(self, version: int, rows: DataFrame, documents: DataFrame) -> str:
        layer = f"layers/{version}-{uuid.uuid4().hex[:12]}"
        # sorted by bucket, a task writes one file a bucket at a time; no shuffle
        (rows.withColumn("bucket", self._bucket()).sortWithinPartitions("bucket")
         .write.partitionBy("bucket").parquet(f"{self.base}/{layer}/rows"))
        documents.write.parquet(f"{self.base}/{layer}/documents")
        schema, fs = self._fs(f"{self.base}/{layer}/schema.json")  # a layer without rows has no Parquet to tell it
        out = fs.create(schema, False)
        out.write(bytearray(rows.schema.json().encode()))
        out.close()
        return layer

    def replace(self, rows: DataFrame, documents: DataFrame | None = None) -> int:
        """The next version: the rows of every document in ``documents`` (default: those in ``rows``) are those in ``rows``.

        A document of ``documents`` without rows is deleted; one of ``rows`` that ``documents`` doesn't name is replaced
        too. Rows are kept as given, repeats included. Columns new to the table are null in older rows.
        """
        if "bucket" in rows.columns:
            raise ValueError("the column name bucket is taken by the log")
        version = self.current_version()
        layers = self.layers(version) if version is not None else []
        named = rows.select(self.key)
        if documents is not None:
            named = named.unionByName(documents.select(self.key))
        after = 0 if version is None else version + 1
        layer = self._write_layer(after, rows, named.where(F.col(self.key).isNotNull()).distinct())
        return self._publish(after, [*layers, layer])

    def delete(self, documents: DataFrame) -> int:
        """The next version, without ``documents``."""
        current = self.read()
        if current is None:
            raise ValueError("nothing to delete from")
        return self.replace(current.limit(0), documents)

    def compact(self) -> int | None:
        """The next version with the current rows in one layer; None if there's one at most."""
        version, layers = self.current_version(), self.layers()
        if len(layers) < 2:
            return None
        rows = self.read()
        layer = self._write_layer(version + 1, rows, self.spark.createDataFrame([], rows.select(self.key).schema))
        return self._publish(version + 1, [layer])

    # ---- reading

    def _schema(self, layer: str):
        return StructType.fromJson(json.loads(self.spark.read.text(f"{self.base}/{layer}/schema.json", wholetext=True).first()[0]))

    def read(self, version: int | None = None, documents: list | None = None) -> DataFrame | None:
        """Rows of a version (default: the current one), None before the first. ``documents``, a short list of
        names, reads their buckets alone.

        Each layer but the last loses the documents that later ones name by an anti join, which Spark
        broadcasts for small revisions and splits where skewed for large ones; the last is read as it is.
        """
        layers = self.layers(version)
        if not layers:
            return None
        kept, later = [], None
        for layer in reversed(layers):
            schema = self._schema(layer)
            rows = self.spark.read.schema(schema.add("bucket", IntegerType())).parquet(f"{self.base}/{layer}/rows")
            if documents is not None:
                names = self.spark.createDataFrame([(d,) for d in documents], rows.select(self.key).schema)
                wanted = [r[0] for r in names.select(self._bucket()).distinct().collect()]
                rows = rows.where(F.col("bucket").isin(wanted) & F.col(self.key).isin(list(documents)))
            rows = rows.drop("bucket")
            kept.append(rows if later is None else rows.join(later, self.key, "left_anti"))
            named = self.spark.read.parquet(f"{self.base}/{layer}/documents")
            later = named if later is None else later.unionByName(named)
        out = kept[-1]
        for rows in reversed(kept[:-1]):
            out = out.unionByName(rows, allowMissingColumns=True)
        return out
