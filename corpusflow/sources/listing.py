"""A batch data source that lists objects: ``key, path, size, last_modified``.

Spark's own file sources plan bytes, so a zero-length object gives no split
and no row. Here folders are dealt to tasks, which list them through
``pyarrow.fs`` (local, HDFS or S3 URIs), and every object is a row. The driver
opens folders level by level only until there are enough to deal out.
"""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FOLDERS = 256    # folders at which the driver stops opening further levels
BATCH = 10_000
SCHEMA = pa.schema([("key", pa.string()), ("path", pa.string()), ("size", pa.int64()),
                    ("last_modified", pa.timestamp("us", tz="UTC"))])


def fs_uri(uri: str) -> str:
    if uri.startswith("file:") and not uri.startswith("file://"):
        return "file://" + uri[len("file:"):]
    if "://" not in uri:
        return "file://" + uri
    return uri


def hidden(key: str) -> bool:
    """Names that Spark's readers leave out too, so that listing and reading agree."""
    return any(p[:1] == "." or p.endswith("._COPYING_")
               or (p[:1] == "_" and "=" not in p and not p.startswith(("_metadata", "_common_metadata")))
               for p in key.split("/"))


@dataclass
class Folder(InputPartition):
    path: str
    deep: bool


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = fs_uri(options["path"]).rstrip("/")
        self.prefix = options.get("prefix", "")
        self.folders = int(options.get("folders", FOLDERS))

    def _open(self):
        from pyarrow import fs as pafs
        return pafs.FileSystem.from_uri(self.root)

    def partitions(self) -> list[Folder]:
        from pyarrow import fs as pafs
        fs, base = self._open()
        # a prefix may end within a name: its folder is listed and its keys are filtered
        top = posixpath.join(base, posixpath.dirname(self.prefix)).rstrip("/")
        done, level = [], [top]
        while level and len(done) + len(level) < self.folders:
            inner = [i.path for f in level for i in fs.get_file_info(pafs.FileSelector(f, allow_not_found=True))
                     if i.type == pafs.FileType.Directory and self._may_hold(i.path[len(base):].lstrip("/") + "/")]
            done += [Folder(f, False) for f in level]
            level = inner
        return done + [Folder(f, True) for f in level]

    def _may_hold(self, folder: str) -> bool:
        return not hidden(folder.rstrip("/")) and (folder.startswith(self.prefix) or self.prefix.startswith(folder))

    def read(self, partition: Folder):
        from pyarrow import fs as pafs
        fs, base = self._open()
        rows = []
        for i in fs.get_file_info(pafs.FileSelector(partition.path, recursive=partition.deep, allow_not_found=True)):
            key = i.path[len(base):].lstrip("/")
            if i.type == pafs.FileType.File and key.startswith(self.prefix) and not hidden(key):
                rows.append({"key": key, "path": self.root + "/" + key, "size": i.size, "last_modified": i.mtime})
            if len(rows) == BATCH:
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, SCHEMA)


class ObjectListing(DataSource):
    """``spark.read.format("object_listing").option("prefix", ...).load(root)``"""

    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> str:
        return "key string, path string, size bigint, last_modified timestamp"

    def reader(self, schema) -> ListingReader:
        return ListingReader(dict(self.options))


def listing(spark: SparkSession, root: str, prefix: str = "", folders: int = FOLDERS) -> DataFrame:
    """Every object under ``root`` whose key starts with ``prefix``, empty ones
    too; a root that doesn't exist or holds nothing gives no rows."""
    spark.dataSource.register(ObjectListing)
    return spark.read.format("object_listing").option("prefix", prefix).option("folders", folders).load(root)
