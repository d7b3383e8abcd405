"""WARC archives with an index: write first, then read selected records by byte ranges.

Payloads are compared by length, SHA-1 and SHA-256; of equal ones the row with the largest id
becomes the response and the others revisit it. Each task writes one archive of gzip members,
a member a record, under a name of its own, so that a task that is run again leaves no record
twice in the index: the index has only what a finished task returned. It is stored (offset,
length, URL and digest of each record) before anything is read.

To read, the selected index rows are dealt by stretches of archive, sorted by offset, and
neighbouring ranges are read at once.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.common import col, stored
from corpusflow.session import scratch_path

#: Ranges with a smaller gap are read at once, up to so many bytes (a longer record alone).
GAP, READ = 64 << 10, 4 << 20
#: Bytes of archive whose records go to one reading group.
STRETCH = 64 << 20
_CRLF = b"\r\n"


def file_system(path: str):
    """``(file system, path in it)``: whatever store the shared folder is in."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str | None) -> str:
    """A header value: no control characters, so that a URL can't break the header."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value or "")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One uncompressed WARC/1.1 record; a revisit has no payload, only its length and digest."""
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    body = b"" if revisit else payload
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + _CRLF * 2 + body + _CRLF * 2


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of an uncompressed record."""
    head, _, rest = raw.partition(_CRLF * 2)
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _page(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _write(folder: str):
    def run(batches):
        fs, root = file_system(folder)
        out, at, name = None, 0, f"{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in batches:
                rows: list[tuple] = []
                for r in batch.to_pylist():
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    payload = r["html"].encode()
                    pack = zlib.compressobj(1, wbits=31)
                    member = pack.compress(record(r["page_id"], r["url"], payload, r["refers_to"], r["revisit"])) + pack.flush()
                    out.write(member)
                    rows.append((name, at, len(member), r["url"], digest(payload), r["page_id"]))
                    at += len(member)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], ["archive", "offset", "length", "url", "digest", "page_id"])
        finally:
            if out is not None:
                out.close()
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write a record per row into archives under ``folder``; the stored index
    ``archive, offset, length, url, digest, page_id``.

    Null html is an empty payload. Of equal payloads of at least ``least_bytes`` bytes the row
    with the largest id is the response (rows that repeat that id all are), the others revisit
    it; smaller ones are all responses. A null id loses to any other.
    """
    rows = pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).cast("string").alias("url"), F.coalesce(col(html_col).cast("string"), F.lit("")).alias("html"))
    size = F.octet_length("html")
    keys = [F.sha1("html").alias("sha1"), F.sha2("html", 256).alias("sha256"), size.alias("bytes")]
    same = rows.select("page_id", *keys).where(F.col("bytes") >= least_bytes).groupBy("sha1", "sha256", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    same = stored(same, "equal-payloads")
    chosen = rows.select("*", *keys).join(same, ["sha1", "sha256", "bytes"], "left")
    chosen = chosen.withColumn("revisit", F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")))
    chosen = chosen.select("page_id", "url", "html", F.when(F.col("revisit"), F.col("refers_to")).alias("refers_to"), "revisit")
    return stored(chosen.mapInArrow(_write(folder), "archive string, offset long, length long, url string, digest string, page_id long"), "warc-index")


def _ranges(rows):
    """Runs of neighbouring index rows of one archive."""
    group, end = [], 0
    for r in rows:
        if group and (r["archive"] != group[0]["archive"] or r["offset"] > end + GAP or r["offset"] + r["length"] - group[0]["offset"] > READ):
            yield group
            group = []
        group.append(r)
        end = r["offset"] + r["length"]
    if group:
        yield group


def _read(folder: str, with_payload: bool):
    def run(batches):
        fs, root = file_system(folder)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")}
            for name, groups in itertools.groupby(_ranges(batch.to_pylist()), key=lambda g: g[0]["archive"]):
                with fs.open_input_file(f"{root}/{name}") as f:
                    for group in groups:
                        start = group[0]["offset"]
                        f.seek(start)
                        raw = f.read(group[-1]["offset"] + group[-1]["length"] - start)
                        for r in group:
                            headers, body = parse(zlib.decompress(raw[r["offset"] - start:r["offset"] - start + r["length"]], wbits=31))
                            stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                            revisit = headers["WARC-Type"] == "revisit"
                            if stated != r["digest"] or not revisit and digest(body) != stated:
                                raise ValueError(f"record at {r['offset']} of {name} isn't the one indexed")
                            out["page_id"].append(_page(headers["WARC-Record-ID"]))
                            out["url"].append(headers["WARC-Target-URI"])
                            out["payload_bytes"].append(int(headers["X-Payload-Length"]) if revisit else len(body))
                            out["payload_digest"].append(stated if revisit else digest(body))
                            out["record_type"].append(headers["WARC-Type"])
                            out["refers_to"].append(_page(headers.get("WARC-Refers-To")))
                            out["payload"].append(body if with_payload and not revisit else None)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))
    return run


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the given index rows: ``page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload`` (null unless asked for, and for revisits).

    Every record's digest is checked against the index, a response's against its payload too.
    """
    rows = index.select("archive", "offset", "length", "digest", F.floor(F.col("offset") / STRETCH).alias("stretch"))
    rows = rows.repartition("archive", "stretch").sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(_read(folder, with_payload), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive_folder(spark) -> str:
    return scratch_path(spark, "warc")
