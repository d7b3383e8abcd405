"""Exact deduplication by a Golomb-coded exchange of fingerprints.

1. Every row gets a 64-bit fingerprint of its text (JVM side); the narrow table is stored.
2. Each task cuts its fingerprints into slices. A slice sorts its *distinct* fingerprints,
   cuts them by owner (the leading bits) and sends each owner one Golomb-coded block and a
   bitmap of those that the slice itself holds more than once. A text that a third of all
   rows share is thus one entry of each slice.
3. An owner decodes its blocks and answers each with a bitmap of the fingerprints seen twice.
4. The slices decode the flagged fingerprints; rows that have one are suspects. Only their
   texts are shuffled, grouped by (fingerprint, text) with partial aggregation, and compared
   byte for byte. Equal texts form a class; everything else stays alone.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm import golomb
from corpusflow.llm.common import drop_rows, id_text, stored

#: Fingerprints in a slice at most, and for an owner about.
SLICE = 1 << 22
#: Owners at least, as a power of two.
LEAST_OWNER_BITS = 6


def _send(owner_bits: int, slice_rows: int):
    shift = np.uint64(64 - owner_bits)

    def cut(held: list[np.ndarray], slice_id: int):
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        owners = (values >> shift).astype(np.int64)
        starts = np.flatnonzero(np.diff(owners, prepend=-1))
        ends = np.append(starts[1:], len(values))
        return pa.RecordBatch.from_arrays([
            pa.array([slice_id] * len(starts), pa.int64()),
            pa.array(owners[starts], pa.int64()),
            pa.array([golomb.encode(values[a:b]) for a, b in zip(starts, ends)], pa.binary()),
            pa.array([np.packbits(counts[a:b] > 1).tobytes() for a, b in zip(starts, ends)], pa.binary()),
        ], ["slice", "owner", "block", "again"])

    def run(batches):
        from pyspark import TaskContext
        slice_id, held, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.column(0).slice(at, slice_rows).to_numpy(zero_copy_only=False).view(np.uint64)
                if n and n + len(part) > slice_rows:
                    yield cut(held, slice_id)
                    slice_id, held, n = slice_id + 1, [], 0
                held.append(part)
                n += len(part)
        if n:
            yield cut(held, slice_id)

    return run


def _own(pdf: pd.DataFrame) -> pd.DataFrame:
    """Owner: which fingerprints of each block occur twice or more over all blocks."""
    blocks = [golomb.decode(b) for b in pdf["block"]]
    again = [np.unpackbits(np.frombuffer(a, np.uint8), count=len(b)).astype(bool) for a, b in zip(pdf["again"], blocks)]
    values, counts = np.unique(np.concatenate(blocks), return_counts=True)
    twice = counts > 1
    for b, a in zip(blocks, again):
        twice[np.searchsorted(values, b[a])] = True
    flags = [twice[np.searchsorted(values, b)] for b in blocks]
    out = pd.DataFrame({"slice": pdf["slice"], "owner": pdf["owner"], "twice": [np.packbits(f).tobytes() for f in flags]})
    return out[[bool(f.any()) for f in flags]]


def _flagged(batches):
    for batch in batches:
        for block, twice in zip(batch.column("block").to_pylist(), batch.column("twice").to_pylist()):
            values = golomb.decode(block)
            found = values[np.unpackbits(np.frombuffer(twice, np.uint8), count=len(values)).astype(bool)]
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])


def suspects(narrow: DataFrame, owner_bits: int | None = None, slice_rows: int = SLICE) -> DataFrame:
    """Distinct values of ``h`` that occur in two or more rows of ``narrow``."""
    if owner_bits is None:
        owner_bits = max(LEAST_OWNER_BITS, math.ceil(math.log2(max(narrow.count(), 1) / SLICE)) if narrow.count() > SLICE else 0)
    sent = stored(narrow.select("h").mapInArrow(_send(owner_bits, slice_rows), "slice long, owner long, block binary, again binary"), "fingerprint-blocks")
    answers = sent.groupBy("owner").applyInPandas(_own, "slice long, owner long, twice binary")
    back = sent.select("slice", "owner", "block").join(answers, ["slice", "owner"])
    return back.select("block", "twice").mapInArrow(_flagged, "h long").distinct()


def _classes(docs: DataFrame, id_col: str, text_col: str, **options) -> tuple[DataFrame, DataFrame]:
    """The stored narrow rows ``(rid, doc_id, h, sha, suspect)`` and the classes of two or more rows.

    Rows are marked by a join with the suspect fingerprints, which Spark broadcasts if they are few (else the narrow
    rows are shuffled once); all that follows handles suspects alone.
    """
    rows = id_text(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    narrow = stored(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "h", F.unhex(F.sha2("text", 256)).alias("sha")), "fingerprints")
    hashes = stored(suspects(narrow, **options), "suspect-fingerprints")
    marked = stored(narrow.join(hashes.withColumn("suspect", F.lit(True)), "h", "left").withColumn("suspect", F.coalesce("suspect", F.lit(False))), "marked-fingerprints")
    same = (rows.select("h", "text").join(hashes, "h", "left_semi")
            .groupBy("h", "text").agg(F.count("*").alias("n")).where("n > 1")
            .select("h", F.unhex(F.sha2("text", 256)).alias("sha")))
    best = F.max(F.struct("doc_id", F.negative("rid").alias("rid")))
    copies = marked.where("suspect").groupBy("h", "sha").agg(best.alias("best"), F.count("*").alias("n")).where("n > 1")
    classes = (copies.join(same, ["h", "sha"])
               .select("h", "sha", F.col("best.doc_id").alias("keep_id"), (-F.col("best.rid")).alias("keep_rid"), "n"))
    return marked, stored(classes, "copy-classes")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; null counts as empty, and empty texts are copies of
    one another. The row with the largest id stays; a null id loses to any other, and of rows
    that repeat the same id and text exactly one is ``kept``. No rows give no rows.
    """
    narrow, classes = _classes(docs, id_col, text_col, **options)
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    alone = narrow.where("NOT suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    return narrow.where("suspect").join(classes, ["h", "sha"], "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("rid") == F.col("keep_rid"))).alias("kept"), sha).unionByName(alone)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept rows alone, all columns as they were.

    Null texts are empty and copies of one another, a null id loses to any other. Of rows that repeat both
    id and text one stays, whichever; their other columns aren't compared. No rows give no rows.
    """
    narrow, classes = _classes(docs, id_col, text_col)
    rows = narrow.where("suspect").join(classes, ["h", "sha"])
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    drop = rows.where(~stays).select("doc_id", F.col("h").alias("text_hash")).distinct()
    repeats = rows.where(stays).groupBy("doc_id", F.col("h").alias("text_hash")).agg(F.count("*").alias("c")).where("c > 1")
    return drop_rows(docs, stored(drop, "copies"), stored(repeats.drop("c"), "repeats"), id_col, text_col)
