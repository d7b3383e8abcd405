"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.session import scratch_path

#: Bytes of text that a worker handles at once, whatever an Arrow batch holds.
SLAB_BYTES = 8 << 20


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col(f"`{name}`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` alone: no other column of the input can clash later. Null text is empty."""
    return df.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text, modulo ``parts``, is ``part``; a null id counts as empty text."""
    return F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == part


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it from there.

    Cuts the lineage: a lost executor costs no recomputation, generated row numbers stay
    what they were, and the planner knows the true size of what it reads.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slabs(values: Iterable[bytes | str], limit: int = SLAB_BYTES) -> Iterator[list]:
    """Consecutive groups of values of about ``limit`` bytes (a longer value is a group)."""
    group, held = [], 0
    for v in values:
        if group and held + len(v) > limit:
            yield group
            group, held = [], 0
        group.append(v)
        held += len(v)
    if group:
        yield group


def filter_rows(docs: DataFrame, text_col: str, keep) -> DataFrame:
    """The rows of ``docs`` for which ``keep(texts)``, a list of booleans, is true; null is empty.
    Columns pass through whatever they are called."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    name = plain.columns[docs.columns.index(text_col)]

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(keep([t or "" for t in batch.column(name).to_pylist()]), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def drop_rows(docs: DataFrame, drop: DataFrame, repeats: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows named in ``drop``; of rows that repeat one of ``repeats``, one stays.

    Both name rows by ``(doc_id, text_hash)``, the hash being ``xxhash64`` of the text with null
    as empty. The rows are left out by an anti join, which Spark broadcasts if the stored list
    is small and splits where skewed if not; the usual empty ``repeats`` costs no shuffle.
    """
    mark, key, hash_ = (fresh(docs, f"cf_{x}") for x in ("mark", "key", "hash"))
    rows = docs.withColumn(hash_, F.xxhash64(F.coalesce(col(text_col), F.lit(""))))
    drop = drop.select(F.col("doc_id").alias(key), F.col("text_hash").alias(mark))
    same = lambda: (F.col(hash_) == F.col(mark)) & col(id_col).eqNullSafe(F.col(key))
    rows = rows.join(drop, same(), "left_anti")
    if not repeats.isEmpty():
        repeats = repeats.select(F.col("doc_id").alias(key), F.col("text_hash").alias(mark))
        once = rows.join(repeats, same(), "left_semi").dropDuplicates([id_col, hash_])
        rows = rows.join(repeats, same(), "left_anti").unionByName(once)
    return rows.drop(hash_)
