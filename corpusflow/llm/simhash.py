"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are cut into tiles by their population counts: a tile holds
fingerprints with the same counts in each of ``parts`` equal parts of the 64 bits. Two
fingerprints at Hamming distance d have part counts that differ by d in sum at most, so tile
pairs whose counts differ by more than the radius are never formed; all others are compared
exactly, by exclusive or and bit counts in numpy. A tile pair answers with a spanning forest
of its matches, never with all pairs; components come from a star algorithm over these edges.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.common import drop_rows, id_text, stored
from corpusflow.llm.components import components

#: Shingles hashed at once.
BLOCK = 1 << 16
#: Fingerprints in a tile, about.
TILE = 8192


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash over the word shingles of a UTF-8 text, repeats included."""
    words = text.lower().split()  # bytes: lowers A-Z alone, splits at \x20 and \x09-\x0D
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    first, last = (ends - sizes)[: n - shingle + 1], ends[shingle - 1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(first), BLOCK):
        spans = zip(first[at:at + BLOCK].tolist(), last[at:at + BLOCK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans], np.uint64)
        ones += np.add.reduce(np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view(np.uint64)[0])


def _prints(shingle: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(prints.view(np.int64))], ["doc_id", "text_hash", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp)`` of every row; ``fp`` is the fingerprint as a signed long."""
    rows = id_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_prints(shingle), f"doc_id {kind}, text_hash long, fp long")


def _forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the pairs within ``radius``, between a and b or within a."""
    nodes = a if b is None else np.concatenate([a, b])
    shift = 0 if b is None else len(a)
    other = a if b is None else b
    label = np.arange(len(nodes))
    for i in range(0, len(a), 64):
        for j in range(i if b is None else 0, len(other), 4096):
            near = np.bitwise_count(a[i:i + 64, None] ^ other[None, j:j + 4096]) <= radius
            if b is None and j == i:
                near &= np.tri(*near.shape, k=0, dtype=bool) == 0
            for r in np.flatnonzero(near.any(axis=1)):
                met = np.unique(np.append(label[shift + j + np.flatnonzero(near[r])], label[i + r]))
                if len(met) > 1:
                    label[np.isin(label, met[1:])] = met[0]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _compare(radius: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = (batch.column(k)[i].values.to_numpy().view(np.uint64) for k in ("fps_a", "fps_b"))
                own = batch.column("tile_a")[i] == batch.column("tile_b")[i]
                u, v = _forest(one, None if own else two, radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])
    return run


def links(prints: DataFrame, radius: int = 3, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """Edges ``(u, v)`` whose components are those of all pairs of distinct ``fp`` within
    ``radius`` bits. ``parts``: 2, or 4 for more finely cut tiles; by default as many as fill them.

    The table of count signatures has at most 33**2 (17**4) rows. Tiles of a signature with
    many fingerprints are dealt by a hash, so that none holds much more than ``tile``.
    """
    if parts is None:
        parts = 2 if prints.count() <= 512 * tile else 4
    width = 64 // parts
    base = width + 1 + 2 * radius  # no two signatures share a number, neighbours included
    sig = sum((F.bit_count(F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1))).cast("long") + radius) * base ** i for i in range(parts))
    prints = prints.select("fp", sig.alias("sig"))
    sizes = stored(prints.groupBy("sig").agg(F.ceil(F.count("*") / tile).alias("k")), "tile-signatures")
    tiles = (prints.join(F.broadcast(sizes), "sig")
             .select("fp", F.struct("sig", F.pmod(F.xxhash64("fp"), "k").alias("salt")).alias("tile"))
             .groupBy("tile").agg(F.collect_list("fp").alias("fps")))
    tiles = stored(tiles, "tiles")
    near = [d for d in itertools.product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    steps = sorted(s for s in (sum(x * base ** i for i, x in enumerate(d)) for d in near) if s >= 0)
    right = sizes.select(F.col("sig").alias("sig_b"), F.col("k").alias("k_b"))
    pairs = (sizes.withColumn("step", F.explode(F.array(*[F.lit(s).cast("long") for s in steps])))
             .withColumn("sig_b", F.col("sig") + F.col("step")).join(right, "sig_b")
             .withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
             .withColumn("b", F.explode(F.sequence(F.when(F.col("step") == 0, F.col("a")).otherwise(F.lit(0).cast("long")), F.col("k_b") - 1)))
             .select(F.struct("sig", F.col("a").alias("salt")).alias("tile_a"), F.struct(F.col("sig_b").alias("sig"), F.col("b").alias("salt")).alias("tile_b")))
    pairs = (pairs.join(tiles.select(F.col("tile").alias("tile_a"), F.col("fps").alias("fps_a")), "tile_a")
             .join(tiles.select(F.col("tile").alias("tile_b"), F.col("fps").alias("fps_b")), "tile_b"))
    return pairs.mapInArrow(_compare(radius), "u long, v long")


def _labels(prints: DataFrame, radius: int, **options) -> DataFrame:
    """``(fp, root)`` of every fingerprint that is linked to another."""
    return components(links(prints.select("fp").distinct(), radius, **options)).withColumnsRenamed({"node": "fp"})


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, **options) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    ``fingerprint``: 16 hex digits. ``component_id``: the smallest id reachable over links of
    at most ``radius`` differing bits, the row's own included; null only if all those ids are
    null. Null and empty texts, and texts of white space, have fingerprint zero and are linked
    like any other. Repeated rows each give a row; no rows give no rows.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    groups = groups.join(_labels(prints, radius, **options), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = stored(groups, "simhash-groups")
    lowest = groups.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = groups.join(lowest, "root").select("fp", "component_id")
    return prints.join(ids, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id (nulls last; among
    equal ids the smaller text hash); all columns as they were."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    groups = prints.groupBy("fp").agg(F.min(row).alias("low"))
    groups = groups.join(_labels(prints, radius), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = stored(groups, "simhash-groups")
    lowest = groups.groupBy("root").agg(F.min("low").alias("best"))
    rows = prints.join(groups.join(lowest, "root").select("fp", "best"), "fp")
    stays = row.eqNullSafe(F.col("best"))
    drop = rows.where(~stays).select("doc_id", "text_hash").distinct()
    repeats = rows.where(stays).groupBy("doc_id", "text_hash").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    return drop_rows(docs, stored(drop, "near-copies"), stored(repeats, "repeats"), id_col, text_col)
