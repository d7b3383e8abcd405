"""Removal of byte strings that occur anywhere else in the corpus.

Every string of ``length`` bytes that starts at two places or more is removed wherever it
stands. Places that can match are brought together first, then suffix-sorted:

1. Each string (window) has an anchor: of its substrings of ``anchor`` bytes that with the
   smallest hash, the leftmost if tied. Equal windows have equal anchors at equal offsets, and
   consecutive windows mostly share theirs, so that a document is a short list of
   ``(anchor hash, first window, windows, anchor's offset)``. These lists are stored, texts are not.
2. Anchors that occur once are dropped. Of equal texts one is followed (if long
   enough, all of them are removed whole).
3. Each occurrence of the others gets its context, the bytes of its windows. Equal contexts are
   one row from the map side on; one that occurs twice is settled. The windows of a context
   are cut by their offset to the anchor into four parts, each with the bytes that all its windows
   share as key; windows in parts that no other context has are left off.
4. What remains of an anchor's contexts is suffix-sorted together (``suffix_sort``); equal windows are
   neighbours among the suffixes.
5. An anchor whose contexts pass ``group_bytes`` is split: its windows are halved by their offset to
   the anchor. All windows of a half share more bytes around the anchor, which become its key,
   so that its contexts fall into smaller groups. A half of one offset has its whole
   window as key and is settled by counting. Nothing is left out, and no group grows with the input.
6. The places found go back to the documents, where they are merged and cut out. Only texts that a bitmap
   of bounded size lets through (all that have places, and a few more) are shuffled for that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.common import id_text, slabs, stored
from corpusflow.llm.rolling import span_hashes
from corpusflow.llm.suffix_sort import suffix_array

LENGTH = 200
ANCHOR = 64
#: Bytes of text that are hashed at once.
SLAB = 1 << 20
#: Bytes of contexts that are sorted together: more are split.
GROUP_BYTES = 1 << 18
#: Context digests that a task remembers, so as to send their bytes once.
REMEMBERED = 1 << 18

def _anchors(data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start: its anchor's position; and the hash at each position."""
    starts = np.arange(len(data) - anchor + 1)
    h = span_hashes(data, starts, starts + anchor, 11)
    wide = length - anchor + 1
    least, where, span = h, np.arange(len(h), dtype=np.int32), 1

    def leftmost(a, at, b, bt):
        right = b < a
        return np.where(right, b, a), np.where(right, bt, at)

    while span * 2 <= wide:
        least, where = leftmost(least[:-span], where[:-span], least[span:], where[span:])
        span *= 2
    if span < wide:
        off = wide - span
        least, where = leftmost(least[:-off], where[:-off], least[off:], where[off:])
    return where, h


def _runs(texts: list[bytes], length: int, anchor: int):
    """For each text its ``(hashes, first windows, window counts, anchor offsets)``; long texts in pieces."""
    for group in slabs(texts, SLAB):
        if len(group) == 1 and len(group[0]) > 2 * SLAB:
            parts = [_slab_runs([group[0][at: at + SLAB + length - 1]], length, anchor)[0]
                     for at in range(0, len(group[0]) - length + 1, SLAB)]
            yield (np.concatenate([p[0] for p in parts]),
                   np.concatenate([p[1] + k * SLAB for k, p in enumerate(parts)]),
                   np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]))
        else:
            yield from _slab_runs(group, length, anchor)


def _slab_runs(texts: list[bytes], length: int, anchor: int):
    none = (np.zeros(0, np.int64),) * 4
    sizes = np.array([len(t) for t in texts])
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return [none] * len(texts)
    where, h = _anchors(data, length, anchor)
    windows = np.maximum(sizes - length + 1, 0)
    firsts = np.concatenate(([0], np.cumsum(windows)))
    at = np.arange(firsts[-1]) + np.repeat(offsets[:-1] - firsts[:-1], windows)
    if not len(at):
        return [none] * len(texts)
    chosen = where[at]
    starts = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    counts = np.diff(np.append(starts, len(at)))
    hashes = h[chosen[starts]].view(np.int64)
    ahead = chosen[starts] - at[starts]
    cuts = np.searchsorted(starts, firsts)
    out = []
    for k in range(len(texts)):
        a, b = cuts[k], cuts[k + 1]
        out.append((hashes[a:b], at[starts[a:b]] - offsets[k], counts[a:b], ahead[a:b]) if b > a else none)
    return out


def _lists(values: list[np.ndarray], kind) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values) if values else [], kind))


def _document_anchors(length: int, anchor: int):
    def run(batches):
        from pyspark import TaskContext
        rid = TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t.encode("utf-8") for t in part.column("text").to_pylist()]
                found = list(_runs(texts, length, anchor))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(rid, rid + len(texts))), part.column("did"), part.column("doc_key"),
                    _lists([f[0] for f in found], pa.int64()), _lists([f[1] for f in found], pa.int64()),
                    _lists([f[2] for f in found], pa.int32()), _lists([f[3] for f in found], pa.int32())],
                    ["rid", "did", "doc_key", "keys", "starts", "counts", "ahead"])
                rid += len(texts)
    return run


def _contexts(length: int):
    """``(rid, text, places)`` -> one row a place; its bytes only where the task hasn't sent them yet."""
    def run(batches):
        sent = set()
        for batch in batches:
            lists = batch.column("places")
            flat, ends = lists.flatten(), lists.offsets.to_numpy()
            ends = ends - ends[0]
            keys, starts, counts, ahead = (flat.field(f).to_pylist() for f in ("key", "start", "count", "at"))
            rids, out, held = batch.column("rid").to_pylist(), [], 0
            for k, text in enumerate(batch.column("text").to_pylist()):
                data = text.encode("utf-8")
                for p in range(ends[k], ends[k + 1]):
                    context = data[starts[p]: starts[p] + counts[p] + length - 1]
                    digest = xxhash.xxh3_128_digest(context)
                    new = digest not in sent
                    if new:
                        if len(sent) >= REMEMBERED:
                            sent.clear()
                        sent.add(digest)
                        held += len(context)
                    out.append((rids[k], keys[p], digest, starts[p], ahead[p], context if new else None))
                    if len(out) >= 10000 or held > SLAB:
                        yield _batch(out)
                        out, held = [], 0
            if out:
                yield _batch(out)

    def _batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                          ["rid", "key", "context", "start", "at", "bytes"])
    return run


def _parts(length: int, pieces: int = 4):
    """Contexts -> a row for each part of their windows: ``(context, part, first, last)``, ``part`` a hash of
    what all windows of the part share, ``first`` and ``last`` the windows."""
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                data, at, low, high = row["bytes"], row["at"], row["low"], row["high"]
                step = -(-(high - low + 1) // pieces)
                for a in range(low, high + 1, step):
                    b = min(a + step - 1, high)
                    first, last = max(at + a, 0), min(at + b, len(data) - length)
                    if first <= last:
                        part = xxhash.xxh3_64_intdigest(b"%d,%d," % (a, b) + data[at + b: at + a + length]) - (1 << 63)
                        out.append((row["context"], part, first, last))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int32(), pa.int32()))],
                                                 ["context", "part", "first", "last"])
    return run


def _repeated(contexts: list[bytes], twice: list[bool], length: int) -> list[np.ndarray]:
    """For each context, which of its windows occur twice or more among all contexts.

    ``twice`` says of a context that it stands at several places itself.
    """
    data = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    sizes = np.array([len(c) for c in contexts])
    firsts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    values = data.astype(np.int16) + 1
    values[np.append(firsts[1:] - 1, len(data) - 1)] = 0
    owner = np.repeat(np.arange(len(contexts)), sizes + 1)
    inside = np.arange(len(data)) - firsts[owner] <= (sizes - length)[owner]
    order = suffix_array(values)
    order = order[inside[order]]
    new = np.ones(len(order), bool)
    span = np.arange(length)
    for at in range(1, len(order), 4096):  # neighbours that differ within the window's length
        here = order[at: at + 4096]
        before = order[at - 1: at - 1 + len(here)]
        new[at: at + len(here)] = (data[here[:, None] + span] != data[before[:, None] + span]).any(axis=1)
    classes = np.cumsum(new) - 1
    weight = np.bincount(classes, 1 + np.array(twice, np.int64)[owner[order]])
    found = np.zeros(len(data), bool)
    found[order] = weight[classes] > 1
    return [found[f: f + s - length + 1] for f, s in zip(firsts, sizes)]


def _ranges(flags: np.ndarray, shift: int) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return (np.flatnonzero(edge == 1) + shift).tolist(), (np.flatnonzero(edge == -1) - 1 + shift).tolist()


_MARKS = "context binary, first array<int>, last array<int>"


def _sorted_groups(length: int, slab: int):
    """Rows in the order of ``key`` -> marks; whole groups are sorted together, several at once."""
    def settle(held):
        found = _repeated([h[1] for h in held], [h[2] for h in held], length)
        marks = [(h[0], *_ranges(f, h[3])) for h, f in zip(held, found) if f.any()]
        return pa.RecordBatch.from_arrays([pa.array([m[0] for m in marks], pa.binary()),
                                           pa.array([m[1] for m in marks], pa.list_(pa.int32())),
                                           pa.array([m[2] for m in marks], pa.list_(pa.int32()))], ["context", "first", "last"])

    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "context", "bytes", "twice", "shift"))):
                if size > slab and key != last:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
                last = key
        if held:
            yield settle(held)
    return run


def _halves(length: int):
    """Contexts of too large a group -> the two halves of each, under keys of their own."""
    kinds = (pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
    names = ["origin", "moved", "key", "context", "bytes", "at", "low", "high", "twice"]

    def run(batches):
        for batch in batches:
            out, held = [], 0
            for row in batch.to_pylist():
                data, at, low, high = row["bytes"], row["at"], row["low"], row["high"]
                middle = (low + high) // 2
                for a, b in ((low, middle), (middle + 1, high)):
                    first, last = max(at + a, 0), min(at + b, len(data) - length)
                    if a > b or first > last:
                        continue
                    part = data[first: last + length]
                    key = xxhash.xxh3_64_intdigest(b"%d,%d," % (a, b) + data[at + b: at + a + length]) - (1 << 63)
                    digest = xxhash.xxh3_128_digest(b"%d,%d,%d," % (a, b, at - first) + part)
                    out.append((row["context"], row["shift"] + first, key, digest, part, at - first, a, b, row["twice"]))
                    held += len(part)
                if held > SLAB:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
    return run


def _marks(sources: DataFrame, length: int, group_bytes: int) -> DataFrame:
    """``sources``: stored ``(key, context, bytes, at, low, high, origin, twice)``, a row for each place of a context,
    ``bytes`` null where another row has them -> ``(context, first, last)``, ranges of windows that
    stand at two places or more."""
    twice = stored(sources.groupBy("context").agg(
        (F.max("twice") | (F.min("origin") != F.max("origin"))).alias("twice"), F.max(F.length("bytes")).alias("size"))
        .where("twice"), "repeated-contexts")
    marks = twice.select("context", F.array(F.lit(0)).alias("first"), F.array(F.col("size") - length).alias("last"))

    given = sources.where("bytes IS NOT NULL")
    parts = stored(given.select("context", "bytes", "at", "low", "high").mapInArrow(
        _parts(length), "context binary, part long, first int, last int"), "context-parts")
    shared = stored(parts.groupBy("part").agg(F.min("context").alias("a"), F.max("context").alias("b")).where("a <> b").select("part"), "shared-parts")
    ranges = (parts.join(shared, "part", "left_semi").groupBy("context")
              .agg(F.min("first").alias("shift"), F.max("last").alias("last")))
    first = {c: F.first(c).alias(c) for c in ("key", "bytes", "at", "low", "high", "shift", "last")}
    rest = (given.select("key", "context", "bytes", "at", "low", "high").join(ranges, "context")
            .groupBy("context").agg(*first.values()).join(twice.select("context", "twice"), "context", "left"))
    rest = stored(rest.select("key", "context", "low", "high", "shift", F.coalesce("twice", F.lit(False)).alias("twice"),
                              F.col("bytes").substr(F.col("shift") + 1, F.col("last") - F.col("shift") + length).alias("bytes"),
                              (F.col("at") - F.col("shift")).alias("at")), "contexts")

    groups = stored(rest.groupBy("key").agg(F.sum(F.length("bytes")).alias("held")), "anchor-groups")
    small, largest = groups.agg(F.sum(F.when(F.col("held") <= group_bytes, F.col("held"))), F.max("held")).first()
    rest = rest.join(groups, "key")
    if small:
        parts_ = int(min(max(small // (2 * group_bytes), 24), 100_000))
        marks = marks.unionByName(
            rest.where(F.col("held") <= group_bytes).select("key", "context", "bytes", "twice", "shift")
            .repartition(parts_, "key").sortWithinPartitions("key").mapInArrow(_sorted_groups(length, group_bytes), _MARKS))
    if (largest or 0) <= group_bytes:
        return marks
    halves = stored(rest.where(F.col("held") > group_bytes).select("context", "bytes", "at", "low", "high", "shift", "twice").mapInArrow(
        _halves(length), "origin binary, moved int, key long, context binary, bytes binary, at int, low int, high int, twice boolean"), "anchor-halves")
    found = stored(_marks(halves, length, group_bytes), "half-marks")
    moved = lambda c: F.transform(c, lambda x: x + F.col("moved"))
    return marks.unionByName(halves.select("origin", "moved", "context").join(found, "context").select(
        F.col("origin").alias("context"), moved("first").alias("first"), moved("last").alias("last")))


def _sift(rows: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``did`` may be among those of ``keys``, and the others, which surely aren't.

    By a bitmap of 16 bits a key, 16 MB at most, which is broadcast; were it fuller, more rows would pass.
    """
    buckets = 1 << min(max((keys.count() * 16 // 32768).bit_length(), 0), 12)
    bit = F.pmod(F.xxhash64("did"), F.lit(buckets * 32768))
    bits = (keys.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.col("bits").substr((F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.substring(F.lpad(F.bin(byte), 8, "0"), (8 - at % 8).cast("int"), F.lit(1)) == "1", F.lit(False))
    tested = rows.withColumn("bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(bits), "bucket", "left").withColumn("hit", hit)
    return tested.where("hit").select(*rows.columns), tested.where("NOT hit").select(*rows.columns)


def _cut(length: int):
    def run(batches):
        for batch in batches:
            firsts, lasts, whole = (batch.column(c).to_pylist() for c in ("first", "last", "whole"))
            spans, kept, sizes = [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                data = text.encode("utf-8")
                sizes.append(len(data))
                if whole[k]:
                    spans.append([{"start": 0, "end": len(data)}])
                    kept.append(b"")
                    continue
                merged: list[list[int]] = []
                for a, b in sorted(zip(firsts[k] or (), lasts[k] or ())):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b + length)
                    else:
                        merged.append([a, b + length])
                spans.append([{"start": a, "end": b} for a, b in merged])
                ends = [0] + [b for _, b in merged]
                kept.append(b"".join(data[a:b] for a, b in zip(ends, [a for a, _ in merged] + [len(data)])))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, spans, kept``.

    ``spans`` are the maximal runs of bytes (``start`` included, ``end`` not) that lie in a string of
    ``length`` bytes which also starts elsewhere in any text, its own included; ``kept`` is the rest,
    as bytes, since a cut may fall inside a character. Texts are UTF-8; null is empty; shorter texts are
    kept whole. Of rows that repeat a text of ``length`` bytes or more, none keeps it, same id or not.
    Null ids stay null. No rows give no rows. ``1 <= anchor <= length``.
    """
    if not 1 <= anchor <= length:
        raise ValueError("the anchor must have between 1 and length bytes")
    rows = id_text(docs, id_col, text_col).withColumn("did", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    # an id as text, to tell the rows of equal texts apart
    rows = rows.withColumn("doc_key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    anchors = stored(rows.where(F.octet_length("text") >= length).select("did", "doc_key", "text").mapInArrow(
        _document_anchors(length, anchor), "rid long, did binary, doc_key string, keys array<long>, starts array<long>, counts array<int>, ahead array<int>"), "anchors")

    one = stored(anchors.groupBy("did").agg(F.count("*").alias("n"), F.min(F.struct("rid", "doc_key")).alias("one")).where("n > 1")
                 .select("did", F.col("one.rid").alias("one"), F.lit(True).alias("whole")), "equal-texts")
    followed = anchors.join(anchors.select("rid", "did").join(one, "did").where("rid <> one").select("rid"), "rid", "left_anti")
    places = followed.select("rid", F.explode(F.arrays_zip(
        F.col("keys").alias("key"), F.col("starts").alias("start"), F.col("counts").alias("count"), F.col("ahead").alias("at"))).alias("p")).select("rid", "p.*")
    often = stored(places.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated-anchors")
    lists = (places.join(often, "key", "left_semi").groupBy("rid")
             .agg(F.collect_list(F.struct("key", "start", "count", "at")).alias("places")))
    lists = stored(lists.join(anchors.select("rid", "did", "doc_key"), "rid"), "anchor-places")
    likely, _ = _sift(rows.select("did", "doc_key", "text"), lists)
    found = stored(likely.join(lists, ["did", "doc_key"]).select("rid", "text", "places")
                   .mapInArrow(_contexts(length), "rid long, key long, context binary, start long, at int, bytes binary"), "places")

    marks = stored(_marks(found.select("key", "context", "bytes", "at", F.lit(anchor - length).alias("low"), F.lit(0).alias("high"),
                                       F.struct("rid", "start").alias("origin"), F.lit(False).alias("twice")), length, group_bytes), "marks")
    moved = lambda c: F.transform(c, lambda x: x + F.col("start"))
    cuts = (found.select("rid", "context", "start").join(marks, "context")
            .select("rid", moved("first").alias("first"), moved("last").alias("last"))
            .groupBy("rid").agg(F.flatten(F.collect_list("first")).alias("first"), F.flatten(F.collect_list("last")).alias("last")))
    cuts = stored(cuts.join(anchors.select("rid", "did"), "rid").drop("rid")
                  .join(one.select("did", "whole"), "did", "full_outer"), "cuts")
    likely, whole = _sift(rows.select("did", "doc_id", "text"), cuts)
    none = {c: F.lit(None).cast(t) for c, t in (("first", "array<bigint>"), ("last", "array<bigint>"), ("whole", "boolean"))}
    result = likely.join(cuts, "did", "left").unionByName(whole.withColumns(none))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return result.select("doc_id", "text", "first", "last", "whole").mapInArrow(
        _cut(length), f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
