"""Collocations from a prefix-free parse of the corpus.

1. Words of a text are cut into overlapping chunks: wherever the hash of ``max_words - 1`` consecutive
   words is divisible by ``modulus``, a chunk starts there, and the one before ends behind them.
   Copies and common passages give equal chunks wherever they stand.
2. The distinct chunks with their frequencies are the dictionary (partial sums in the tasks). It is
   stored in slices.
3. Every phrase of up to ``max_words`` words lies in one chunk whole; it belongs to the chunk in which it
   starts before the final overlap, so each is counted once, times the chunk's frequency.
4. Slices send the hashes of their distinct phrases, sorted, Golomb-coded and with counts, to owners
   by hash range; owners add up and answer each slice with those that reach ``least_count``. Only their
   texts are then written out, added up, and held to the bound exactly. Hashes have as many bits as
   the input needs for few false ones; these cost a row, never a result.
5. Scores of all cuts, containment in longer candidates and ranks are joins and windows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm import golomb
from corpusflow.llm.common import col, slabs, stored
from corpusflow.llm.rolling import mixed, span_hashes

MAX_WORDS = 3
LEAST_COUNT = 10
MODULUS = 32
#: Chunks of the dictionary that are counted together.
SLICE_ROWS = 1 << 15
#: Phrases for an owner, about.
OWNED = 1 << 20

_SLAB = 1 << 20
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the number of the piece each stands in."""
    kind = _KIND[data]
    edge = np.diff(np.concatenate(([False], kind == 0, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return starts, ends, np.cumsum(kind == 2)[starts] if len(starts) else starts


def _chunks(texts: list[bytes], window: int, modulus: int):
    """``(text number, owned words, chunk)`` of lower-cased texts; ``owned`` words start phrases of the chunk's own."""
    for at, group in _numbered(texts):
        raw = b"\n".join(group) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        starts, ends, _ = _words(data)
        if not len(starts):
            continue
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in group]), starts, side="right")
        first = np.concatenate(([True], text[1:] != text[:-1]))
        last = len(starts) - window
        cut = first.copy()
        if window and last > 0:
            h = span_hashes(data, starts, ends, 21)
            mix = np.zeros(last + 1, np.uint64)
            for k in range(window):
                mix = mixed(mix + h[k: k + last + 1])
            cut[: last + 1] |= (mix % np.uint64(modulus) == 0) & (text[: last + 1] == text[window - 1: window + last])
        begin = np.flatnonzero(cut)
        after = np.append(begin[1:], len(starts))
        follows = np.append(text[begin[1:]] == text[begin[:-1]], False)  # the next chunk is of the same text
        end = ends[np.where(follows, after + window, after) - 1]
        for t, n, a, b in zip((text[begin] + at).tolist(), (after - begin).tolist(), starts[begin].tolist(), end.tolist()):
            yield t, n, raw[a:b]


def _numbered(texts: list[bytes]):
    at = 0
    for group in slabs(texts, _SLAB):
        yield at, group
        at += len(group)


def _parse(window: int, modulus: int):
    kinds = {"lang": pa.string(), "owned": pa.int32(), "chunk": pa.binary(), "n": pa.int64()}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                langs = part.column("lang").to_pylist()
                texts = [t.encode("utf-8").lower() for t in part.column("text").to_pylist()]  # bytes: A-Z alone
                found = Counter((langs[t], n, chunk) for t, n, chunk in _chunks(texts, window, modulus))
                rows = list(found.items())
                for k in range(0, len(rows), 8192):
                    columns = zip(*((*key, n) for key, n in rows[k: k + 8192]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))
    return run


def dictionary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS, modulus: int = MODULUS) -> DataFrame:
    """Distinct chunks: ``(lang, owned, chunk, n, slice)``, stored; null lang is ``und``, null text empty."""
    rows = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), col(text_col).cast("string").alias("text")).where("text <> ''")
    found = (rows.mapInArrow(_parse(max_words - 1, modulus), "lang string, owned int, chunk binary, n long")
             .groupBy("lang", "owned", "chunk").agg(F.sum("n").alias("n")))
    # a slice is a run of rows of one partition
    number = F.monotonically_increasing_id()
    return stored(found.withColumn("slice", number - F.pmod(number, F.lit(SLICE_ROWS))), "chunks")


def _phrases(langs: list[str], owned: np.ndarray, chunks: list[bytes], counts: np.ndarray, sizes: int):
    """Phrases of 1 to ``sizes`` words in slabs: ``(bytes, starts, ends, hashes, other hashes, weights, lang numbers)``, one entry a phrase."""
    salts = {lang: np.uint64(zlib.crc32(lang.encode()) + 1) for lang in set(langs)}
    for at, group in _numbered(chunks):
        raw = b"\n".join(group) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        starts, ends, piece = _words(data)
        if not len(starts):
            continue
        chunk = np.searchsorted(np.cumsum([len(c) + 1 for c in group]), starts, side="right")
        first = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
        rank = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
        own = rank < owned[at + chunk]
        salt = np.array([salts[lang] for lang in langs[at: at + len(group)]], np.uint64)[chunk]
        hashes = [span_hashes(data, starts, ends, seed) for seed in (21, 22)]
        mix = [mixed(salt * np.uint64(0x9FB21C651E98DF25)) for _ in hashes]
        for m in range(1, sizes + 1):
            n = len(starts) - m + 1
            if n <= 0:
                break
            mix = [mixed(g[:n] + h[m - 1: m - 1 + n]) for g, h in zip(mix, hashes)]
            here = np.flatnonzero(own[:n] & (piece[:n] == piece[m - 1: m - 1 + n]))
            yield raw, starts[here], ends[here + m - 1], mix[0][here], mix[1][here], counts[at + chunk[here]], at + chunk[here]


def _columns(part) -> tuple:
    return (part.column("lang").to_pylist(), part.column("owned").to_numpy(), part.column("chunk").to_pylist(), part.column("n").to_numpy())


def _send(sizes: int, bits: int, owner_bits: int):
    """Slices -> ``(slice, owner, block, counts)``: hashes of their phrases cut to ``bits``, with counts."""
    names = ["slice", "owner", "block", "counts"]

    def send(slice_id, held):
        h = np.concatenate([x[0] for x in held]) >> np.uint64(64 - bits)
        order = np.argsort(h)
        h = h[order]
        new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        total = np.add.reduceat(np.concatenate([x[1] for x in held])[order], new)
        h = h[new]
        owner = (h >> np.uint64(bits - owner_bits)).astype(np.int64)
        a = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        b = np.append(a[1:], len(h))
        return pa.RecordBatch.from_arrays([
            pa.array([slice_id] * len(a), pa.int64()), pa.array(owner[a]),
            pa.array([golomb.encode(h[x:y]) for x, y in zip(a, b)], pa.binary()),
            pa.array([zlib.compress(total[x:y].astype("<i8").tobytes(), 1) for x, y in zip(a, b)], pa.binary())], names)

    def run(batches):
        now, held = None, []
        for batch in batches:
            ids = batch.column("slice").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else []
            for a, b in zip(cuts, np.append(cuts[1:], len(ids)) if len(ids) else []):
                if ids[a] != now:
                    if held:
                        yield send(now, held)
                    now, held = ids[a], []
                held += [(p[3], p[5]) for p in _phrases(*_columns(batch.slice(a, b - a)), sizes)]
        if held:
            yield send(now, held)
    return run


def _own(least: int):
    """Owner: add up and answer each block with its hashes that reach ``least``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks = [golomb.decode(b) for b in pdf["block"]]
        counts = np.concatenate([np.frombuffer(zlib.decompress(c), "<i8") for c in pdf["counts"]])
        values, which = np.unique(np.concatenate(blocks), return_inverse=True)
        totals = np.zeros(len(values), np.int64)
        np.add.at(totals, which, counts)
        often = (totals >= least)[which]
        out, at = [], 0
        for slice_id, block in zip(pdf["slice"], blocks):
            found = block[often[at: at + len(block)]]
            at += len(block)
            if len(found):
                out.append((slice_id, golomb.encode(found)))
        return pd.DataFrame(out, columns=["slice", "found"])
    return run


def _write_out(sizes: int, bits: int):
    """A slice's chunks and the hashes found -> ``(lang, size, phrase, n)`` added up within the slice."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = np.unique(np.concatenate([golomb.decode(b) for b in right.column("found").to_pylist()])) if right.num_rows else np.zeros(0, np.uint64)
        langs, phrases, sums = [], [], []
        if len(found) and left.num_rows:
            columns = _columns(left.combine_chunks())
            raws, parts = [], []
            for raw, a, b, h, other, n, chunk in _phrases(*columns, sizes):
                at = np.searchsorted(found, h >> np.uint64(64 - bits))
                at[at == len(found)] = 0
                hit = np.flatnonzero(found[at] == h >> np.uint64(64 - bits))
                parts.append(_added(h[hit], other[hit], n[hit], np.full(len(hit), len(raws)), a[hit], b[hit], chunk[hit]))
                raws.append(raw)
            _, _, n, slab, a, b, chunk = _added(*(np.concatenate(c) for c in zip(*parts))) if parts else [np.zeros(0, np.int64)] * 7
            langs, sums = [columns[0][t] for t in chunk.tolist()], n
            phrases = [_joined(raws[k][x:y]) for k, x, y in zip(slab.tolist(), a.tolist(), b.tolist())]
        return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
                         "n": pa.array(sums, pa.int64())})
    return run


def _added(h, other, n, *rest):
    """Entries with the same 128 bits of hash as one, ``n`` added up, the rest as in the first."""
    order = np.lexsort((other, h))
    h, other = h[order], other[order]
    new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (other[1:] != other[:-1])))) if len(h) else order
    return h[new], other[new], np.add.reduceat(n[order], new) if len(h) else n, *(c[order[new]] for c in rest)


def _joined(phrase: bytes) -> bytes:
    if b"\t" in phrase or b"  " in phrase:
        return b" ".join(w for w in phrase.replace(b"\t", b" ").split(b" ") if w)
    return phrase


def frequent_phrases(chunks: DataFrame, max_words: int = MAX_WORDS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(lang, size, phrase, f)``, stored: phrases of 1 to ``max_words`` words that occur ``least_count`` times."""
    words = chunks.agg(F.sum(F.col("owned").cast("long"))).first()[0] or 0
    entries = max(words * max_words, 1)
    bits = min(64, max(math.ceil(math.log2(entries)) + 6, 16))
    owner_bits = min(max(math.ceil(math.log2(entries / OWNED)), 6), bits - 1)
    sent = chunks.select("slice", "lang", "owned", "chunk", "n").mapInArrow(
        _send(max_words, bits, owner_bits), "slice long, owner long, block binary, counts binary")
    answers = sent.groupBy("owner").applyInPandas(_own(least_count), "slice long, found binary")
    found = chunks.select("slice", "lang", "owned", "chunk", "n").groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        _write_out(max_words, bits), "lang string, phrase string, n long")
    return stored(found.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least_count)
                  .select("lang", F.size(F.split("phrase", " ")).alias("size"), "phrase", "f"), "phrases")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = MAX_WORDS, least_count: int = LEAST_COUNT,
                 contained_percent: int = 50, top: int | None = 2000, modulus: int = MODULUS) -> DataFrame:
    """Ranked phrases per lang: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and split into pieces at ``. , ; : ! ?`` and line breaks, pieces into words at blanks and
    tabs. Candidates are phrases of 2 to ``max_words`` words within a piece that occur ``a >= least_count`` times
    in the lang. A cut after k words gives ``l`` and ``r``, the counts of both sides, and the score
    floor(10^6 a a / (l r)) in exact decimals (up to 10^15 occurrences); the lowest-scoring cut counts, of
    equal ones the first. A candidate is dropped if a longer one that contains it occurs ``contained_percent``
    percent as often. ``n`` is the lang's words. Ranks go by score and ``a`` descending, then phrase by its bytes;
    ``top`` is the length of each report (None: all). Null lang is ``und``; null and empty texts have no words;
    rows that repeat count as often as they stand there; no words, no rows.
    """
    chunks = dictionary(docs, lang_col, text_col, max_words, modulus)
    totals = chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("owned")).alias("n"))
    phrases = frequent_phrases(chunks, max_words, least_count)
    longer = phrases.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    count = lambda side, name: phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    scored = cuts.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"])
    wide = lambda c: f"CAST({c} AS DECIMAL(15,0))"
    score = F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * {wide('a')} * {wide('a')}) div ({wide('l')} * {wide('r')})")
    best = (scored.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.*"))
    if max_words > 2:
        inside = (longer.where("size > 2").select("lang", F.col("a").alias("f"), "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
                  .select("lang", "f", "w", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
                  .select("lang", part(F.col("at"), F.col("m")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("held")))
        best = best.join(inside, ["lang", "phrase"], "left").where(f"held IS NULL OR 100 * held < {int(contained_percent)} * a")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.withColumn("rank", rank.cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
