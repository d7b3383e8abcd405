"""Benchmark decontamination by greedy string tiling (Wise's running Karp-Rabin scheme).

The test items are dealt into blocks of a bounded number of words; each block is broadcast
and meets all documents in turn. Within a task a document's words become numbers of the
block's vocabulary, its five-word windows are joined with the block's seed table, and each
item that shares enough seeds is tiled: the longest common run of unmarked words is marked,
then the next longest, down to five words, so that passages whose sentences were reordered
are still covered. An item is leaked if its tiles cover at least ``threshold`` of its words.

Words: text in lower case (Unicode), runs of ASCII letters, digits and non-ASCII characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusflow.llm.common import filter_rows, id_text

#: Words of a seed, and of the shortest tile.
MIN_MATCH = 5
#: Share of an item's words that its tiles must cover.
THRESHOLD = 0.8
#: Words of test items in a broadcast block, about.
BLOCK_WORDS = 1_000_000

_WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_WORD).split()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Rolling:
    """Karp-Rabin sums (modulo 2**64) of a word sequence; ``windows(s)`` has the hash of each
    window of s words, in which equal windows are equal wherever they stand."""

    def __init__(self, ids: np.ndarray):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        self.n = len(ids)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * _powers(_BASE, self.n), dtype=np.uint64)])
        self.back = _powers(_INVERSE, self.n)

    def windows(self, s: int) -> np.ndarray:
        if s > self.n:
            return np.zeros(0, np.uint64)
        return (self.sums[s:] - self.sums[: self.n - s + 1]) * self.back[: self.n - s + 1]


def _open(free: np.ndarray, s: int) -> np.ndarray:
    """Which windows of ``s`` positions are free throughout."""
    run = np.concatenate([[0], np.cumsum(free)])
    return run[s:] - run[:-s] == s


def tile(doc: np.ndarray, item: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(doc start, item start, words)``, longest first; zeros in ``doc`` match nothing.

    Among runs of equal length the first in the document, then in the item, is marked first.
    Each word of either side belongs to one tile at most.
    """
    in_doc, in_item = doc != 0, np.ones(len(item), bool)
    left, right = Rolling(doc), Rolling(item)
    tiles, s = [], len(item)
    while s >= min_match and in_item.any():
        found, best = [], 0
        if len(doc) >= s:
            for i, j in _run_starts(left, right, in_doc, in_item, s):
                k = min(len(doc) - i, len(item) - j)
                same = (doc[i:i + k] == item[j:j + k]) & in_doc[i:i + k] & in_item[j:j + k]
                k = k if same.all() else int(np.argmin(same))
                if k >= s:
                    found.append((k, i, j))
                    best = max(best, k)
        if not found:
            s = max(s // 2, min_match) if s > min_match else 0
            continue
        for k, i, j in sorted(x for x in found if x[0] == best):
            if in_doc[i:i + k].all() and in_item[j:j + k].all():
                in_doc[i:i + k] = in_item[j:j + k] = False
                tiles.append((i, j, k))
    return tiles


def _run_starts(left: Rolling, right: Rolling, in_doc: np.ndarray, in_item: np.ndarray, s: int):
    """Pairs ``(doc, item)`` where a run of equal free windows of ``s`` words starts: on each diagonal the
    first window alone, since the longest runs start nowhere else (periodic texts have runs, not pairs, to extend)."""
    spots = np.flatnonzero(_open(in_doc, s))
    ours = right.windows(s)
    hashes = left.windows(s)[spots]
    hit = np.isin(hashes, ours)
    spots, hashes = spots[hit], hashes[hit]
    order = np.argsort(hashes, kind="stable")
    spots, hashes = spots[order], hashes[order]
    free = _open(in_item, s)
    first, last = np.searchsorted(hashes, ours, "left"), np.searchsorted(hashes, ours, "right")
    follows, before = np.zeros(len(in_doc) + 1, bool), spots[:0]
    for j in np.flatnonzero(free & (last > first)).tolist():
        here = spots[first[j]:last[j]]
        linked = j > 0 and free[j - 1]
        follows[before + 1] = False
        if linked:
            follows[spots[first[j - 1]:last[j - 1]] + 1] = True
            before = spots[first[j - 1]:last[j - 1]]
        for i in here[~follows[here]].tolist():
            yield i, j


class Block:
    """Vocabulary, seed tables and words of some test items; small enough to broadcast.

    Seeds have ``min_match`` words; an item of fewer is a seed as a whole, in a table of its length.
    """

    def __init__(self, items: list[tuple], min_match: int, least_words: int = 1):
        self.vocabulary: dict[bytes, int] = {}
        self.items, by_length = [], {}
        for key, text in items:
            words = words_of(text or "")
            if len(words) >= max(least_words, 1):
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words])
                m = min(min_match, len(words))
                hashes = Rolling(ids).windows(m)
                by_length.setdefault(m, []).append((len(self.items), np.unique(hashes)))
                self.items.append((key, ids, hashes))
        self.tables = []
        for m, entries in sorted(by_length.items()):
            seeds = np.concatenate([h for _, h in entries])
            order = np.argsort(seeds, kind="stable")
            distinct, starts = np.unique(seeds[order], return_index=True)
            owners = np.concatenate([np.full(len(h), o) for o, h in entries])[order]
            self.tables.append((m, distinct, np.append(starts, len(seeds)), owners))

    def leaks(self, text: str, threshold: float):
        """``(item, coverage, tiles)`` of every item that the text leaks."""
        get = self.vocabulary.get
        doc = np.array([get(w, 0) for w in words_of(text)], np.int64)
        rolling = None
        for m, seeds, starts, owners in self.tables:
            spots = np.flatnonzero(_open(doc != 0, m)) if len(doc) >= m else ()
            if len(spots):
                rolling = rolling or Rolling(doc)
                yield from self._tiled(doc, spots, rolling.windows(m)[spots], m, seeds, starts, owners, threshold)

    def _tiled(self, doc, spots, hashes, m, seeds, starts, owners, threshold):
        at = np.minimum(np.searchsorted(seeds, hashes), len(seeds) - 1)
        hit = seeds[at] == hashes
        if not hit.any():
            return
        spots, at = spots[hit], at[hit]
        known = np.unique(at)
        hashes = seeds[known]
        for o in np.unique(np.concatenate([owners[starts[k]:starts[k + 1]] for k in known])).tolist():
            key, item, windows = self.items[o]
            shared = np.isin(windows, hashes)
            reach = np.convolve(shared, np.ones(m, int)) > 0  # no tiling covers more than this
            if reach.sum() < threshold * len(item):
                continue
            own = spots[np.isin(at, known[np.isin(hashes, windows)])]
            inside = np.zeros(len(doc) + m, bool)
            for k in range(m):
                inside[own + k] = True
            tiles = tile(np.where(inside[: len(doc)], doc, 0), item, m)
            covered = sum(k for _, _, k in tiles) / len(item)
            if covered >= threshold:
                yield key, covered, tiles


def _blocks(spark, benchmark: DataFrame, id_col: str, text_col: str, min_match: int, block_words: int, least_words: int = 1):
    """Broadcast blocks, one after the other. Items are dealt by a hash of their rows."""
    rows = id_text(benchmark, id_col, text_col)
    total = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = -(-total // block_words)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) == k).distinct()
        yield spark.sparkContext.broadcast(Block([tuple(r) for r in part.collect()], min_match, least_words))


def _find(block, threshold, item_type):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for i in range(batch.num_rows):
                found = list(block.value.leaks(texts[i].as_py(), threshold))
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[i].as_py()] * len(found), ids.type),
                        pa.array([key for key, _, _ in found], item_type),
                        pa.array([c for _, c, _ in found], pa.float64()),
                        pa.array([len(t) for _, _, t in found], pa.int64()),
                        pa.array([max(k for _, _, k in t) for _, _, t in found], pa.int64()),
                        pa.array([[{"doc_word": i, "item_word": j, "words": k} for i, j, k in t] for _, _, t in found],
                                 pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))),
                    ], ["doc_id", "item_id", "coverage", "n_tiles", "longest", "tiles"])
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", min_match: int = MIN_MATCH, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS,
          least_words: int = MIN_MATCH) -> DataFrame:
    """One row per leaked (document, item): ``doc_id, item_id, coverage, n_tiles, longest, tiles``.

    ``item_id`` has the type of ``item_col``. Null texts are empty. Items of fewer than ``least_words`` words
    are left out; with less than ``min_match``, an item of fewer words than that is found where all its words stand in
    one piece (very short ones in clean documents too). An item or a document without words leaks nothing. Equal items each give a row, rows that repeat an item
    count once, repeated documents each give their rows. Clean documents give none; an empty
    table on either side gives no rows.
    """
    rows = id_text(docs, id_col, text_col)
    item = benchmark.schema[item_col].dataType
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, item_id {item.simpleString()}, coverage double, n_tiles long, longest long, tiles array<struct<doc_word:long,item_word:long,words:long>>"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(docs.sparkSession, benchmark, item_col, item_text_col, min_match, block_words, least_words):
        out = out.unionByName(rows.mapInArrow(_find(block, threshold, to_arrow_type(item)), schema))
    return out


def _clean(block, threshold):
    return lambda texts: [next(block.value.leaks(t, threshold), None) is None for t in texts]


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               min_match: int = MIN_MATCH, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS, least_words: int = MIN_MATCH) -> DataFrame:
    """``docs`` without the rows that leak an item; rows and columns are otherwise as they were.

    Items of fewer than ``least_words`` words drop nothing, since clean documents hold them too (``leaks`` can list
    them). Null and empty texts, of documents or items, leak nothing; repeated rows stay or go together; an empty
    table on either side drops nothing.
    """
    for block in _blocks(docs.sparkSession, benchmark, item_col, item_text_col, min_match, block_words, least_words):
        docs = filter_rows(docs, text_col, _clean(block, threshold))
    return docs
