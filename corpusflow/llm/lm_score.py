"""Language-model scores from a log-frequency Bloom filter (Talbot and Osborne 2007).

Counting. A word is known by the XXH64 hash of its bytes, a pair of words by 48 bits mixed from
two hashes. Every training task sends, for each of ``SEGMENTS`` hash ranges, blocks of sorted
distinct hashes (Golomb coded) with their counts, and a segment merges its blocks: a frequent
word or pair is one entry of each block, and a segment holds a fixed share of all hashes. There
are ``SEGMENTS`` ranges or more, so many that each has about ``segment_text`` bytes of text.

The filter. A count c is quantised to q = 1 + floor(log(c) / log(``LOG_BASE``)) and the entries
(n-gram, 1) ... (n-gram, q) are put into the n-gram's segment of one bit array. A reader probes
(n-gram, 1), (n-gram, 2) ... until one is missing, and takes the middle of the last level;
there are no false negatives, and few overestimates. The array is broadcast; its size follows
the corpus, up to ``max_filter_bytes``. If the entries need more, the array has half of it, for
all words and the pairs from a cutoff of their count on (words alone may need more). The pairs
below the cutoff are in slabs of segments of at most the other half (one segment at least); each
slab is broadcast for a pass of its own over the texts, which adds what its pairs add to a score.
So every pair counts, whatever the corpus size; more pairs, more passes.

The score of a text is the sum over its words and its end of log10 of
``LAMBDA * c(h, w) / c(h) + (1 - LAMBDA) * (c(w) + 1) / (N + 1 * (V + 1))``, with all counts
from the filter, h the word before (at first the end of a text) and pairs that weren't seen 0.

The base score is exact. The commonest ``head`` words are broadcast with their counts; the few
others of a text are joined with the count table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm import golomb
from corpusflow.llm.common import col, slabs, stored

LOG_BASE = 1.5
LAMBDA = 0.7
#: Ranges of the hashes at least, as a power of two; each is counted and filtered on its own.
SEGMENT_BITS = 6
SEGMENTS = 1 << SEGMENT_BITS
#: Bytes of text for each range, and ranges at most, as a power of two.
SEGMENT_TEXT, MOST_SEGMENT_BITS = 16 << 20, 16
KEY_BITS = 48
#: Bits of the filter for each entry, and probes of each entry.
BITS, PROBES = 10, 4
MAX_FILTER_BYTES = 256 << 20
#: Words that are broadcast with their exact counts, 16 bytes each.
HEAD = 1 << 20
#: Hashes that a counting task holds before it sends them on; bytes of text scored at once.
HELD, SLAB = 4 << 20, 4 << 20
#: The end of a text; no word.
END = xxhash.xxh64_intdigest(b"\n")

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN, _LOW = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFF)
_CUT = np.uint64(64 - KEY_BITS)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def pair_keys(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """48-bit keys of pairs of word hashes."""
    return _mix(history * np.uint64(3) + _mix(word + np.uint64(1))) >> _CUT


def word_keys(word: np.ndarray) -> np.ndarray:
    """48-bit keys of single words: the leading bits of their hashes."""
    return word >> _CUT


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of the texts, END after each text; those of the words before; and
    where each text starts."""
    hashes, starts = [], []
    for t in texts:
        starts.append(len(hashes))
        hashes += map(xxhash.xxh64_intdigest, words_of(t))
        hashes.append(END)
    hashes = np.array(hashes, np.uint64)
    return hashes, np.roll(hashes, 1), np.array(starts, np.int64)


def _text_slabs(column, limit: int = SLAB):
    return slabs((t.as_py() or "" for t in column), limit)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    keys, counts = np.concatenate([*keys, np.zeros(0, np.uint64)]), np.concatenate([*counts, np.zeros(0, np.int64)])
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def _pack(counts: np.ndarray) -> bytes:
    return golomb.encode(np.cumsum(counts).astype(np.uint64))


def _unpack(block: bytes) -> np.ndarray:
    return np.diff(golomb.decode(block).astype(np.int64), prepend=0)


def _blocks(segment_bits: int):
    """(segment, word, keys, counts): Golomb-coded sorted hashes of words or pairs, and counts."""
    def cut(arrays):
        rows = []
        for word, bits in ((True, 64), (False, KEY_BITS)):
            keys, counts = np.unique(np.concatenate([a[0 if word else 1] for a in arrays]), return_counts=True)
            edges = np.searchsorted(keys, np.arange(1, 1 << segment_bits, dtype=np.uint64) << np.uint64(bits - segment_bits))
            rows += [(s, word, golomb.encode(k), _pack(c)) for s, (k, c) in enumerate(zip(np.split(keys, edges), np.split(counts, edges))) if len(k)]
        kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["segment", "word", "keys", "counts"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for group in _text_slabs(batch.column("text")):
                hashes, before, _ = _tokens(group)
                held.append((hashes, pair_keys(before, hashes)))
                n += len(hashes)
                if n >= HELD:
                    yield cut(held)
                    held, n = [], 0
        if held:
            yield cut(held)

    return run


def _segment(pdf: pd.DataFrame) -> pd.DataFrame:
    """The merged words and pairs of a segment, and how many of each have each count."""
    out = {"segment": pdf["segment"].iloc[:1].tolist()}
    for name, own in (("word", pdf[pdf["word"]]), ("pair", pdf[~pdf["word"]])):
        keys, counts = _merge([golomb.decode(k) for k in own["keys"]], [_unpack(c) for c in own["counts"]])
        levels, sizes = np.unique(counts, return_counts=True)
        out |= {f"{name}_keys": [golomb.encode(keys)], f"{name}_counts": [_pack(counts)], f"{name}_levels": [levels], f"{name}_sizes": [sizes]}
    return pd.DataFrame(out)


def quantise(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(LOG_BASE) + 1e-9).astype(np.int64)


def level_count(q: np.ndarray) -> np.ndarray:
    """The count that stands for level q: the middle of its range on a log scale; 0 for none."""
    low = np.ceil(LOG_BASE ** (q - 1.0) - 1e-9)
    high = np.maximum(np.ceil(LOG_BASE ** (q * 1.0) - 1e-9) - 1, low)
    return np.where(q > 0, np.sqrt(low * high), 0.0)


_LEVELS = level_count(np.arange(0, 128))


def _probes(keys: np.ndarray, level: int, bits: int):
    """The bits of (key, level), one probe after the other, within the key's segment of ``bits`` bits."""
    x = _mix(keys + np.uint64(int(_GOLDEN) * level & 0xFFFFFFFFFFFFFFFF))
    step = (x >> np.uint64(32)) | np.uint64(1)
    for _ in range(PROBES):
        yield ((x & _LOW) * np.uint64(bits)) >> np.uint64(32)
        x = x + step


class Filter:
    """The bit array: equal segments of ``bits`` bits (a multiple of 8, below 2**32), from ``first`` on."""

    def __init__(self, bits: int, array: bytearray, total: int, distinct: int, cutoff: int, segment_bits: int = SEGMENT_BITS, first: int = 0):
        self.bits, self.array, self.total, self.distinct, self.cutoff = bits, array, total, distinct, cutoff
        self.segment_bits, self.first = segment_bits, first

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Estimated counts, by probing level after level."""
        array = np.frombuffer(self.array, np.uint8)
        q = np.zeros(len(keys), np.int64)
        base = (keys >> np.uint64(KEY_BITS - self.segment_bits)) - np.uint64(self.first)
        base *= np.uint64(self.bits)
        alive, level = np.arange(len(keys)), 0
        while len(alive) and level < 126:
            level += 1
            there = np.arange(len(alive))
            for spot in _probes(keys[alive], level, self.bits):
                spot = (base[alive] + spot)[there]
                hit = (array[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if not hit.all():
                    there = there[hit]
            alive = alive[there]
            q[alive] = level
        return _LEVELS[q]

    def score(self, hashes: np.ndarray, before: np.ndarray, words: np.ndarray, back: np.ndarray) -> np.ndarray:
        """log10 probability of each token; ``words[back]`` are the ``hashes``."""
        known = self.counts(word_keys(words))
        c_word = known[back]
        c_before = np.roll(c_word, 1)  # every text ends with END, so the first history is one as well
        pairs, back = np.unique(pair_keys(before, hashes), return_inverse=True)
        c_pair = np.minimum(self.counts(pairs)[back], np.minimum(c_word, c_before))
        p = (1 - LAMBDA) * (c_word + 1) / (self.total + self.distinct + 1)
        p += LAMBDA * np.divide(c_pair, c_before, out=np.zeros_like(p), where=c_before > 0)
        return np.log10(np.minimum(p, 1.0))

    def gain(self, slab: Filter, hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """What the pairs in ``slab``, a filter of some segments' pairs below the cutoff, add to the ``score`` of each token."""
        out = np.zeros(len(hashes))
        keys = pair_keys(before, hashes)
        segment = keys >> np.uint64(KEY_BITS - self.segment_bits)
        own = np.flatnonzero((segment >= np.uint64(slab.first)) & (segment < np.uint64(slab.first + len(slab.array) * 8 // slab.bits)))
        pairs, back = np.unique(keys[own], return_inverse=True)
        c_pair = np.where(self.counts(pairs) > 0, 0.0, slab.counts(pairs))[back]
        own, c_pair = own[c_pair > 0], c_pair[c_pair > 0]
        words, back = np.unique(np.concatenate([hashes[own], before[own]]), return_inverse=True)
        c_word, c_before = np.split(self.counts(word_keys(words))[back], 2)
        p = (1 - LAMBDA) * (c_word + 1) / (self.total + self.distinct + 1)
        more = np.divide(np.minimum(c_pair, np.minimum(c_word, c_before)), c_before, out=np.zeros_like(p), where=c_before > 0)
        out[own] = np.log10(np.minimum(p + LAMBDA * more, 1.0)) - np.log10(np.minimum(p, 1.0))
        return out


def _filter_bits(bits: int, cutoff: int, rare: bool = False):
    """The bits of each segment: its words and the pairs counted ``cutoff`` times or more, or, if ``rare``, the other pairs."""
    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                array = np.zeros(bits, bool)
                words = [] if rare else [(word_keys(golomb.decode(row.word_keys)), _unpack(row.word_counts), 1, 1 << 62)]
                pairs = (golomb.decode(row.pair_keys), _unpack(row.pair_counts), *((1, cutoff) if rare else (cutoff, 1 << 62)))
                for keys, counts, least, end in (*words, pairs):
                    own = (counts >= least) & (counts < end)
                    keys, levels = keys[own], quantise(counts[own])
                    for level in range(1, int(levels.max(initial=0)) + 1):
                        keys, levels = keys[levels >= level], levels[levels >= level]
                        for spot in _probes(keys, level, bits):
                            array[spot.astype(np.int64)] = True
                yield pd.DataFrame({"segment": [row.segment], "bits": [np.packbits(array, bitorder="little").tobytes()]})
    return run


def _word_rows(least: int, most: int):
    """(h, c) of the words with a count from ``least`` to ``most``."""
    def run(batches):
        for batch in batches:
            for keys, counts in zip(batch.column("word_keys"), batch.column("word_counts")):
                keys, counts = golomb.decode(keys.as_py()), _unpack(counts.as_py())
                own = (counts >= least) & (counts <= most)
                yield pa.RecordBatch.from_arrays([pa.array(keys[own].view(np.int64)), pa.array(counts[own])], ["h", "c"])
    return run


class Model:
    """``segments``: the stored counts; ``filter``: the broadcast filter; ``head``: the broadcast
    sorted hashes and counts of all words counted ``least`` times or more; N and V; ``rare``: the
    stored filter segments of the pairs that ``filter`` has no room for, their bits and how many
    are in a slab, or None."""

    def __init__(self, segments, filter_, head, least, total, distinct, rare=None):
        self.segments, self.filter, self.head, self.least, self.total, self.distinct = segments, filter_, head, least, total, distinct
        self.rare = rare

    def slabs(self):
        """Filters of the pairs below the cutoff, one for each slab of segments."""
        if self.rare is None:
            return
        made, bits, step = self.rare
        whole = self.filter.value
        for first in range(0, 1 << whole.segment_bits, step):
            last = min(first + step, 1 << whole.segment_bits)
            array = _array(made.where(F.col("segment").between(first, last - 1)), bits, first, last)
            yield Filter(bits, array, whole.total, whole.distinct, whole.cutoff, whole.segment_bits, first)

    def rare_words(self) -> DataFrame:
        return self.segments.select("word_keys", "word_counts").mapInArrow(_word_rows(1, self.least - 1), "h long, c long")


def _array(made: DataFrame, bits: int, first: int, last: int) -> bytearray:
    """The bit array of the segments from ``first`` to before ``last``."""
    array, size = bytearray((last - first) * bits // 8), bits // 8
    for row in made.toLocalIterator():
        at = (row["segment"] - first) * size
        array[at:at + size] = row["bits"]
    return array


def train(docs: DataFrame, text_col: str = "text", head: int = HEAD, max_filter_bytes: int = MAX_FILTER_BYTES, segment_text: int = SEGMENT_TEXT) -> Model:
    """Count all texts of ``docs`` and build the filter. Null and empty texts are an end alone."""
    spark, texts = docs.sparkSession, docs.select(col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segment_bits = min(max(SEGMENT_BITS, math.ceil(math.log2(max(size / segment_text, 1)))), MOST_SEGMENT_BITS)
    n_segments = 1 << segment_bits
    blocks = texts.mapInArrow(_blocks(segment_bits), "segment int, word boolean, keys binary, counts binary")
    both = ", ".join(f"{k}_keys binary, {k}_counts binary, {k}_levels array<long>, {k}_sizes array<long>" for k in ("word", "pair"))
    segments = stored(blocks.groupBy("segment").applyInPandas(_segment, f"segment int, {both}"), "ngram-counts")
    words, pairs = (_histogram(segments, k) for k in ("word", "pair"))
    total, distinct = sum(c * n for c, n in words), sum(n for _, n in words)
    entries = sum(int(quantise(np.array([c]))[0]) * n for c, n in words) + n_segments
    cutoff, rest = 1, sum(int(quantise(np.array([c]))[0]) * n for c, n in pairs)
    left_out, room = 0, max_filter_bytes if (entries + rest) * BITS <= 8 * max_filter_bytes else max_filter_bytes // 2
    for c, n in pairs:
        if (entries + rest) * BITS <= 8 * room:
            break
        cutoff, own = c + 1, int(quantise(np.array([c]))[0]) * n
        rest, left_out = rest - own, left_out + own
    size_of = lambda n: max(64, -(-n * BITS // n_segments) * 21 // 20 // 8 * 8)
    bits, rare = size_of(entries + rest), None
    columns = segments.select("segment", "word_keys", "word_counts", "pair_keys", "pair_counts")
    made = stored(columns.mapInPandas(_filter_bits(bits, cutoff), "segment int, bits binary"), "filter-segments")
    array = _array(made, bits, 0, n_segments)
    if left_out:
        rare_bits = size_of(left_out + n_segments)
        rare = stored(columns.mapInPandas(_filter_bits(rare_bits, cutoff, True), "segment int, bits binary"), "rare-segments"), rare_bits, max(1, 8 * room // rare_bits)
    least, room = 1 << 62, head  # the commonest words, as many as fit
    for c, n in reversed(words):
        room -= n
        if room < 0:
            break
        least = c
    rows = segments.select("word_keys", "word_counts").mapInArrow(_word_rows(least, 1 << 62), "h long, c long").toArrow()
    h = rows.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    broadcast = spark.sparkContext.broadcast
    return Model(segments, broadcast(Filter(bits, array, total, distinct, cutoff, segment_bits)), broadcast((h[order], rows.column("c").to_numpy()[order])), least, total, distinct, rare)


def _histogram(segments: DataFrame, name: str) -> list[tuple[int, int]]:
    """``(count, n-grams with it)`` in ascending order; high counts are distinct in few n-grams,
    so there are about as many rows as the square root of the tokens."""
    rows = segments.select(F.explode(F.arrays_zip(f"{name}_levels", f"{name}_sizes")).alias("x"))
    return sorted((r[0], r[1]) for r in rows.groupBy(f"x.{name}_levels").agg(F.sum(f"x.{name}_sizes")).collect())


def _score(model_filter, model_head, total, distinct, whole):
    def run(batches):
        common, counts = model_head.value
        for batch in batches:
            ids, at = batch.column("doc_id"), 0
            for group in _text_slabs(batch.column("text")):
                hashes, before, starts = _tokens(group)
                words, back = np.unique(hashes, return_inverse=True)
                place = np.minimum(np.searchsorted(common, words), max(len(common) - 1, 0))
                c = np.where(common[place] == words, counts[place], 0) if len(common) else np.zeros(len(words), np.int64)
                base = np.log10((c + 1) / (total + distinct + 1))
                if not whole:
                    base[c == 0] = 0.0
                sizes = np.diff(starts, append=len(hashes))
                rare = np.zeros(0, np.int64) if whole else np.flatnonzero((c == 0)[back])
                owner = np.searchsorted(starts, rare, side="right") - 1
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(group) + 1)), pa.int32()), pa.array(hashes[rare].view(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    ids[at:at + len(group)], pa.array(sizes), pa.array(np.add.reduceat((c > 0).astype(np.int64)[back], starts)), pa.array(np.add.reduceat(base[back], starts)),
                    pa.array(np.add.reduceat(model_filter.value.score(hashes, before, words, back), starts)), lists],
                    ["doc_id", "n_tokens", "head_known", "head_base", "score", "rest"])
                at += len(group)
    return run


def _gains(model_filter, slab):
    def run(batches):
        for batch in batches:
            ids, at = batch.column("rid"), 0
            for group in _text_slabs(batch.column("text")):
                hashes, before, starts = _tokens(group)
                gain = model_filter.value.gain(slab.value, hashes, before)
                yield pa.RecordBatch.from_arrays([ids[at:at + len(group)], pa.array(np.add.reduceat(gain, starts))], ["rid", "gain"])
                at += len(group)
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words of the text and its end; a null or empty text is an end alone.
    ``n_known`` are tokens seen in training, ``base_score`` the exact add-one unigram log10 sum,
    ``score`` the model's log10 probability. With nothing learned every token has base 0 and
    the same smoothed probability. Repeated rows each give a row.
    """
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    rid = F.monotonically_increasing_id()
    if model.rare is not None:  # the passes read the texts again and must know their rows
        rows = stored(rows.select(F.struct(rid.alias("rid"), "doc_id").alias("doc_id"), "text"), "scored-texts")
        rid = F.col("doc_id.rid")
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, head_known long, head_base double, score double, rest array<long>"
    whole = model.least <= 1
    scored = rows.mapInArrow(_score(model.filter, model.head, model.total, model.distinct, whole), schema)
    scored = stored(scored.select(rid.alias("rid"), "*"), "scores")
    if model.rare is not None:
        gains = _gained(rows.select(rid.alias("rid"), "text"), model)
        scored = scored.join(gains, "rid", "left").withColumns({"doc_id": F.col("doc_id.doc_id"), "score": F.col("score") + F.coalesce("gain", F.lit(0.0))}).drop("gain")
    rare = scored.select("rid", F.explode("rest").alias("h")).join(model.rare_words(), "h", "left")
    gain = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(model.total + model.distinct + 1))
    rare = rare.groupBy("rid").agg(F.sum(gain).alias("rare_base"), F.count("c").alias("rare_known"))
    return scored.drop("rest").join(rare, "rid", "left").select(
        "doc_id", "n_tokens", (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("head_base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score")


def _gained(texts: DataFrame, model: Model) -> DataFrame:
    """``(rid, gain)``: what the pairs below the cutoff add to the scores, one pass for each slab."""
    parts = []
    for slab in model.slabs():
        shared = texts.sparkSession.sparkContext.broadcast(slab)
        part = texts.mapInArrow(_gains(model.filter, shared), "rid long, gain double").where("gain <> 0")
        parts.append(stored(part, f"gains-{len(parts)}"))
        shared.destroy()
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("rid").agg(F.sum("gain").alias("gain"))
