"""Grouping of spelling variants by pivotal grams (Deng, Li and Feng, "A Pivotal Prefix Based
Filtering Algorithm for String Similarity Search", 2014), for one edit.

1. Words are counted with partial sums in the tasks; the vocabulary is stored.
2. Bigrams have one global order, rarest first. A word's prefix is its three rarest bigrams (and
   equal ones); its pivots are the two disjoint bigrams of the prefix whose frequencies add up
   to the least, found by dynamic programming over their positions.
3. One edit leaves one of the two pivots as it is. Of two words that differ by one edit, let ``r`` be
   the one whose prefix ends later in the order, and ``s`` the other; the pivot left of ``s``
   is then in the prefix of ``r``.
4. An edit is on one side of the surviving pivot, so the bigrams stand at the same distance from
   the start of their words (edit to the right) or from the end (edit to the left), and all on the other
   side is equal. Pivots and prefixes are therefore joined by ``(side, start or end of the word as
   far as the bigram)``, which a skewed join splits. Lengths and the rest of the words are verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.common import col, stored

LETTER = "[A-Za-zÀ-ÿ]"
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Distinct words that a task counts before it sends them on.
HELD = 200_000


def runs_of_letters(key: str, text: str, typo_every: int = 97, least_length: int = 1) -> Counter:
    """Words of one document: maximal runs of letters, A-Z lower-cased, of ``least_length`` or more. A run whose
    crc32 of ``key:run`` is divisible by ``typo_every`` loses the character at the crc32 modulo its length."""
    out: Counter = Counter()
    head = zlib.crc32(f"{key}:".encode())
    text = text.lower() if text.isascii() else text.translate(_LOWER)
    # a run is matched from its start and whole, or is too short wherever the search starts in it
    for run, n in Counter(re.findall(f"{LETTER}{{{least_length},}}", text)).items():
        h = zlib.crc32(run.encode(), head)
        if h % typo_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5,
                least_count: int = 3, typo_every: int = 97) -> DataFrame:
    """``(word, n)``: words of ``least_length`` characters that occur ``least_count`` times over all
    documents. Null ids count as empty text, null texts have no words."""
    rows = docs.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("key"), col(text_col).cast("string").alias("text"))

    def run(batches):
        held: Counter = Counter()

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                for word, n in runs_of_letters(key, text or "", typo_every, least_length).items():
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= HELD:
                    yield batch_of()
                    held.clear()
        if held:
            yield batch_of()

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def pivotal(word: str, rank: dict[str, int], weight: dict[str, int]) -> tuple[list[int], list[int], int]:
    """``(pivot positions, prefix positions, last rank)`` of a word of four characters or more."""
    grams = sorted((rank[word[i:i + 2]], i) for i in range(len(word) - 1))
    last = grams[2][0]
    prefix = sorted(i for r, i in grams if r <= last)
    # best[k]: the cheapest pair among the first k prefix positions; single[k]: the cheapest position
    cost = [weight[word[i:i + 2]] for i in prefix]
    single: list[tuple[int, int]] = []
    best: tuple[int, list[int]] | None = None
    for k, i in enumerate(prefix):
        before = [s for s, j in zip(single, prefix) if j <= i - 2]
        if before and (best is None or before[-1][0] + cost[k] < best[0]):
            best = (before[-1][0] + cost[k], [before[-1][1], i])
        single.append(min(single[-1], (cost[k], i)) if single else (cost[k], i))
    return best[1], prefix, last


_ENTRY = {"key": pa.string(), "word": pa.string(), "last": pa.int32(), "n": pa.int32(), "head": pa.int64(), "tail": pa.int64()}
#: Characters of the first and last that are packed into a number, by their low byte.
PACKED = 4


def _packed(first: str) -> int:
    return int.from_bytes(bytes(ord(c) & 255 for c in first[:PACKED]).ljust(PACKED, b"\0"), "big")


def _entries(ranks: dict[str, int], weights: dict[str, int], pivots: bool):
    """Words -> for each pivot (or prefix bigram) and side ``(key, word, last, n, head, tail)``, the last three being
    length, first and (backwards) last characters of what the key leaves over."""
    def run(batches):
        for batch in batches:
            out = []
            for word in batch.column("word").to_pylist():
                pivot, prefix, last = pivotal(word, ranks, weights)
                for i in pivot if pivots else prefix:
                    for key, rest in (("<" + word[:i + 2], word[i + 2:]), (">" + word[i:], word[:i])):
                        out.append((key, word, last, len(rest), _packed(rest), _packed(rest[::-1])))
            columns = zip(*out) if out else [()] * len(_ENTRY)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ENTRY.values())], list(_ENTRY))
    return run


def near_words(words: DataFrame) -> DataFrame:
    """``words``: stored distinct ``(word, ...)`` of four characters or more -> ``(a, b)``, each pair that differs by exactly
    one inserted, deleted or replaced character once, ``a`` before ``b`` in the order of the join."""
    # bigrams of an alphabet of 90 letters: 8,100 rows at most, whatever the input
    grams = (words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
             .groupBy("gram").agg(F.count("*").alias("n")).orderBy("n", "gram").collect())
    ranks = {g.gram: k for k, g in enumerate(grams)}
    weights = {g.gram: g.n for g in grams}
    schema = "key string, word string, last int, n int, head long, tail long"
    pivots = words.select("word").mapInArrow(_entries(ranks, weights, True), schema).toDF("key", "s", "s_last", "s_n", "s_head", "s_tail")
    prefixes = words.select("word").mapInArrow(_entries(ranks, weights, False), schema).toDF("key", "r", "r_last", "r_n", "r_head", "r_tail")
    later = F.expr("r_last > s_last OR (r_last = s_last AND s < r)")
    # one edit leaves the first or the last half of the shorter as it is; as much of it as is packed is compared
    spare = f"8 * ({PACKED} - least({PACKED}, shiftright(least(s_n, r_n), 1)))"
    close = F.expr(f"abs(s_n - r_n) <= 1 AND (shiftright(s_head, {spare}) = shiftright(r_head, {spare}) OR shiftright(s_tail, {spare}) = shiftright(r_tail, {spare}))")
    rest = lambda w, n: F.when(F.col("key").startswith("<"), F.substring(w, -F.col(n), F.col(n))).otherwise(F.substring(w, F.lit(1), F.col(n)))
    pairs = (pivots.join(prefixes, "key").where(close & later)
             .where(F.levenshtein(rest("s", "s_n"), rest("r", "r_n"), 1) == 1))
    return pairs.select(F.col("s").alias("a"), F.col("r").alias("b")).distinct()


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5,
                      least_count: int = 3, typo_every: int = 97, times: int = 2) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Near words differ by exactly one inserted, deleted or replaced character. The form is the near
    word of the largest ``n`` (ties: the smallest word) if it occurs at least ``times`` as often as the
    word, else null; ``root`` follows forms to the last, and is the word itself without a form.
    Null and empty texts have no words; rows that repeat an id and a text count as often as
    they stand there; no words give no rows. ``least_length`` must be 4 or more, ``times`` 2 or more.
    """
    if least_length < 4 or times < 2:
        raise ValueError("words need four characters or more, and forms at least twice the count")
    words = stored(word_counts(docs, id_col, text_col, least_length, least_count, typo_every), "words")
    pairs = stored(near_words(words), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    near = (both.join(counts, "b").groupBy(F.col("a").alias("word"))
            .agg(F.count("*").alias("n_near"), F.min(F.struct(F.negative("b_n").alias("m"), "b")).alias("top")))
    table = words.join(near, "word", "left")
    has = F.negative("top.m") >= times * F.col("n")
    table = stored(table.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(has, F.col("top.b")).alias("form"), F.when(has, F.negative("top.m")).alias("form_n")), "forms")
    return table.join(_roots(table), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(table: DataFrame) -> DataFrame:
    """``(word, root)`` for words that have a form. Counts at least double along a chain, so that pointers
    are doubled a few times at most."""
    links = stored(table.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "links")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = stored(links.join(on, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "links")
        links = step.select("word", "root")
        if step.where("moved").isEmpty():
            return links
