"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of its bytes. Each adjacent pair whose bytes are a token waits
in the bucket of that token's rank; a two-level bitmap over the ranks tells by two
find-first-set steps which bucket is next. A merge links the pair, drops it from the list
and queues the two new pairs; entries that a merge made stale are skipped when they come up.
Every position enters a bucket at most three times, so a pre-token of n bytes costs
O(n log n) whatever its length.

Texts are cut at single spaces between two other characters, where every pre-token pattern of this
kind cuts too; the pieces repeat, so their ids are kept in a bounded two-generation memory.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm.common import id_text

#: Pieces, and pre-tokens, that a worker remembers in each of two generations.
REMEMBERED = 500_000
#: Longer pieces aren't remembered.
LONG = 256

_WIDTH = 256
_BIT = [1 << k for k in range(4096)]  # ranks below 2**20
_UNEVEN = re.compile(r" \s|\s ")
_SINGLE = re.compile(r"(?<=\S) (?=\S)")


class RankQueue:
    """Positions by rank; ``pop`` gives the first position of the lowest rank."""

    def __init__(self, ranks: int):
        self.words = [0] * (ranks // _WIDTH + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def fill(self, due: list[int]) -> None:
        """Queue the positions of an empty queue, in order: a sorted bucket is a heap."""
        buckets = self.buckets
        for at, rank in enumerate(due):
            if rank in buckets:
                buckets[rank].append(at)
            elif rank >= 0:
                buckets[rank] = [at]
                self.words[rank >> 8] |= _BIT[rank & 255]
                self.top |= _BIT[rank >> 8]

    def push(self, rank: int, at: int) -> None:
        buckets = self.buckets
        if rank in buckets:
            heapq.heappush(buckets[rank], at)
        else:
            buckets[rank] = [at]
            w = rank >> 8
            self.words[w] |= _BIT[rank & 255]
            self.top |= _BIT[w]

    def pop(self) -> tuple[int, int]:
        top = self.top
        w = (top & -top).bit_length() - 1
        word = self.words[w]
        rank = (w << 8) + (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heapq.heappop(bucket)
        del self.buckets[rank]
        self.words[w] = word = word & (word - 1)
        if not word:
            self.top = top & (top - 1)
        return rank, bucket[0]


class Memory(dict):
    """Value of a bounded number of keys, computed when missing. A full generation becomes the
    old one, whose entries come back when asked for."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONG:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    def __init__(self, rank_file: bytes, pattern: str, remembered: int | None = None):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.numbers = {rank: str(rank) for rank in self.tokens}
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(max(self.tokens, default=0) + 1)
        self.words = Memory(lambda token: tuple(self.merge(token.encode())), remembered or REMEMBERED)
        self.pieces = Memory(lambda piece: tuple(self.piece_ids(" " + piece)), remembered or REMEMBERED)

    def merge(self, token: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks, queue = self.ranks, self.queue
        whole = ranks.get(token)
        if whole is not None:
            return [whole]
        n, get, push, pop = len(token), ranks.get, queue.push, queue.pop
        end = list(range(1, n + 1))  # of the part that starts here
        before = list(range(-1, n))
        # rank of the pair of the parts at and after a position, if it waits
        due = [get(token[i:i + 2], -1) for i in range(n)]
        due[-1] = -1
        queue.fill(due)
        while queue.top:
            rank, at = pop()
            if due[at] != rank:  # stale
                continue
            middle = end[at]
            due[at] = due[middle] = -1
            end[at] = stop = end[middle]
            if stop < n:
                before[stop] = at
                rank = get(token[at:end[stop]])
                if rank is not None:
                    due[at] = rank
                    push(rank, at)
            left = before[at]
            if left >= 0:
                rank = get(token[left:stop])
                if rank is None:
                    due[left] = -1
                else:
                    due[left] = rank
                    push(rank, left)
        out, at = [], 0
        while at < n:
            stop = end[at]
            out.append(ranks[token[at:stop]])
            at = stop
        return out

    def piece_ids(self, piece: str) -> list[int]:
        return list(chain.from_iterable(map(self.words.__getitem__, self.find(piece))))

    def encode_pieces(self, text: str):
        """The ids of the text, as an iterator of groups."""
        if not text:
            return iter(())
        if text[0] == " " or text[-1] == " " or _UNEVEN.search(text):
            parts = _SINGLE.split(text)
        else:
            parts = text.split(" ")
        return chain((self.piece_ids(parts[0]),), map(self.pieces.__getitem__, parts[1:]))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.encode_pieces(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def count(self, text: str) -> int:
        return sum(map(len, self.encode_pieces(text)))


@lru_cache(maxsize=1)
def codec(rank_file: bytes, pattern: str, remembered: int | None = None) -> Codec:
    """The codec of a worker process, with what it remembers."""
    return Codec(rank_file, pattern, remembered)


def shared_vocabulary(spark: SparkSession, path: str):
    """The rank file, broadcast: a vocabulary is a fixed file, whatever the corpus."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _rows(ranks, pattern, with_ids, remembered, forget):
    def run(batches):
        own = codec(ranks.value, pattern, remembered)
        for batch in batches:
            counts, coded, decoded, lists = [], [], [], []
            for text in batch.column("text"):
                ids = own.encode(text.as_py())
                counts.append(len(ids))
                coded.append(hashlib.sha256(" ".join(map(own.numbers.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
                if with_ids:
                    lists.append(pa.array(ids, pa.int32()))
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(coded, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
            if with_ids:
                columns["ids"] = pa.array([x.to_pylist() for x in lists], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
        if forget:
            codec.cache_clear()
            pa.default_memory_pool().release_unused()
    return run


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, remembered: int = REMEMBERED, forget: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``.

    ``ids`` are those of ``tiktoken`` with the same ranks and pattern and no special tokens.
    ``ids_sha256`` is over the decimal ids joined by one space, ``decoded_sha256`` over the bytes
    decoded from the ids. ``remembered`` trades a worker's memory for time; with
    ``forget`` workers give it back after each task, for jobs whose other steps need it. Null text is empty; an empty text has no ids. No rows give no rows.
    """
    rows = id_text(docs, id_col, text_col)
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(_rows(shared_vocabulary(docs.sparkSession, vocabulary), pattern, with_ids, remembered, forget), schema)


def _decode(ranks, pattern):
    def run(batches):
        own = codec(ranks.value, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([own.decode(x.as_py() or []) for x in batch.column("ids")], pa.binary())], ["doc_id", "bytes"])
    return run


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` -> ``(doc_id, bytes)``; null ids give no bytes, an unknown id is an error."""
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(_decode(shared_vocabulary(encoded.sparkSession, vocabulary), pattern), f"doc_id {dict(rows.dtypes)['doc_id']}, bytes binary")
