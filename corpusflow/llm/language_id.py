"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of each white-space-delimited word in both directions and
labels every byte position; it starts anew at each word (and every ``SPAN`` bytes of a longer
one), so equal words have equal labels and a slab of text runs through the network once per
distinct word. A document's log probabilities are the mean over all of its positions.

Trained in numpy by backpropagation through time with Adam, on a bounded sample: at most
``per_language`` different labelled texts a language, chosen by a hash, of each at most
``sample_chars`` characters spread over the whole text. Prediction reads whole texts, and nothing but the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm.common import col, filter_rows, slabs

#: The training sample: documents of each language, characters of each, and pieces of a longer one.
PER_LANGUAGE = 300
SAMPLE_CHARS = 4000
PIECES = 8
#: Bytes that the network reads before it starts anew.
SPAN = 48
HIDDEN, STEPS, BATCH, RATE = 12, 450, 512, 0.012
#: Words that run through the network at once.
CHUNK = 2048
UNKNOWN = "und"


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Weights: ``x*`` input tables (bytes, 3H), ``u*`` recurrent (H, 3H), ``c*`` bias of the
    recurrent candidate (H), for the directions f and b; ``v`` (2H, classes), ``o`` its bias."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        self.w = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.w["u" + d] = rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(np.float32)
            self.w["c" + d] = np.zeros(hidden, np.float32)
        self.w["v"] = rng.normal(0, 0.3, (2 * hidden, len(labels))).astype(np.float32)
        self.w["o"] = np.zeros(len(labels), np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray | None, d: str, keep: bool = False):
        """States (L, N, H) of direction ``d`` over bytes ``x`` (N, L)."""
        n, length = x.shape
        h = np.zeros((n, self.hidden), np.float32)
        states, tape, k = np.empty((length, n, self.hidden), np.float32), [], self.hidden
        table, u, c = self.w["x" + d], self.w["u" + d], self.w["c" + d]
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            a, r = table[x[:, t]], h @ u
            gates = _sigmoid(a[:, :2 * k] + r[:, :2 * k])
            reset, update = gates[:, :k], gates[:, k:]
            inner = r[:, 2 * k:] + c
            new = np.tanh(a[:, 2 * k:] + reset * inner)
            out = new + update * (h - new)
            if mask is not None:
                m = mask[:, t:t + 1]
                out = out * m + h * (1 - m)
            if keep:
                tape.append((t, h, reset, update, inner, new))
            h = states[t] = out
        return states, tape

    def _back(self, x, mask, d, tape, grad_states, grads):
        k, u = self.hidden, self.w["u" + d]
        dh = np.zeros_like(grad_states[0])
        gx = grads["x" + d]
        for t, h, reset, update, inner, new in reversed(tape):
            dh = dh + grad_states[t]
            m = mask[:, t:t + 1]
            g = dh * m
            dnew = g * (1 - update) * (1 - new * new)
            dupdate = g * (h - new) * update * (1 - update)
            dreset = dnew * inner * reset * (1 - reset)
            dinner = dnew * reset
            dr = np.concatenate([dreset, dupdate, dinner], axis=1)
            da = np.concatenate([dreset, dupdate, dnew], axis=1)
            np.add.at(gx, x[:, t], da)
            grads["u" + d] += h.T @ dr
            grads["c" + d] += dinner.sum(axis=0)
            dh = dh * (1 - m) + g * update + dr @ u.T

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """(N, L) bytes -> (L, N, classes) log probabilities of every position."""
        both = np.concatenate([self._run(x, None, d)[0] for d in "fb"], axis=2)
        z = both @ self.w["v"] + self.w["o"]
        z -= z.max(axis=2, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=2, keepdims=True))

    def _step(self, x, mask, y):
        """Loss and gradients of one batch; ``y`` (N) is the label of all positions of a word."""
        (f, tape_f), (b, tape_b) = (self._run(x, mask, d, keep=True) for d in "fb")
        both = np.concatenate([f, b], axis=2)
        z = both @ self.w["v"] + self.w["o"]
        p = np.exp(z - z.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        weight = mask.T[:, :, None] / mask.sum()
        loss = -(np.log(p[:, np.arange(len(y)), y] + 1e-9) * weight[:, :, 0]).sum()
        p[:, np.arange(len(y)), y] -= 1
        dz = (p * weight).astype(np.float32)
        grads = {name: np.zeros_like(w) for name, w in self.w.items()}
        grads["v"] = np.einsum("lnh,lnc->hc", both, dz, optimize=True)
        grads["o"] = dz.sum(axis=(0, 1))
        dboth = dz @ self.w["v"].T
        self._back(x, mask, "f", tape_f, dboth[:, :, : self.hidden], grads)
        self._back(x, mask, "b", tape_b, dboth[:, :, self.hidden:], grads)
        return loss, grads

    def train(self, words: list[bytes], y: np.ndarray, weights: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 7) -> None:
        """Adam over batches of words drawn in proportion to ``weights``."""
        rng = np.random.default_rng(seed)
        length = max(map(len, words))
        x, mask = np.zeros((len(words), length), np.uint8), np.zeros((len(words), length), np.float32)
        for i, w in enumerate(words):
            x[i, : len(w)], mask[i, : len(w)] = np.frombuffer(w, np.uint8), 1
        edges = np.cumsum(weights / weights.sum())
        m1, m2 = ({k: np.zeros_like(w) for k, w in self.w.items()} for _ in range(2))
        for step in range(1, steps + 1):
            pick = np.minimum(np.searchsorted(edges, rng.random(batch)), len(words) - 1)
            used = int(mask[pick].sum(axis=1).max())
            _, grads = self._step(x[pick, :used], mask[pick, :used], y[pick])
            now = rate * min(1, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                m1[k] += 0.1 * (g - m1[k])
                m2[k] += 0.01 * (g * g - m2[k])
                self.w[k] -= now * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)


def _spans(text: bytes) -> list[bytes]:
    return [w[i:i + SPAN] for w in text.split() for i in range(0, len(w), SPAN)]


def _sample(text, chars: int):
    """``text``, or of a longer one ``PIECES`` pieces evenly spread, the words cut at their edges left out."""
    size, room = F.length(text), max(1, chars // PIECES)
    piece = lambda i: text.substr((F.lit(i) * (size - room) / (PIECES - 1)).cast("int") + 1, F.lit(room))
    cut = lambda i: F.regexp_replace(piece(i), (r"\A\S{1,47}\s" if i else "") + ("|" if 0 < i < PIECES - 1 else "") + (r"\s\S{1,47}\z" if i < PIECES - 1 else ""), "")
    return F.when(size <= chars, text).otherwise(F.concat_ws(" ", *[cut(i) for i in range(PIECES)]))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, sample_chars: int = SAMPLE_CHARS, **options) -> Network | None:
    """Fit a network on a bounded sample of the rows that have a label; None without any.

    The sample of a language is its different texts with the smallest hashes, so it depends
    neither on the order of the rows nor on how often a text is repeated. The number of different
    texts tells which hashes can be among them (eight times ``per_language`` are expected, and all
    of fewer texts); only those texts reach the top-k. Labels are a closed set.
    """
    rows = docs.where(col(lang_col).isNotNull() & (F.length(F.trim(col(text_col))) > 0)).select(
        col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text"), F.xxhash64(col(text_col)).alias("h"))
    sizes = {lang: n for lang, n in rows.select("lang", "h").distinct().groupBy("lang").count().collect()}
    if not sizes:
        return None
    limits = [x for lang, n in sorted(sizes.items()) for x in (F.lit(lang), F.lit(min(1.0, 8 * per_language / n)))]
    rows = rows.where(F.col("h") / 2.0 ** 64 + 0.5 <= F.create_map(*limits)[F.col("lang")])
    rows = rows.groupBy("lang", "h").agg(F.min(_sample(F.col("text"), sample_chars)).alias("text"))
    first = Window.partitionBy("lang").orderBy("h")
    picked = rows.withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_language).select("lang", "text").collect()
    counts: dict[tuple[str, bytes], int] = {}
    for lang, text in sorted(map(tuple, picked)):
        for w in _spans(text.encode()):
            counts[lang, w] = counts.get((lang, w), 0) + 1
    if not counts:
        return None
    keys = sorted(counts)
    labels = sorted({lang for lang, _ in keys})
    y = np.array([labels.index(lang) for lang, _ in keys])
    weights = np.sqrt(np.array([counts[k] for k in keys], float))
    for c in range(len(labels)):  # each language is drawn as often
        weights[y == c] /= weights[y == c].sum()
    net = Network(labels)
    net.train([w for _, w in keys], y, weights, **options)
    return net


def position_labels(net: Network, text: str) -> list[tuple[int, int, str]]:
    """The label of every byte outside white space, as runs ``(start, end, language)`` over the
    UTF-8 bytes; white space joins two runs of one label."""
    raw, runs, at = text.encode(), [], 0
    for w in raw.split():
        at = raw.index(w, at)
        for i in range(0, len(w), SPAN):
            part = w[i:i + SPAN]
            best = net.log_probabilities(np.frombuffer(part, np.uint8)[None])[:, 0].argmax(axis=1)
            for j, c in enumerate(best.tolist()):
                if runs and runs[-1][2] == net.labels[c] and not raw[runs[-1][1]:at + i + j].strip():
                    runs[-1] = (runs[-1][0], at + i + j + 1, net.labels[c])
                else:
                    runs.append((at + i + j, at + i + j + 1, net.labels[c]))
        at += len(w)
    return runs


def _word_sums(net: Network, words: list[bytes]) -> np.ndarray:
    """Summed log probabilities over the positions of each word."""
    out = np.empty((len(words), len(net.labels)), np.float32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        for i in range(0, len(own), CHUNK):
            part = own[i:i + CHUNK]
            x = np.frombuffer(b"".join([words[k] for k in part.tolist()]), np.uint8).reshape(len(part), size)
            out[part] = net.log_probabilities(x).sum(axis=0)
    return out


def predict(net: Network | None, texts: list[str]) -> list[tuple[str, float]]:
    """``(language, score)`` of each text; ``und`` and 0 for one without a letter (or a model)."""
    out = []
    for group in slabs(texts):
        index: dict[bytes, int] = {}
        spans = [[index.setdefault(w, len(index)) for w in _spans(t.encode())] if net and any(map(str.isalpha, t)) else [] for t in group]
        words = list(index)
        sums = _word_sums(net, words) if words else None
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for own in spans:
            if not own:
                out.append((UNKNOWN, 0.0))
                continue
            mean = sums[own].sum(axis=0, dtype=np.float64) / sizes[own].sum()
            p = np.exp(mean - mean.max())
            out.append((net.labels[int(mean.argmax())], float(p.max() / p.sum())))
    return out


def _texts(batch, name):
    return [t or "" for t in batch.column(name).to_pylist()]


def _predict(net, text_col):
    def run(batches):
        for batch in batches:
            found = predict(net.value, _texts(batch, text_col))
            arrays = [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], [*batch.schema.names[:-1], "lang_pred", "score"])
    return run


def identify(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score``.

    ``score`` is the predicted language's share of the pooled probabilities, from 0 to 1. Null,
    empty and letterless texts are ``und`` with score 0, as are all if ``net`` is None (nothing
    was labelled). Repeated rows each give a row; of equal probabilities the first label wins.
    """
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(net), "text"), f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, net: Network | None, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """``docs`` without the rows in no language (``und``) or below the score ``least``; the other
    rows and all columns as they were. If ``net`` is None (nothing was labelled), texts with a
    letter stay."""
    if net is None:
        return filter_rows(docs, text_col, lambda texts: [any(map(str.isalpha, t)) for t in texts])
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return filter_rows(docs, text_col, lambda texts: [lang != UNKNOWN and score >= least for lang, score in predict(shared.value, texts)])
