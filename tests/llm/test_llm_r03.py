"""Repeated byte strings, collocations and spelling variants against brute force, with nulls, empty and
long texts, ties, repeated rows, empty tables and columns with clashing names."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusflow.llm import collocations, rolling, spelling, suffix_dedup, suffix_sort

EXTRA = "doc_id long, text string, lang string, did string, n long, word string, key long, `a.b` string, chunk binary"


def _table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, "w", 2, "z", b"q") for i, t, lang in rows], EXTRA).repartition(3)


@pytest.mark.parametrize("wide", [1, 3, 64])
def test_suffix_array(monkeypatch, wide):
    monkeypatch.setattr(suffix_sort, "WIDE", wide)
    rng = random.Random(wide)
    cases = [[], [5], [1] * 30, [1, 2] * 20, [2, 1] * 20, list(range(20)), list(range(20))[::-1], [3, 1, 3, 1, 3, 0] * 9]
    cases += [[rng.randrange(k) for _ in range(rng.randrange(60))] for k in (1, 2, 3, 5, 200) for _ in range(150)]
    for a in cases:
        assert suffix_sort.suffix_array(np.array(a, np.int64)).tolist() == sorted(range(len(a)), key=lambda i: a[i:])


def test_span_hashes_depend_on_bytes_alone():
    data = np.frombuffer(b"abcd--abcd-abce", np.uint8)
    h = rolling.span_hashes(data, np.array([0, 6, 11, 0]), np.array([4, 10, 15, 0]), 1)
    assert h[0] == h[1] != h[2] and len({*h.tolist()}) == 3


def _removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    for b in data:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                covered[i:i + length] = b"\1" * length
        runs = tuple(m.span() for m in re.finditer(b"\1+", bytes(covered)))
        yield len(b), runs, bytes(x for x, c in zip(b, covered) if not c)


def _texts(rng):
    common = "".join(rng.choice("abcdé") for _ in range(15))
    texts = []
    for k in range(90):
        t = "".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(120)))
        if k % 2:
            t = t[:30] + common + t[30:]
        if k % 7 == 0 and texts:
            t = rng.choice(texts)[:60] + t
        texts.append(t)
    return texts + ["a" * 100, "ab" * 60, "x" * 5, None, "", texts[3], texts[3], texts[5]]


# small groups are split down to single windows; a window may be its own anchor
@pytest.mark.parametrize("length,anchor,group_bytes", [(12, 4, 60), (12, 12, 50), (9, 2, 10**6)])
def test_remove_repeats(spark, length, anchor, group_bytes):
    texts = _texts(random.Random(3))
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(3, texts[3], "en"), (None, texts[4], None), (None, None, None)]
    got = suffix_dedup.remove_repeats(_table(spark, rows), length=length, anchor=anchor, group_bytes=group_bytes).collect()
    want = Counter((i, *r) for (i, _, _), r in zip(rows, _removed([t for _, t, _ in rows], length)))
    assert Counter((g.doc_id, g.n_bytes, tuple((s.start, s.end) for s in g.spans), bytes(g.kept)) for g in got) == want


def test_remove_repeats_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(suffix_dedup, "SLAB", 100)  # the driver's copy; tasks use theirs
    long = "".join(rng.choice("abcdefgh") for _ in range(900))
    pieces = list(suffix_dedup._runs([long.encode()], 20, 6))[0]
    monkeypatch.setattr(suffix_dedup, "SLAB", 1 << 20)
    whole = list(suffix_dedup._runs([long.encode()], 20, 6))[0]
    spread = lambda r: [(h, s + k, a - k) for h, s, n, a in zip(*(x.tolist() for x in r)) for k in range(n)]
    assert spread(pieces) == spread(whole)
    rows = [(0, long * 2, "en"), (1, long[100:160], "en"), (2, "é" * 30 + long[500:519], "en")]
    got = {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans]) for r in suffix_dedup.remove_repeats(_table(spark, rows), length=20, anchor=6).collect()}
    assert got == {0: (1800, [(0, 1800)]), 1: (60, [(0, 60)]), 2: (79, [(0, 60)])}


def test_remove_repeats_empty_and_bad_anchor(spark):
    empty = spark.createDataFrame([], EXTRA)
    assert suffix_dedup.remove_repeats(empty).collect() == []
    short = suffix_dedup.remove_repeats(_table(spark, [(1, "abc", "en"), (2, "abc", "en"), (3, None, None)])).collect()
    assert sorted((r.doc_id, bytes(r.kept), r.spans) for r in short) == [(1, b"abc", []), (2, b"abc", []), (3, b"", [])]
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(empty, length=10, anchor=11)


def _ranked(rows, most, least, percent, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, most + 1):
                counts[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in frequent.items():
            if any(100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in frequent.items() if len(q) > len(p)):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n, p.decode(), -a, left, right, total[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


# a modulus of 1 starts a chunk at every word, a huge one never
@pytest.mark.parametrize("most,modulus", [(3, 1), (3, 4), (4, 3), (2, 10**9)])
def test_collocations(spark, most, modulus):
    rng = random.Random(most)
    words = ["the", "of", "New", "York", "straße", "É", "é", "x y", "'", "l m", "san", "FRANCISCO"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ", ", "\n", ".", "\x0b"]) for _ in range(rng.randrange(60)))
    rows = [(i, text(), rng.choice(["en", "fr", None, "und"])) for i in range(70)]
    rows += [(None, rows[0][1], "en"), (0, *rows[0][1:]), (0, *rows[0][1:]), (70, None, "en"), (71, "", "de"), (72, " \t.;\n", "de"), (73, "one two", "it"), (74, "a b " * 400, "en")]
    got = collocations.collocations(_table(spark, rows), max_words=most, least_count=4, top=25, modulus=modulus).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == _ranked(rows, most, 4, 50, 25)


def test_collocations_empty(spark):
    empty = spark.createDataFrame([], EXTRA)
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(_table(spark, [(1, None, "en"), (2, "", None)])).collect() == []


def test_collocation_scores_are_exact(spark):
    a, left, right = 999_999_999_999_937, 999_999_999_999_989, 999_999_999_999_947
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = row.selectExpr("(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))) div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0))) AS s").first().s
    assert got == 10**6 * a * a // (left * right)


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(rows, every):
    n = Counter()
    for key, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if _near(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n), key=str)


@pytest.mark.parametrize("every", [97, 3])
def test_spelling_variants(spark, every):
    rng = random.Random(every)
    vocabulary = ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "ababa", "ÀÉÿñ÷×", "Éclair", "éclair"]
    for _ in range(40):
        w = "".join(rng.choice("abcÀé") for _ in range(rng.randrange(5, 9)))
        vocabulary.append(w)
        for _ in range(3):
            i, c = rng.randrange(len(w)), rng.choice("abcdé")
            vocabulary.append(rng.choice([w[:i] + c + w[i + 1:], w[:i] + w[i + 1:], w[:i] + c + w[i:], w + c]))
    weights = [1 + 30 // (1 + k % 13) for k in range(len(vocabulary))]
    rows = [(i, "".join(w + rng.choice([" ", ",", "1", "Ā"]) for w in rng.choices(vocabulary, weights, k=rng.randrange(150))), "en") for i in range(60)]
    rows += [(None, rows[3][1], None), (5, *rows[5][1:]), (5, *rows[5][1:]), (99, None, "en"), (98, "", "en"), (97, "AAAAA " * 3000, "en"), (96, "q" * 5000, "en")]
    got = spelling.spelling_variants(_table(spark, rows), typo_every=every).collect()
    want = _variants(rows, every)
    assert sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got), key=str) == want
    assert sum(w[4] > 0 for w in want) > 50 and any(w[1] and w[2] != w[1] for w in want)


def test_spelling_variants_empty_and_limits(spark):
    empty = spark.createDataFrame([], EXTRA)
    assert spelling.spelling_variants(empty).collect() == []
    assert spelling.spelling_variants(_table(spark, [(1, None, None), (2, "", "en"), (3, "only these few words", "en")])).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(empty, least_length=3)


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(2)
    for _ in range(500):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(4, 10)))
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)})
        weight = {g: rng.randrange(1, 9) for g in grams}
        rank = {g: k for k, g in enumerate(sorted(grams, key=lambda g: (weight[g], g)))}
        pivots, prefix, last = spelling.pivotal(word, rank, weight)
        cost = lambda pair: sum(weight[word[i:i + 2]] for i in pair)
        assert pivots[1] - pivots[0] >= 2 and set(pivots) <= set(prefix) and len(prefix) >= 3
        assert cost(pivots) == min(cost((i, j)) for i in prefix for j in prefix if j - i >= 2)
        assert prefix == [i for i in range(len(word) - 1) if rank[word[i:i + 2]] <= last]
